"""Operators for preparing training text. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Python workers get the functions themselves, so executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
