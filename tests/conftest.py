import datetime as dt
import os
import sys

import pytest
from pyspark.sql import types as T

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from buycast.session import local_session  # noqa: E402
from buycast.sources.schemas import ORDER_DETAIL, TIME_COLUMNS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(cpus=8, app="tests")


LINES = T.StructType([
    T.StructField(f.name, T.TimestampType() if f.name in TIME_COLUMNS else f.dataType) for f in ORDER_DETAIL.fields
])


@pytest.fixture(scope="session")
def make_lines(spark):
    """Order lines from dicts; columns left out are null, the line id counts up."""
    from decimal import Decimal

    def make(*rows):
        out = []
        for i, row in enumerate(rows):
            row = {"order_detail_id": i + 1, **row}
            values = []
            for f in LINES.fields:
                v = row.get(f.name)
                if v is not None and isinstance(f.dataType, T.DecimalType):
                    v = Decimal(str(v))
                elif v is not None and isinstance(f.dataType, T.TimestampType) and isinstance(v, str):
                    v = dt.datetime.fromisoformat(v)
                elif v is not None and isinstance(f.dataType, T.DoubleType):
                    v = float(v)
                values.append(v)
            out.append(tuple(values))
        return spark.createDataFrame(out, LINES)

    return make
