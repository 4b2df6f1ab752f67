"""Number and array helpers."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0 or either is null."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def finite(col: Column) -> Column:
    """Null in place of infinities and NaN."""
    bad = F.isnan(col) | col.isin(float("inf"), float("-inf"))
    return F.when(~bad, col)


def sigmoid(col: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col))


def above(col: Column, threshold: float) -> Column:
    return (col > threshold).cast("int")


def pad(col, length=50) -> Column:
    """The array filled up with zeros on the right to ``length``; longer arrays stay as they are."""
    col = F.col(col) if isinstance(col, str) else col
    return F.concat(col, F.array_repeat(F.lit(0).cast("int"), F.greatest(F.lit(length) - F.size(col), F.lit(0))))


def real_items(col) -> Column:
    """Mask of the entries that are not padding."""
    col = F.col(col) if isinstance(col, str) else col
    return F.transform(col, lambda x: x != 0)


def last_items(col, n: int) -> Column:
    """The last ``n`` entries of an array, or all of a shorter one."""
    col = F.col(col) if isinstance(col, str) else col
    return F.slice(col, F.greatest(F.size(col) - F.lit(n - 1), F.lit(1)), F.lit(n))


def or_empty(col, kind="array<int>") -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col, F.array().cast(kind))


def once(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once per row, however often and in whatever lambda ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
