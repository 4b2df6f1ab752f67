"""Features that grow by a month: mergeable states and daily sums are kept per month, and a new month reads only its own lines."""

import calendar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buycast.functions.times import as_date, month_bounds, start_of
from buycast.operators.cutoffs import Cutoff
from buycast.operators.static import ORIGIN, boundaries_of, merged_features, partial_rows
from buycast.operators.windows import FLOOR, daily
from buycast.plans.features import feature_set

ORDER = ("order_pay_time", "order_detail_id")


def _reduced(lines, first, following, keys, ord_col):
    order = [ord_col] if isinstance(ord_col, str) else list(ord_col)
    paid = F.col("order_pay_time")
    rows = lines.filter((paid >= start_of(first)) & (paid < start_of(following)) & F.col("customer_id").isNotNull())
    rows = rows.withColumn("month", F.date_format(paid, "yyyy-MM"))
    return partial_rows(rows, ["customer_id", *keys], order, extras=False), daily(rows, first)


def add_month(lines: DataFrame, root: str, month: str, ord_col=ORDER):
    """Reduce the lines of ``month`` (yyyy-MM) to states and daily sums below ``root``, in place of what is there for it.

    Only that month's lines are asked of the source. A month without lines leaves empty tables.
    """
    states, days = _reduced(lines, *month_bounds(month), [], ord_col)
    for table, kind in ((states, "states"), (days, "days")):
        table.write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/{kind}/month={month}")


def add_months(lines: DataFrame, root: str, first: str, last: str, ord_col=ORDER):
    """``add_month`` for every month from ``first`` to ``last`` that has lines, in one pass over them."""
    states, days = _reduced(lines, month_bounds(first)[0], month_bounds(last)[1], ["month"], ord_col)
    days = days.withColumn("month", F.date_format("day", "yyyy-MM"))
    # written where they were merged: to gather the rows of a month would be another shuffle of all states
    for table, kind in ((states, "states"), (days, "days")):
        table.write.mode("overwrite").options(partitionOverwriteMode="dynamic", compression="zstd").partitionBy("month").parquet(f"{root}/{kind}")


def _months(spark: SparkSession, root, kind):
    # months are text, not numbers or dates
    schema = spark.read.parquet(f"{root}/{kind}").drop("month").schema.add("month", "string")
    return spark.read.schema(schema).parquet(f"{root}/{kind}")


def _whole_month(day):
    day = as_date(day)
    if day.day != calendar.monthrange(day.year, day.month)[1]:
        raise ValueError(f"{day} is not the last day of a month")
    return f"{day:%Y-%m}"


def features_from_months(spark: SparkSession, root: str, cutoffs: list[Cutoff], method="both", label_rule="month", ord_col=ORDER,
                         floor=FLOOR, origin=ORIGIN, **options) -> DataFrame:
    """``feature_set`` from the months kept below ``root``, without reading a line again.

    Cut-offs and label windows must end with a month. States merge by max, min and sum, so the result is that
    of all lines at once.
    """
    order = [ord_col] if isinstance(ord_col, str) else list(ord_col)
    ends = boundaries_of(cutoffs, None if label_rule == "goods30" else label_rule)
    months = [_whole_month(e) for e in ends]
    period = sum(((F.col("month") > m).cast("int") for m in months), F.lit(0))
    states = _months(spark, root, "states")
    if not (label_rule == "open" and any(c.has_label for c in cutoffs)):
        states = states.filter(F.col("month") <= months[-1])
    states = states.withColumn("period", period).drop("month")
    if method == "time":
        states = states.select("customer_id", "period", "n_rows")
    people = merged_features(states, cutoffs, ends, None if label_rule == "goods30" else label_rule, order, origin, method != "time")
    days = _months(spark, root, "days").filter((F.col("month") >= f"{as_date(floor):%Y-%m}") & (F.col("day") >= F.lit(as_date(floor)))).drop("month")
    return feature_set(None, cutoffs, method, label_rule, ord_col, floor, daily_rows=days, people=people, **options)
