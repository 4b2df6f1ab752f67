"""Row filters and small table repairs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buycast.functions.times import after, up_to, year_month
from buycast.operators.cutoffs import label_end


def upto(df: DataFrame, day) -> DataFrame:
    """Lines paid up to the end of ``day``; a line without a pay time goes."""
    return df.filter(up_to(F.col("order_pay_time"), day))


def in_label_window(df: DataFrame, day, rule="month") -> DataFrame:
    """Lines paid inside the label window after ``day``."""
    end = label_end(day, rule)
    kept = df.filter(after(F.col("order_pay_time"), day))
    return kept if end is None else upto(kept, end)


def label_buyers(df: DataFrame, day, rule="month") -> DataFrame:
    """Distinct customers that buy in the label window.

    ``month``: any line in the calendar month after ``day``. ``open``: any later line.
    ``goods30``: goods bought on any of the next 30 days.
    """
    rows = in_label_window(df, day, rule).filter(F.col("customer_id").isNotNull())
    if rule == "goods30":
        per_day = rows.groupBy("customer_id", F.to_date("order_pay_time").alias("day")).agg(
            F.sum("order_total_num").alias("goods"))
        rows = per_day.filter(F.col("goods") > 0)
    return rows.select("customer_id").distinct()


def clean_events(df: DataFrame, required=("customer_id", "goods_id", "goods_class_id", "order_pay_time")) -> DataFrame:
    """Drop lines with a null in ``required`` and add ``month`` (yyyy-MM)."""
    return df.dropna(subset=list(required)).withColumn("month", year_month(F.col("order_pay_time")))


def align(df: DataFrame, columns) -> DataFrame:
    """The given columns in the given order; the training table decides them for every split."""
    return df.select(*columns)


def stack_splits(train: DataFrame, test: DataFrame) -> DataFrame:
    """Rows of both; columns the test table lacks, such as the label, are null there."""
    return train.unionByName(test, allowMissingColumns=True)


def labelled(df: DataFrame, label="label") -> DataFrame:
    return df.filter(F.col(label).isNotNull())


def unlabelled(df: DataFrame, label="label") -> DataFrame:
    return df.filter(F.col(label).isNull())
