"""From scores to buyer lists."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buycast.functions.numbers import above
from buycast.runtime import global_index

BUY_NUM = 450_000


def flag_top_n(df: DataFrame, score_col="score", n=BUY_NUM + 1, key="customer_id") -> DataFrame:
    """(key, score, result) in the order of ``key``: 1 for the ``n`` highest scores, ties broken by key, else 0.

    The rank comes from a range-partitioned sort, so neither ``n`` nor a score shared by many rows
    gathers rows in one task.
    """
    order = [F.desc_nulls_last(score_col), F.asc(key)]
    ranked = global_index(df.select(key, score_col), order, "rank")
    return ranked.select(key, score_col, (F.col("rank") < n).cast("int").alias("result")).orderBy(key)


def rollup_candidates(df: DataFrame, threshold=0.5, key="customer_id", probability="probability") -> DataFrame:
    """(key, probability, result): the best candidate of each customer, 1 if above ``threshold``."""
    return (
        df.groupBy(key).agg(F.max(probability).alias("probability"))
        .withColumn("result", above(F.col("probability"), threshold))
    )


def fill_template(template: DataFrame, pred: DataFrame, key="customer_id", keep_order=False) -> DataFrame:
    """(key, result) for every row of the template, 0 where there is no prediction.

    ``keep_order`` sorts the rows by the template's ``place`` (see ``read_customers``) and returns it too;
    a template without that column is taken in the order in which Spark reads it.
    """
    if not keep_order:
        rows = template.select(key)
    elif "place" in template.columns:
        rows = template.select(key, "place")
    else:
        rows = template.select(key, F.monotonically_increasing_id().alias("_place"))
    out = rows.join(pred.select(key, "result"), key, "left")
    out = out.withColumn("result", F.coalesce("result", F.lit(0)).cast("int"))
    return out.orderBy(*[c for c in ("place", "_place") if c in rows.columns]).drop("_place") if keep_order else out


def predicted_buyers(df: DataFrame) -> DataFrame:
    return df.agg(F.coalesce(F.sum("result"), F.lit(0)).cast("long").alias("buyers"))
