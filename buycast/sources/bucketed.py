"""Feature families as tables bucketed by customer, so that joining them moves no row."""

from pyspark.sql import DataFrame, SparkSession

from buycast.runtime import beside

KEYS = ("split", "cutoff", "customer_id")


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int, key="customer_id"):
    """Keep ``df`` at ``path`` as table ``name``: one file per bucket of ``key``, sorted by the keys it has."""
    order = [key, *[c for c in KEYS if c in df.columns and c != key]]
    (
        df.repartition(buckets, key).write.mode("overwrite").option("path", path)
        .bucketBy(buckets, key).sortBy(*order).saveAsTable(name)
    )


def attach_bucketed(spark: SparkSession, name: str, path: str, buckets: int, key="customer_id"):
    """Make known in this session what ``write_bucketed`` left at ``path``."""
    found = spark.read.parquet(path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields)
    order = ", ".join([key, *[c for c in KEYS if c in found.columns and c != key]])
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({order}) INTO {buckets} BUCKETS LOCATION '{path}'")


def read_families(spark: SparkSession, first: str, second: str) -> DataFrame:
    """Two families side by side, one row per row of ``first``; their buckets meet in place."""
    # the buckets are read as they lie also where the tables are small, and neither is sent to all tasks
    left, right = spark.table(first).hint("merge"), spark.table(second)
    return beside(left, right.drop("label"), "customer_id", ["split", "cutoff"])
