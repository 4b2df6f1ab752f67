"""Shared building blocks: lineage cuts, exact global order, running totals, top-k per key."""

import tempfile
import uuid
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def checkpoint_dir(spark):
    """The shared folder the cluster names; local runs without one get a temporary folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            named = tempfile.mkdtemp(prefix="buycast-checkpoint-")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder, so later steps neither recompute it nor see its layout change."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, folders=(), **options) -> DataFrame:
    """Write ``df`` as Parquet below the checkpoint folder and read it back.

    Also cuts the lineage. For tables that several later steps read in part: those scans then take
    only their columns, and skip row groups by their filters.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"
    df.write.options(**{"compression": "zstd", **options}).partitionBy(*folders).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


#: Rows that are worth a task of their own in a pass of a trainer, and rows that a task should not exceed by far.
ROWS_PER_TASK, MOST_ROWS = 20_000, 1_000_000


def dealt(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly over the tasks that its number of rows is worth, about two per core at most.

    For tables that are read many times: a table of some MB is one file, and each pass over it one task. Counts the rows
    once; a table that is worth one task stays as it is.
    """
    n = df.count()
    tasks = max(min(-(-n // ROWS_PER_TASK), 2 * df.sparkSession.sparkContext.defaultParallelism), -(-n // MOST_ROWS))
    return df.repartition(tasks) if tasks > 1 else df


def side_by_side(calls, threads=6):
    """The results of functions without arguments, in their order; up to ``threads`` submit their jobs at the same time."""
    wrap = inheritable_thread_target(SparkSession.active())
    calls = [wrap(call) for call in calls]
    with ThreadPool(max(min(threads, len(calls)), 1)) as pool:
        return pool.map(lambda call: call(), calls, chunksize=1)


def beside(left: DataFrame, right: DataFrame, key: str, others) -> DataFrame:
    """``left`` and, where it has one, the row of ``right`` with the same ``key`` and ``others``; rows without stay.

    For tables that both lie by ``key`` and have few rows for each: only ``key`` is a join key, so no row is moved. Were the
    others keys too, Spark would by default lay out both tables anew by all of them.
    """
    side = right.withColumnsRenamed({c: f"_{c}" for c in (key, *others)})
    same = F.col(key) == F.col(f"_{key}")
    for c in others:
        same = same & (F.col(c) >= F.col(f"_{c}")) & (F.col(c) <= F.col(f"_{c}"))
    return left.join(side, same, "left").drop(*[f"_{c}" for c in (key, *others)])


def _laid_out(df: DataFrame, order) -> DataFrame:
    """``df`` range-sorted and fixed on disk, with its partition number ``_part``."""
    return cut(df.orderBy(*order)).withColumn("_part", F.spark_partition_id())


def global_index(df: DataFrame, order, name="idx", start=0) -> DataFrame:
    """Number the rows 0, 1, 2 … (plus ``start``) in the order of ``order``, which must be unique per row.

    The sort is range-partitioned and stays distributed. Only one row per partition (its size) goes
    through a single task, to turn sizes into offsets.
    """
    placed = _laid_out(df, order).withColumn(
        "_row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        # one row per partition of the sort: the size is bounded by the partition count
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.col("_row") + F.col("_offset") + F.lit(start)).cast("long"))
        .drop("_part", "_row", "_offset")
    )


def running_totals(df: DataFrame, order_col: str, sums, groups=()) -> DataFrame:
    """For each row and each column s of ``sums``, add ``s_before``: the total of s over the rows that
    come earlier in ``order_col`` within ``groups``.

    ``order_col`` must be unique within ``groups``: aggregate by it first. That also removes skew,
    since a value held by a third of the rows is then one row.
    """
    groups = list(groups)
    placed = _laid_out(df, [*groups, order_col])
    sizes = placed.groupBy(*groups, "_part").agg(*[F.sum(s).alias(f"_{s}") for s in sums])
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *groups, "_part",
        *[F.coalesce(F.sum(f"_{s}").over(earlier), F.lit(0)).alias(f"_{s}_offset") for s in sums],
    )
    inside = (
        Window.partitionBy(*groups, "_part").orderBy(order_col)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    out = placed
    for s in sums:
        out = out.withColumn(f"{s}_before", F.coalesce(F.sum(s).over(inside), F.lit(0)))
    out = out.join(offsets, [*groups, "_part"])
    for s in sums:
        out = out.withColumn(f"{s}_before", F.col(f"{s}_before") + F.col(f"_{s}_offset"))
    return out.drop("_part", *[f"_{s}_offset" for s in sums])


def top_k_per_key(df: DataFrame, keys, order, k: int) -> DataFrame:
    """The first ``k`` rows of each key in the order of ``order``.

    The row_number limit also runs before the shuffle, so a map task sends at most k rows per key.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") <= k).drop("_rank")
