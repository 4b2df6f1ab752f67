"""Readers and writers for tables, dictionaries, models and training logs."""

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from buycast.functions.times import to_time, to_time_or_null
from buycast.operators.steps import StepModel
from buycast.operators.trees import TreeModel
from buycast.runtime import global_index, stored
from buycast.sources.schemas import CUSTOMERS, ORDER_DETAIL, TIME_COLUMNS


def _raw(spark, path, schema, required, options):
    """A CSV as text, with the columns of ``schema`` that its header has. Missing ``required`` columns raise."""
    raw = spark.read.options(header=True, **options).csv(path)
    missing = [c for c in required if c not in raw.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return raw, [f for f in schema.fields if f.name in raw.columns]


def _by_name(spark, path, schema, required, options, extra=()):
    """Read a CSV by its header names: text first, then a typed projection.

    A given schema binds by position, so it would go wrong silently on reordered columns. A number that
    does not parse raises; ``rejected_lines`` lists such lines.
    """
    raw, fields = _raw(spark, path, schema, required, options)
    return raw.select(*extra, *[_typed(f).alias(f.name) for f in fields])


def _parsed(f, value=None):
    text = F.trim(F.col(f.name) if value is None else value)
    if isinstance(f.dataType, (T.IntegerType, T.LongType)):
        # whole numbers may be written as "3.0" when the column had nulls; other fractions do not parse
        exact = text.try_cast(T.DecimalType(38, 10))
        return F.coalesce(text.try_cast(f.dataType), F.when(exact == F.floor(exact), exact.try_cast(f.dataType)))
    return text.try_cast(f.dataType)


def _is_bad(f):
    text = F.trim(F.col(f.name))
    return (text != "") & _parsed(f).isNull()


def _typed(f):
    text = F.trim(F.col(f.name))
    if isinstance(f.dataType, T.StringType):
        return text
    complaint = F.raise_error(F.concat(F.lit(f"{f.name}: "), F.col(f.name), F.lit(" does not parse")))
    # Values that a plain cast does not read are rare. Their path is a lambda, which Spark interprets: with that of every
    # column in it, the generated code of a line would be too long for the JVM to compile.
    rare = F.transform(F.array(F.col(f.name)), lambda c: F.coalesce(_parsed(f, c), complaint.cast(f.dataType)))
    return F.coalesce(text.try_cast(f.dataType), F.when(text != "", F.get(rare, F.lit(0))))


def rejected_lines(spark: SparkSession, path: str, schema=ORDER_DETAIL, **options) -> DataFrame:
    """The lines that ``read_order_detail`` raises on, as text, and ``bad_columns``: names of the values at fault."""
    raw, fields = _raw(spark, path, schema, (), options)
    numbers = [f for f in fields if not isinstance(f.dataType, T.StringType)]
    bad = F.filter(F.array(*[F.when(_is_bad(f), F.lit(f.name)) for f in numbers]), lambda c: c.isNotNull())
    return raw.select(*[f.name for f in fields], F.array_join(bad, ",").alias("bad_columns")).filter("bad_columns <> ''")


def read_order_detail(spark: SparkSession, path: str, strict_times=False, **options) -> DataFrame:
    """The order-line CSV with typed columns. Bad time text becomes null, or raises if ``strict_times``."""
    df = _by_name(spark, path, ORDER_DETAIL, ("order_id", "customer_id", "order_pay_time"), options)
    parse = to_time if strict_times else to_time_or_null
    return df.withColumns({c: parse(F.col(c)) for c in TIME_COLUMNS if c in df.columns})


def read_customers(spark: SparkSession, path: str, numbered=False, **options) -> DataFrame:
    """The customer list, which is also the template of the result file.

    ``numbered`` adds ``place``: the number of the row, from 0, by file name, block of the file and line.
    """
    if not numbered:
        return _by_name(spark, path, CUSTOMERS, ("customer_id",), options)
    where = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
             F.monotonically_increasing_id().alias("line")]
    rows = _by_name(spark, path, CUSTOMERS, ("customer_id",), options, where)
    return global_index(rows, ["file", "block", "line"], "place").drop("file", "block", "line")


def write_csv(df: DataFrame, path: str, index: str | None = None, mode="overwrite", **options):
    """Write CSV with a header; ``index`` names a key column to put first. ``compression="gzip"`` packs each task's file."""
    if index is not None:
        df = df.select(index, *[c for c in df.columns if c != index])
    df.write.mode(mode).options(header=True, **options).csv(path)


def write_features(df: DataFrame, root: str, method: str, split: str):
    """Write one feature table to its ``method``/``split`` partition, replacing only that one."""
    (
        df.drop("method", "split")
        .write.mode("overwrite").parquet(f"{root}/method={method}/split={split}")
    )


def read_features(spark: SparkSession, root: str, method: str, split: str) -> DataFrame:
    """One feature table; only the folder of its partition is read."""
    return spark.read.parquet(f"{root}/method={method}/split={split}")


def write_codes(codes: DataFrame, root: str, name: str):
    """Keep a value → code dictionary."""
    codes.write.mode("overwrite").parquet(f"{root}/{name}")


def read_codes(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}")


def write_candidates(df: DataFrame, path: str, customers_per_chunk=1000, key="customer_id", files_per_chunk=1):
    """Write candidates in chunks of ``customers_per_chunk`` customers, each in its own folder.

    The customers that occur are numbered in the order of ``key``, and each full thousand of them is a
    chunk, however far their numbers lie apart. A customer's rows stay in one file. ``files_per_chunk``
    spreads a chunk over as many tasks; set it with the size of the catalog. Earlier output goes.
    """
    df = stored(df)
    numbers = global_index(df.select(key).distinct(), [key], "_number")
    (
        df.join(numbers, key)
        .withColumn("chunk", F.floor(F.col("_number") / customers_per_chunk).cast("long")).drop("_number")
        .repartition("chunk", F.pmod(F.xxhash64(key), F.lit(files_per_chunk)))
        .write.mode("overwrite").partitionBy("chunk").parquet(path)
    )


def save_model(model, path: str):
    """Keep a model: boosted trees and step models as Parquet tables, pipelines in Spark's own format."""
    if isinstance(model, PipelineModel):
        model.write().overwrite().save(path)
    else:
        model.save(path)


def load_model(path: str):
    """The model kept at ``path``; its kind follows from the folders there."""
    for folder, load in (("nodes", TreeModel.load), ("steps", StepModel.load)):
        try:
            SparkSession.active().read.parquet(f"{path}/{folder}")
        except AnalysisException:
            continue
        return load(path)
    return PipelineModel.load(path)


# How each trainer prints its validation score, one capture group for the number.
LOG_PATTERNS = {
    "lgb": r"valid_0's auc: ([\d.]+)",
    "xgb": r"validation_0-auc:([\d.]+)",
    "mlp": r"auc = ([\d.]+)",
    "reg": r"auc = ([\d.]+)",
}


def read_logs(spark: SparkSession, path, kind: str, metric="auc") -> DataFrame:
    """Scores printed in training logs: (run, iteration, metric, value), iteration counted per file.

    A run is named by its file, and by its folder too if another file has that name. Lines keep their
    place in the file by the start of their block and their order inside it. The numbering is a window
    per file over the matching lines only.
    """
    if kind not in LOG_PATTERNS:
        raise NotImplementedError(f"no log pattern for {kind!r}")
    lines = (
        spark.read.text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
            F.regexp_extract("value", LOG_PATTERNS[kind], 1).alias("text"),
        )
        .filter(F.col("text") != "")
    )
    order = Window.partitionBy("file").orderBy("block", "line")
    files = lines.select("file").distinct().select(
        F.col("file").alias("_file"),
        F.regexp_extract("file", r"([^/]+?)(\.[^./]*)?$", 1).alias("name"),
        F.regexp_extract("file", r"([^/]+/[^/]+?)(\.[^./]*)?$", 1).alias("long_name"),
    )
    alike = F.count(F.lit(1)).over(Window.partitionBy("name"))
    files = files.withColumn("run", F.when(alike > 1, F.col("long_name")).otherwise(F.col("name")))
    return lines.join(files, F.col("file") == F.col("_file")).select(
        "run",
        F.row_number().over(order).alias("iteration"),
        F.lit(metric).alias("metric"),
        F.col("text").cast("double").alias("value"),
    )
