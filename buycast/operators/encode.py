"""Value ↔ code dictionaries."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buycast.runtime import global_index


def _codes(values: DataFrame, start) -> DataFrame:
    return global_index(values.filter(F.col("value").isNotNull()).distinct(), ["value"], "idx", start)


def fit_codes(df: DataFrame, col: str, start=0) -> DataFrame:
    """(value, idx): the distinct values as text, numbered in text order."""
    return _codes(df.select(F.col(col).cast("string").alias("value")), start)


def dense_ids(df: DataFrame, col: str, start=1) -> DataFrame:
    """(value, idx): the distinct values in their own order, numbered from 1; 0 stays free for padding."""
    return _codes(df.select(F.col(col).alias("value")), start)


def _lookup(df, codes, col, key, value):
    side = codes.select(F.col(key).alias(col), F.col(value).alias("_code"))
    return df.join(side, col, "left")


def apply_codes(df: DataFrame, codes: DataFrame, col: str, unseen=-1, out=None) -> DataFrame:
    """Replace ``col`` (or add ``out``) by its code; values the dictionary lacks become ``unseen``."""
    out = out or col
    keyed = df.withColumn("_key", F.col(col).cast(codes.schema["value"].dataType))
    coded = _lookup(keyed, codes, "_key", "value", "idx")
    code = F.coalesce(F.col("_code"), F.lit(unseen)) if unseen is not None else F.col("_code")
    names = [*df.columns, *([] if out in df.columns else [out])]
    return coded.withColumn(out, code).select(*names)


def encode_each(frames, col: str):
    """Fit and apply per frame; codes of different frames cannot be compared."""
    return [apply_codes(f, fit_codes(f, col), col) for f in frames]


def decode(df: DataFrame, codes: DataFrame, idx_col: str, out="value") -> DataFrame:
    """Add the value behind a code."""
    joined = _lookup(df, codes, idx_col, "idx", "value")
    return joined.withColumnRenamed("_code", out).select(*df.columns, out)


def known_only(df: DataFrame, codes: DataFrame, col: str, out: str) -> DataFrame:
    """Rows whose value is in the dictionary, with its code; repeated rows stay."""
    side = codes.select(F.col("value").alias(col), F.col("idx").alias(out))
    return df.join(side, col)


def vocab_sizes(**dictionaries: DataFrame) -> DataFrame:
    """(name, size): number of codes plus one for the padding code 0."""
    parts = [
        codes.agg((F.count(F.lit(1)) + 1).alias("size")).select(F.lit(name).alias("name"), "size")
        for name, codes in dictionaries.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def last_pair(df: DataFrame, key: str, value: str, ord_col) -> DataFrame:
    """(key, value) with the value of the latest line of each key."""
    order = [ord_col] if isinstance(ord_col, str) else list(ord_col)
    return df.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(value))
