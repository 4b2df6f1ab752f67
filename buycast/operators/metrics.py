"""Exact classification metrics as DataFrames of one row."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buycast.functions.numbers import ratio
from buycast.runtime import running_totals

NAMES = ("auc", "accuracy", "precision", "recall", "f1")


def auc(df: DataFrame, label="label", prob="probability", groups=()) -> DataFrame:
    """Area under the ROC curve, ties counted half; null if only one class occurs. With ``groups``, a row for each.

    Rows are reduced to one per distinct score before anything is sorted.
    """
    is_pos = F.col(label) == 1
    per_score = (
        df.filter(F.col(label).isNotNull())
        .groupBy(*groups, F.col(prob).alias("score"))
        .agg(F.count_if(is_pos).alias("pos"), F.count_if(~is_pos).alias("neg"))
    )
    ranked = running_totals(per_score, "score", ["neg"], groups)
    wins = F.sum(F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return (ranked.groupBy(*groups) if groups else ranked).agg(F.try_divide(wins, pairs).alias("auc"))


def _counts(df, label, prob, threshold):
    hit, real = F.col(prob) >= threshold, F.col(label) == 1
    return df.filter(F.col(label).isNotNull()).agg(
        F.count_if(hit & real).alias("tp"), F.count_if(hit & ~real).alias("fp"),
        F.count_if(~hit & real).alias("fn"), F.count_if(~hit & ~real).alias("tn"),
    )


def metrics(df: DataFrame, label="label", prob="probability", threshold=0.5) -> DataFrame:
    """(auc, accuracy, precision, recall, f1); a ratio with nothing to divide by is 0."""
    zero = F.lit(0.0)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    rates = _counts(df, label, prob, threshold).select(
        F.coalesce(ratio(tp + tn, tp + fp + fn + tn), zero).alias("accuracy"),
        F.coalesce(ratio(tp, tp + fp), zero).alias("precision"),
        F.coalesce(ratio(tp, tp + fn), zero).alias("recall"),
        F.coalesce(ratio(2 * tp, 2 * tp + fp + fn), zero).alias("f1"),
    )
    return rates.withColumn("auc", auc(df, label, prob).scalar()).select(*NAMES)


def metric(df: DataFrame, name: str, label="label", prob="probability", threshold=0.5) -> DataFrame:
    """One metric by name as (value)."""
    if name not in NAMES:
        raise NotImplementedError(f"unknown metric {name!r}")
    table = auc(df, label, prob) if name == "auc" else metrics(df, label, prob, threshold)
    return table.select(F.col(name).alias("value"))


def mean_loss(df: DataFrame, label="label", score="score", kind="bce") -> DataFrame:
    """Mean loss over the rows: ``bce`` of logits, in the form that cannot overflow, or ``mse``."""
    y, z = F.col(label).cast("double"), F.col(score)
    if kind == "bce":
        loss = F.greatest(z, F.lit(0.0)) - z * y + F.log1p(F.exp(-F.abs(z)))
    elif kind == "mse":
        loss = (z - y) * (z - y)
    else:
        raise NotImplementedError(f"unknown loss {kind!r}")
    return df.agg(F.avg(loss).alias("loss"))


def best_iteration(metric_df: DataFrame) -> DataFrame:
    """(run, iteration, value): per run the first iteration with the highest value."""
    best = F.max_by(F.struct("iteration", "value"), F.struct("value", (-F.col("iteration")).alias("early")))
    return metric_df.groupBy("run").agg(best.alias("b")).select("run", "b.iteration", "b.value")


def compare_runs(metric_df: DataFrame) -> DataFrame:
    """(run, iterations, first, last, best, best_iteration): the curves of several runs side by side."""
    at = F.struct("value", (-F.col("iteration")).alias("early"))
    return (
        metric_df.groupBy("run").agg(
            F.count(F.lit(1)).alias("iterations"),
            F.min_by("value", "iteration").alias("first"),
            F.max_by("value", "iteration").alias("last"),
            F.max("value").alias("best"),
            F.max_by("iteration", at).alias("best_iteration"),
        )
        .orderBy(F.desc("best"), "run")
    )
