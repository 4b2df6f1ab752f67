"""Classifiers on feature tables: boosted trees and gradient steps of our own, the others from Spark ML."""

import functools

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import FMClassifier, LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import HashingTF, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buycast.operators.metrics import auc
from buycast.operators.metrics import metrics as metric_table
from buycast.operators.submit import BUY_NUM, flag_top_n
from buycast.operators.trees import TreeModel, split_importances
from buycast.plans import boosting
from buycast.plans.regression import descend
from buycast.runtime import dealt, global_index, side_by_side, stored
from buycast.sources import write_csv

SEED = 3407

# Starting parameters per model. Trees take fewer and larger steps than the 2,500 of 0.005 that the same
# growth is known to do well with; rounds and step are parameters.
DEFAULTS = {
    "reg": {"maxIter": 400, "regParam": 0.0, "tol": 1e-8},
    "gd": {"steps": 400, "rate": 0.1},
    "xgb": {"rounds": 20, "step": 0.3, "max_depth": 5, "alpha": 0.25, "lam": 0.25, "min_weight": 3.0},
    "lgb": {"rounds": 20, "step": 0.3, "leaves": 31, "alpha": 0.25, "lam": 0.25, "min_weight": 1e-3, "min_rows": 3, "start": "mean"},
    "mlp": {"hidden": [128, 128, 64], "maxIter": 100, "seed": SEED},
    "fm": {"factorSize": 64, "maxIter": 50, "stepSize": 0.01, "seed": SEED, "numFeatures": 1 << 14},
}
TREES = ("xgb", "lgb")


class Trees:
    """Unfitted boosted trees: the parameters of ``boosting.boost`` and ``boosting.Growth`` by name."""

    def __init__(self, features, label="label", rounds=20, step=0.3, bins=255, start="half", evaluation=None, patience=None, **growth):
        self.args = list(features), rounds, step, boosting.Growth(**growth), bins, label, start, evaluation, patience

    def fit(self, train: DataFrame) -> TreeModel:
        return boosting.boost(train, *self.args)


class Steps:
    """Unfitted logistic regression by gradient steps: the parameters of ``regression.descend``."""

    def __init__(self, features, label="label", **params):
        self.args, self.params = (list(features),), {**params, "label": label}

    def fit(self, train: DataFrame):
        return descend(train, *self.args, **self.params)


def standardize(df: DataFrame, cols, stats: DataFrame | None = None):
    """(standardised df, stats): subtract the mean, divide by the population deviation, 0 deviation counts as 1.

    Pass the ``stats`` of the training table to treat other tables alike. They are one row, read
    through a scalar subquery.
    """
    if stats is None:
        stats = df.agg(
            *[F.avg(F.col(c).cast("double")).alias(f"mean_{c}") for c in cols],
            *[F.stddev_pop(F.col(c).cast("double")).alias(f"std_{c}") for c in cols],
        )
    one = stats.agg(F.first(F.struct(*stats.columns))).scalar()
    spread = {c: F.when(F.col(f"_s.std_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"_s.std_{c}")) for c in cols}
    out = df.withColumn("_s", one)
    return out.select(*[
        ((F.col(c) - F.col(f"_s.mean_{c}")) / spread[c]).alias(c) if c in spread else F.col(c) for c in df.columns
    ]), stats


def get_estimator(name: str, features=None, params=None, label="label"):
    """An unfitted model by name; unknown names raise."""
    if name not in DEFAULTS:
        raise NotImplementedError(f"unknown model {name!r}")
    p = {**DEFAULTS[name], **(params or {})}
    if name in TREES:
        return Trees(features, label, **p)
    if name == "gd":
        return Steps(features, label, **p)
    if name == "fm":
        width = p.pop("numFeatures")
        return Pipeline(stages=[
            HashingTF(inputCol="user_tokens", outputCol="user_vector", numFeatures=width, binary=True),
            HashingTF(inputCol="item_tokens", outputCol="item_vector", numFeatures=width, binary=True),
            VectorAssembler(inputCols=["user_vector", "item_vector"], outputCol="features"),
            FMClassifier(labelCol=label, featuresCol="features", **p),
        ])
    assemble = VectorAssembler(inputCols=list(features), outputCol="raw")
    scale = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)
    if name == "reg":
        return Pipeline(stages=[assemble, scale, LogisticRegression(labelCol=label, **p)])
    layers = [len(features), *p.pop("hidden"), 2]
    return Pipeline(stages=[assemble, scale, MultilayerPerceptronClassifier(labelCol=label, layers=layers, **p)])


def fit(name: str, train_df: DataFrame, features=None, params=None, label="label"):
    """The fitted model. Spark ML's trainers pass over the rows as they lie, so these are dealt out before."""
    own = name in TREES or name == "gd"
    return get_estimator(name, features, params, label).fit(train_df if own else dealt(train_df))


def score(model, df: DataFrame, keep=("customer_id",)) -> DataFrame:
    """``keep`` columns and ``score``, the probability of class 1."""
    probability = vector_to_array("probability")[1] if isinstance(model, PipelineModel) else F.col("probability")
    return model.transform(df).select(*keep, probability.alias("score"))


def submit(name: str, splits, features, path: str, n=BUY_NUM + 1, params=None):
    """The whole job: fit on ``splits["train"]``, score ``splits["test"]``, flag the ``n`` most likely buyers and write
    them to ``path`` as CSV, sorted by customer. Returns the model."""
    model = fit(name, splits["train"], features, params)
    write_csv(flag_top_n(score(model, splits["test"]), n=n), path, index="customer_id")
    return model


def fit_best(name, train_df, eval_df, features=None, steps=(1, 5, 10, 20), params=None, label="label"):
    """(model, iterations): the iteration with the best AUC on ``eval_df``; the earliest of equals.

    Boosted trees are fitted once and cut after their best round; other models are fitted once per entry of ``steps``.
    """
    if name in TREES:
        model = fit(name, train_df, features, params, label)
        best = boosting.best_round(model, eval_df, label)
        return model.first(best), best
    best = None
    for n in steps:
        model = fit(name, train_df, features, {**(params or {}), "maxIter": n}, label)
        value = quick_auc(model, eval_df, label)
        if best is None or value > best[0]:
            best = (value, model, n)
    return best[1:]


def evaluate(model, df: DataFrame, label="label") -> DataFrame:
    """One row of metrics of the model on a labelled table, each row of which is scored once: two steps read the scores."""
    return metric_table(stored(score(model, df, (label,))), label, "score")


def quick_auc(model, df: DataFrame, label="label") -> float:
    """Spark's own area under the curve of the probability, as a cross-check."""
    judge = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="probability", numBins=0)
    return judge.evaluate(model.transform(df))


def learning_curve(name, train_df, eval_df, features=None, steps=(1, 5, 10, 20), params=None, label="label",
                   run=None) -> DataFrame:
    """(run, iteration, metric, value): AUC on ``eval_df`` by iteration.

    Boosted trees and gradient steps ("gd") are fitted once and give every iteration that they keep; other
    models are fitted once per entry of ``steps``.
    """
    spark = train_df.sparkSession
    if name in TREES or name == "gd":
        model = fit(name, train_df, features, params, label)
        curve = model.staged_auc(eval_df, label) if name == "gd" else boosting.staged_auc(model, eval_df, label)
        return curve.select(F.lit(run or name).alias("run"), F.col("iteration").cast("int").alias("iteration"), F.lit("auc").alias("metric"),
                            F.col("auc").alias("value"))
    rows = []
    for n in steps:
        model = fit(name, train_df, features, {**(params or {}), "maxIter": n}, label)
        rows.append((run or name, int(n), "auc", float(quick_auc(model, eval_df, label))))
    return spark.createDataFrame(rows, "run string, iteration int, metric string, value double")


def loss_per_round(model: TreeModel, df: DataFrame, label="label", run="trees") -> DataFrame:
    """(run, iteration, metric, value): mean log loss of boosted trees after each round."""
    losses = boosting.staged_loss(model, df, label)
    return losses.select(F.lit(run).alias("run"), F.col("iteration").cast("int").alias("iteration"), F.lit("loss").alias("metric"),
                         F.col("loss").alias("value"))


def compare_feature_sets(tables, models=("reg", "xgb"), features=None, steps=(1, 5, 10), params=None) -> DataFrame:
    """Learning curves of every model on every feature set. ``tables``: {method: (train, validation)}."""
    def curve(method, name):
        return learning_curve(name, *tables[method], features[method], steps, (params or {}).get(name), run=f"{name}_{method}")

    # each curve is a long row of short jobs that need no other curve's
    curves = side_by_side([functools.partial(curve, method, name) for method in tables for name in models])
    return functools.reduce(DataFrame.unionByName, curves)


def importances(model: TreeModel, spark, top=10, kind="gain") -> DataFrame:
    """(feature, importance) of boosted trees, highest first, those without a split 0: the share of the ``gain``, or
    the number of ``splits``."""
    table = split_importances(model.node_table(spark))
    unused = spark.createDataFrame([(f,) for f in model.features], "feature string")
    value = F.col(kind) if kind == "splits" else F.col(kind) / table.agg(F.sum(kind)).scalar()
    table = unused.join(table.select("feature", value.cast("double").alias("importance")), "feature", "left").fillna(0.0)
    return table.orderBy(F.desc("importance"), "feature").limit(top)


def permutation_importances(model, df: DataFrame, features, key="customer_id", label="label") -> DataFrame:
    """(feature, auc, drop): AUC on ``df`` with one column permuted, and how far that lies below the AUC as it is.

    Rows are numbered in the order of a hash of their ``key``, by a range sort. For the i-th feature, the row
    numbered r gets the value of the row (i + 1) / (features + 1) of the way round from r: a permutation, the same
    in every run. Each feature is one join and one scoring pass.
    """
    rows = stored(global_index(df.filter(F.col(label).isNotNull()), [F.md5(F.col(key).cast("string")), F.col(key)], "_at"))
    n = rows.count()
    spark = df.sparkSession
    plain, out = auc(score(model, rows, (label,)), label, "score").first().auc, []
    for i, f in enumerate(features):
        shift = n * (i + 1) // (len(features) + 1)
        moved = rows.select(F.pmod(F.col("_at") - shift, F.lit(max(n, 1))).alias("_at"), F.col(f"`{f}`"))
        permuted = rows.drop(f).join(moved, "_at")
        value = auc(score(model, permuted, (label,)), label, "score").first().auc
        out.append((f, value, None if plain is None else plain - value))
    return spark.createDataFrame(out, "feature string, auc double, drop double")
