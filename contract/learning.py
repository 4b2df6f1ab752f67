"""Queries that train and score models.

Boosted trees are checked against SQL that grows the same trees, at the defaults and on all features. What the
other models learn from real labels is checked by rows, and by tests on data with a known signal. Where SQL knows what
a model must arrive at, that is checked: a label that follows from a feature is predicted for every customer, and a
regression at its optimum balances the labels and the probabilities.
"""

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buycast.operators.metrics import compare_runs
from buycast.operators.sequences import encode_events, sequence_samples
from buycast.operators.submit import flag_top_n
from buycast.plans import models as L
from buycast.plans import recommend as R
from buycast.plans.features import build_splits, feature_columns
from buycast.runtime import side_by_side, stored
from buycast.sources import load_model, save_model
from contract.common import (
    FLOOR, KEY, ORIGIN, PREDICT_MONTH, SPLITS, TEST_MONTH, TOP_N, TRAIN_MONTH, cuts_sql, lines, plain, query, r, recursive, rounded, scratch,
    with_od,
)
from contract.sql_features import feature_sql_ctes
from contract.scoring import DAILY_COLUMNS, EVENT_COLUMNS
from contract.sql_trees import routed_ctes, tree_ctes

# Fewer steps than the defaults where a query would take minutes on small tables.
FEWER = {"mlp": {"maxIter": 30}, "fm": {"factorSize": 8, "maxIter": 10, "numFeatures": 1 << 12}}
TIME = feature_columns("time")


def _splits(spark, sf, method="time"):
    rows = lines(spark, sf) if method != "time" else lines(spark, sf, *DAILY_COLUMNS)
    tables = build_splits(rows, SPLITS, method, ord_col=KEY, floor=FLOOR, origin=ORIGIN)
    # without dictionaries to join, a split is a folder of the features written
    return tables if method == "time" else {name: stored(table) for name, table in tables.items()}


def _rounded_splits(spark, sf):
    """The same numbers as in the SQL, so that both engines grow trees from them."""
    return {name: t.withColumns({c: rounded(F.col(c).cast("double")) for c in TIME}) for name, t in _splits(spark, sf).items()}


_GROWTH = {k: v for k, v in L.DEFAULTS["xgb"].items() if k in ("step", "alpha", "lam", "min_weight")}
_GROWN_SQL = (cuts_sql(SPLITS), *feature_sql_ctes("time"), *[
    f"{split} AS MATERIALIZED (SELECT customer_id, label, {', '.join(TIME)} FROM features WHERE split = '{split}')"
    for split in ("train", "validation", "test")],
    *tree_ctes("train", TIME, L.DEFAULTS["xgb"]["rounds"], L.DEFAULTS["xgb"]["max_depth"], **_GROWTH))


def _scores(spark, sf, name):
    """Trained on the train split; the buyers it writes for the test split, with the scores of the stored model."""
    splits = _rounded_splits(spark, sf)
    path, buyers = scratch(spark, f"model-{name}"), scratch(spark, f"buyers-{name}")
    save_model(L.submit(name, splits, TIME, buyers, TOP_N, FEWER.get(name)), path)
    scored = L.score(load_model(path), splits["test"])
    written = spark.read.schema("customer_id long, score double, result int").option("header", True).csv(buyers)
    return flag_top_n(scored, n=TOP_N).select("customer_id", "score").join(written.drop("score"), "customer_id")


@query()
def buyers_by_logistic_regression(spark, sf):
    return _scores(spark, sf, "reg")


@query(recursive(f"""SELECT customer_id, {r('score')} AS score,
  CAST(row_number() OVER (ORDER BY score DESC, customer_id) <= {TOP_N} AS BIGINT) AS result
FROM (SELECT customer_id, 1 / (1 + exp(-list_sum(list(value ORDER BY tree)))) AS score FROM steps_of GROUP BY customer_id)""",
                 *_GROWN_SQL, *routed_ctes("test", TIME)))
def buyers_by_boosted_trees(spark, sf):
    return plain(_scores(spark, sf, "xgb"))


@query()
def buyers_by_leaf_limited_trees(spark, sf):
    return _scores(spark, sf, "lgb")


@query()
def buyers_by_perceptron(spark, sf):
    return _scores(spark, sf, "mlp")


@query()
def validation_metrics_of_models(spark, sf):
    splits = _splits(spark, sf)

    def judged(name):
        return L.evaluate(L.fit(name, splits["train"], TIME, FEWER.get(name)), splits["validation"]).withColumn("model", F.lit(name))

    return functools.reduce(DataFrame.unionByName, side_by_side([functools.partial(judged, n) for n in ("reg", "xgb", "lgb", "mlp")]))


@query(with_od(f"""SELECT feature, {r('coalesce(gain, 0) / (SELECT sum(gain) FROM nodes)')} AS importance
  FROM (SELECT unnest([{', '.join(f"'{c}'" for c in TIME)}]) AS feature) LEFT JOIN (
    SELECT feature, sum(gain) AS gain FROM nodes WHERE feature IS NOT NULL GROUP BY feature) USING (feature)
  ORDER BY coalesce(gain, 0) DESC, feature LIMIT 10""", *_GROWN_SQL))
def top_feature_importances(spark, sf):
    model = L.fit("xgb", _rounded_splits(spark, sf)["train"], TIME)
    return plain(L.importances(model, spark, top=10))


@query(recursive(f"""SELECT 'trees' AS run, CAST(iteration AS BIGINT) AS iteration, 'loss' AS metric,
  {r('avg(greatest(margin, 0) - margin * label + ln(1 + exp(-abs(margin))))')} AS value
FROM (SELECT s.tree + 1 AS iteration, v.label, sum(s.value) OVER (PARTITION BY s.customer_id ORDER BY s.tree) AS margin
  FROM steps_of s JOIN validation v USING (customer_id)) GROUP BY iteration""", *_GROWN_SQL, *routed_ctes("validation", TIME)))
def loss_per_boosting_round(spark, sf):
    splits = _rounded_splits(spark, sf)
    return plain(L.loss_per_round(L.fit("xgb", splits["train"], TIME), splits["validation"]))


@query()
def feature_set_comparison(spark, sf):
    """AUC curves of four models on three feature sets, side by side; trees take 5 rounds, gradient descent 20 steps."""
    methods = ("agg", "time", "both")
    splits = side_by_side([functools.partial(_splits, spark, sf, method) for method in methods])
    tables = {method: (s["train"], s["validation"]) for method, s in zip(methods, splits)}
    features = {method: feature_columns(method) for method in methods}
    params = {"gd": {"steps": 20}, "xgb": {"rounds": 5}, "lgb": {"rounds": 5}}
    return compare_runs(L.compare_feature_sets(tables, ("gd", "xgb", "lgb", "mlp"), features, steps=(30,), params=params))


@query()
def recommender_scores_of_test_month(spark, sf):
    """Metrics of the factorisation model, trained on one month with all its steps, on the samples of the next."""
    events, _ = encode_events(lines(spark, sf, *EVENT_COLUMNS), KEY)
    model = R.fit_recommender(stored(sequence_samples(events, TRAIN_MONTH, KEY)))
    samples = R.item_tokens(R.user_tokens(sequence_samples(events, TEST_MONTH, KEY)))
    return L.evaluate(model, samples)


@query()
def buyers_by_recommender(spark, sf):
    """Best good of the whole catalog for every listed customer, as a buyer list."""
    listed = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("customer_id"))
    return R.recommend_buyers(lines(spark, sf, *EVENT_COLUMNS), listed, TRAIN_MONTH, PREDICT_MONTH, KEY, FEWER["fm"])


# A label that follows from the first of these features: did the customer pay for anything in the last 91 days?
_GIVEN = ["payment_sales_days_in_last_91d", "goods_mean_21d_prev_week", "payment_sum_month_3_before"]
_PAID = "payment_sales_days_in_last_91d > 0"
_TIME_SQL = (cuts_sql(SPLITS), *feature_sql_ctes("time"))


def _with_known_label(table):
    return table.select("customer_id", *[F.greatest(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in _GIVEN]).withColumn(
        "label", (F.col(_GIVEN[0]) > 0).cast("int"))


def _known_label_predicted(spark, sf, name):
    """The class that a stored and reloaded model gives each customer of every split, trained on the first."""
    splits = {k: _with_known_label(t) for k, t in _splits(spark, sf).items()}
    path = scratch(spark, f"known-{name}")
    save_model(L.fit(name, splits["train"], _GIVEN), path)
    model, out = load_model(path), None
    for split, table in splits.items():
        one = L.score(model, table).select(
            F.lit(split).alias("split"), "customer_id", (F.col("score") > 0.5).cast("long").alias("predicted"))
        out = one if out is None else out.unionByName(one)
    return plain(out)


_KNOWN = with_od(f"SELECT split, customer_id, CAST({_PAID} AS BIGINT) AS predicted FROM features", *_TIME_SQL)


@query(_KNOWN)
def known_label_by_boosted_trees(spark, sf):
    return _known_label_predicted(spark, sf, "xgb")


@query(_KNOWN)
def known_label_by_finer_boosted_trees(spark, sf):
    return _known_label_predicted(spark, sf, "lgb")


@query(_KNOWN)
def known_label_by_perceptron(spark, sf):
    return _known_label_predicted(spark, sf, "mlp")


@query(with_od(f"""SELECT split, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE {_PAID}) AS BIGINT) AS buyers,
  1.0::DOUBLE AS auc, 1.0::DOUBLE AS f1 FROM features GROUP BY split""", *_TIME_SQL))
def metrics_on_known_label(spark, sf):
    """The model's metrics on every split, with the split's size and buyers."""
    splits, out = {k: _with_known_label(t) for k, t in _splits(spark, sf).items()}, None
    model = L.fit("xgb", splits["train"], _GIVEN)
    for split, table in splits.items():
        size = table.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("buyers"))
        one = L.evaluate(model, table).select("auc", "f1").join(size).withColumn("split", F.lit(split))
        out = one if out is None else out.unionByName(one)
    return plain(out)


@query(with_od(f"""SELECT CAST(1 AS BIGINT) AS place, arg_max(name, agrees) AS feature, CAST(max(agrees) AS BIGINT) AS agrees FROM (
  {" UNION ALL ".join(f"SELECT '{c}' AS name, count(*) FILTER (WHERE ({c} > 0) = ({_PAID})) AS agrees FROM features WHERE split = 'train'" for c in _GIVEN)})
""", *_TIME_SQL))
def first_importance_on_known_label(spark, sf):
    """The most important feature is the one that agrees with the label in most rows."""
    train = _with_known_label(_splits(spark, sf)["train"])
    model = L.fit("xgb", train, _GIVEN)
    top = L.importances(model, spark, top=1).select("feature")
    agrees = train.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("name"), ((F.col(c) > 0).cast("int") == F.col("label")).cast("long").alias("same")) for c in _GIVEN])))
    agrees = agrees.groupBy("name").agg(F.sum("same").alias("agrees"))
    return plain(top.join(agrees, F.col("feature") == F.col("name")).select(F.lit(1).alias("place"), "feature", "agrees"))


_BALANCED = ["payment_sales_days_in_last_91d", "goods_purchase_days_in_last_21d"]


@query(with_od("SELECT count(*) AS n, round(avg(label) + 1e-7, 3) AS mean_label, " + ", ".join(
    f"round(avg(label * greatest({c}, 0)) + 1e-7, 3) AS balance_{c}" for c in _BALANCED)
    + " FROM features WHERE split = 'train'", *_TIME_SQL))
def balance_of_logistic_regression(spark, sf):
    """At the optimum, probabilities and labels have the same mean and the same mean product with every feature."""
    train = _splits(spark, sf)["train"].select("customer_id", "label", *[
        F.greatest(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in _BALANCED])
    scored = L.score(L.fit("reg", train, _BALANCED), train, ("customer_id", *_BALANCED))
    near = lambda c: F.round(c + 1e-7, 3)
    return scored.agg(F.count(F.lit(1)).alias("n"), near(F.avg("score")).alias("mean_label"), *[
        near(F.avg(F.col("score") * F.col(c))).alias(f"balance_{c}") for c in _BALANCED])
