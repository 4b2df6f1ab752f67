"""Queries on boosted trees and on gradient steps, each against SQL that trains the same model."""

from pyspark.sql import functions as F

from buycast.operators.trees import split_importances
from buycast.plans import boosting as B
from buycast.plans import models as L
from buycast.plans import regression as R
from buycast.plans.features import build_splits
from buycast.runtime import stored
from buycast.sources import load_model, save_model
from contract.common import FLOOR, KEY, ORIGIN, SPLITS, cuts_sql, lines, plain, query, r, recursive, rounded, scratch, with_od
from contract.scoring import DAILY_COLUMNS
from contract.sql_features import feature_sql_ctes
from contract.sql_trees import descent_ctes, routed_ctes, tree_ctes

FEATURES = ["payment_sales_days_in_last_91d", "goods_purchase_days_in_last_21d", "payment_sum_month_3_before", "goods_mean_21d_prev_week",
            "payment_mean_14d_decay_prev_week", "goods_first_purchase_from_start_84d"]
LEVELS = {"max_depth": 2, "alpha": 0.25, "lam": 0.25, "min_weight": 3.0}
LEAVES = {"leaves": 4, "alpha": 0.25, "lam": 0.25, "min_weight": 1e-3, "min_rows": 3}
STEP, BINS = 0.3, 64
NODE_COLUMNS = ["tree", "node", "feature", "threshold", "left", "right", "value", "gain", "cover", "n"]


def _splits(spark, sf):
    """The time features used here, rounded, so that both engines train on the same numbers."""
    tables = build_splits(lines(spark, sf, *DAILY_COLUMNS), SPLITS, "time", ord_col=KEY, floor=FLOOR, origin=ORIGIN)
    keep = lambda t: ["customer_id", *[rounded(F.col(c).cast("double")).alias(c) for c in FEATURES], *(["label"] if "label" in t.columns else [])]
    return {name: stored(t.select(*keep(t))) for name, t in tables.items()}


def _model(train, growth, rounds=2, start="half"):
    return B.boost(train, FEATURES, rounds, STEP, B.Growth(**growth), BINS, start=start)


_SPLIT_SQL = (cuts_sql(SPLITS), *feature_sql_ctes("time"), *[
    f"{split} AS MATERIALIZED (SELECT customer_id, label, {', '.join(FEATURES)} FROM features WHERE split = '{split}')"
    for split in ("train", "validation", "test")])
_LEVEL_SQL = (*_SPLIT_SQL, *tree_ctes("train", FEATURES, 2, 2, step=STEP, alpha=0.25, lam=0.25, min_weight=3.0, bins=BINS))
_LEAF_SQL = (*_SPLIT_SQL, *tree_ctes("train", FEATURES, 2, 3, True, STEP, 0.25, 0.25, 1e-3, 3, BINS, mean_start=True))
_NODES_SQL = f"""SELECT CAST(tree AS BIGINT) AS tree, CAST(node AS BIGINT) AS node, feature, {r('threshold')} AS threshold,
  CAST(left_node AS BIGINT) AS "left", CAST(right_node AS BIGINT) AS "right", {r('value')} AS value, {r('gain')} AS gain, {r('cover')} AS cover,
  CAST(n AS BIGINT) AS n FROM nodes"""


@query(with_od(_NODES_SQL, *_LEVEL_SQL))
def boosted_tree_nodes(spark, sf):
    """Two rounds of depth 2: splits, gains and leaf values with L1 and L2 terms and a least hessian."""
    return plain(_model(_splits(spark, sf)["train"], LEVELS).node_table(spark).select(*NODE_COLUMNS))


@query(with_od(_NODES_SQL, *_LEAF_SQL))
def leaf_limited_tree_nodes(spark, sf):
    """Two rounds of four leaves, grown best-first from the log odds of the labels."""
    return plain(_model(_splits(spark, sf)["train"], LEAVES, start="mean").node_table(spark).select(*NODE_COLUMNS))


@query(recursive(f"SELECT customer_id, {r('1 / (1 + exp(-sum(value)))')} AS probability, {r('sum(value)')} AS margin FROM steps_of GROUP BY customer_id",
                 *_LEVEL_SQL, *routed_ctes("test", FEATURES)))
def stored_tree_scores(spark, sf):
    """Scores of the test split by the stored node table, as one expression of built-in functions."""
    splits, path = _splits(spark, sf), scratch(spark, "trees")
    save_model(_model(splits["train"], LEVELS), path)
    margin = load_model(path).margin_expression()
    scored = splits["test"].select("customer_id", margin.alias("margin"))
    return plain(scored.select("customer_id", (1 / (1 + F.exp(-F.col("margin")))).alias("probability"), "margin"))


_STAGED_SQL = [
    """staged AS (
  SELECT s.customer_id, s.tree + 1 AS iteration, v.label, sum(s.value) OVER (PARTITION BY s.customer_id ORDER BY s.tree) AS margin
  FROM steps_of s JOIN validation v USING (customer_id))""",
    """curve AS (
  SELECT iteration, sum(wins) / (sum(label) * sum(1 - label)) AS auc FROM (
    SELECT iteration, label, CASE WHEN label = 1 THEN coalesce(sum(1 - label) OVER below, 0) + (sum(1 - label) OVER alike) / 2.0 ELSE 0 END AS wins FROM staged
    WINDOW below AS (PARTITION BY iteration ORDER BY margin RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP),
      alike AS (PARTITION BY iteration, margin))
  GROUP BY iteration)""",
    """losses AS (
  SELECT iteration, avg(greatest(margin, 0) - margin * label + ln(1 + exp(-abs(margin)))) AS loss FROM staged GROUP BY iteration)""",
]


@query(recursive(f"""SELECT CAST(iteration AS BIGINT) AS iteration, {r('auc')} AS auc, {r('loss')} AS loss,
  CAST(iteration = (SELECT min(iteration) FROM curve WHERE auc = (SELECT max(auc) FROM curve)) AS BIGINT) AS best FROM curve JOIN losses USING (iteration)""",
                 *_LEVEL_SQL, *routed_ctes("validation", FEATURES), *_STAGED_SQL))
def staged_tree_curve(spark, sf):
    """AUC and log loss on the validation split after each round of one fit, and which round is the best."""
    splits = _splits(spark, sf)
    model = _model(splits["train"], LEVELS)
    best = B.best_round(model, splits["validation"])
    curve = B.staged_auc(model, splits["validation"]).join(B.staged_loss(model, splits["validation"]), "iteration")
    return plain(curve.select("iteration", "auc", "loss", (F.col("iteration") == best).alias("best")))


@query(with_od(f"""SELECT feature, CAST(count(*) AS BIGINT) AS splits, {r('sum(gain)')} AS gain, {r('sum(cover)')} AS cover
  FROM nodes WHERE feature IS NOT NULL GROUP BY feature""", *_LEAF_SQL))
def split_importance(spark, sf):
    """How often each feature splits, and what its splits gain and cover."""
    model = _model(_splits(spark, sf)["train"], LEAVES, start="mean")
    return plain(split_importances(model.node_table(spark)))


_STEP_FEATURES = ["payment_sales_days_in_last_91d", "goods_purchase_days_in_last_21d", "payment_sum_month_3_before"]


@query(with_od(" UNION ALL ".join(
    f"SELECT CAST({t} AS BIGINT) AS iteration, {feature} AS feature, round(w{i} + 1e-9, 7) AS weight FROM weights{t}"
    for t in range(1, 6) for i, feature in enumerate(["NULL", *[f"'{f}'" for f in _STEP_FEATURES]])),
    *_SPLIT_SQL, *descent_ctes("train", _STEP_FEATURES, 5)))
def regression_steps(spark, sf):
    """Weights after each of five full-batch gradient steps from zero."""
    model = R.descend(_splits(spark, sf)["train"], _STEP_FEATURES, steps=5)
    return model.weight_table(spark).select(F.col("iteration").cast("bigint").alias("iteration"), "feature", F.round(F.col("weight") + 1e-9, 7).alias("weight"))


_SCALED = " + ".join(["w0", *[f"w{i} * ({f} - m{i}) / s{i}" for i, f in enumerate(_STEP_FEATURES, 1)]])
_STEP_CURVE = [
    "staged AS (" + " UNION ALL ".join(
        f"SELECT {t} AS iteration, label, round({_SCALED}, 9) AS margin FROM validation, stats, weights{t}" for t in range(1, 6)) + ")",
    _STAGED_SQL[1]]


@query(with_od("SELECT CAST(iteration AS BIGINT) AS iteration, round(auc, 3) AS auc FROM curve", *_SPLIT_SQL, *descent_ctes("train", _STEP_FEATURES, 5), *_STEP_CURVE))
def regression_step_curve(spark, sf):
    """AUC on the validation split after each gradient step."""
    splits = _splits(spark, sf)
    curve = R.descend(splits["train"], _STEP_FEATURES, steps=5).staged_auc(splits["validation"])
    return curve.select(F.col("iteration").cast("bigint").alias("iteration"), F.round("auc", 3).alias("auc"))


def _permuted_sql(table):
    """Per feature, the table with that feature's values moved round in the order of a hash, under the key customer-feature."""
    out = []
    for i, f in enumerate(FEATURES):
        kept = ", ".join("o." + c if c == f else "t." + c for c in FEATURES)
        out.append(f"""SELECT t.customer_id || '-{f}' AS customer_id, t.label, {kept} FROM placed t
  JOIN placed o ON o.at = (t.at + (SELECT count(*) FROM placed) * {i + 1} // {len(FEATURES) + 1}) % (SELECT count(*) FROM placed)""")
    return [f"placed AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY md5(CAST(customer_id AS VARCHAR)), customer_id) - 1 AS at FROM {table})",
            "permuted AS MATERIALIZED (" + " UNION ALL ".join(out) + f" UNION ALL SELECT customer_id || '-', label, {', '.join(FEATURES)} FROM {table})"]


_PERMUTED_CURVE = [
    """staged AS (SELECT split_part(customer_id, '-', 2) AS iteration, label, margin FROM permuted JOIN (
  SELECT customer_id, sum(value) AS margin FROM steps_of GROUP BY customer_id) USING (customer_id))""",
    _STAGED_SQL[1]]


@query(recursive(f"""SELECT iteration AS feature, {r('auc')} AS auc, {r("(SELECT auc FROM curve WHERE iteration = '') - auc")} AS "drop"
  FROM curve WHERE iteration <> ''""", *_LEVEL_SQL, *_permuted_sql("train"), *routed_ctes("permuted", FEATURES), *_PERMUTED_CURVE))
def permutation_importance(spark, sf):
    """How far the AUC on the training split falls when one column is permuted."""
    train = _splits(spark, sf)["train"]
    return plain(L.permutation_importances(_model(train, LEVELS), train, FEATURES))
