import math
import random

import pytest
from pyspark.sql import functions as F

from buycast.operators.trees import TreeModel, split_importances
from buycast.plans import boosting as B
from buycast.plans import models as L
from buycast.plans import regression as R
from buycast.sources import load_model, save_model

FEATURES = ["a", "b", "c"]


def rows_of(n, seed, gaps=True):
    rng, out = random.Random(seed), []
    for i in range(n):
        a, b, c = rng.randrange(12), round(rng.gauss(0, 1), 1), rng.choice([0.0, 1.0])
        label = int(a + 3 * b * c + rng.gauss(0, 2) > 6)
        if gaps:
            a, b = (None if rng.random() < 0.2 else a), (float("nan") if rng.random() < 0.1 else b)
        out.append((i, None if a is None else float(a), b, c, label))
    return out


@pytest.fixture(scope="module")
def make(spark):
    kind = "customer_id long, a double, b double, c double, label int"
    return lambda rows: spark.createDataFrame(rows, kind).repartition(3)


def lost(x):
    return x is None or math.isnan(x)


def worth(rows, alpha, lam):
    g, h = sum(r[0] for r in rows), sum(r[1] for r in rows)
    return max(abs(g) - alpha, 0) ** 2 / (h + lam)


def best_split(rows, alpha, lam, min_weight, min_rows):
    """(gain, feature, value, missing left) by trying everything; rows are (g, h, x)."""
    best = None
    for f in range(3):
        for value in sorted({r[2][f] for r in rows if not lost(r[2][f])}) + [math.inf]:
            for left in (True, False):
                goes = [left if lost(r[2][f]) else r[2][f] <= value for r in rows]
                parts = [[r for r, x in zip(rows, goes) if x == side] for side in (True, False)]
                if min(map(len, parts)) >= max(min_rows, 1) and min(sum(r[1] for r in p) for p in parts) >= min_weight:
                    gain = sum(worth(p, alpha, lam) for p in parts) - worth(rows, alpha, lam)
                    if gain > 1e-6 and (best is None or gain > best[0] + 1e-7):
                        best = gain, f, value, left, parts
    return best


def grown(rows, margins, growth, step):
    """One tree by brute force: ({row index: value}, sorted gains of its splits)."""
    own = []
    for i, r in enumerate(rows):
        p = 1 / (1 + math.exp(-margins[i]))
        own.append((p - r[4], p * (1 - p), r[1:4], i))
    limits = growth.alpha, growth.lam, growth.min_weight, growth.min_rows
    leaves, gains = [(own, 0)], []
    while growth.leaves is None or len(leaves) < growth.leaves:
        able = [(best_split(leaf, *limits), k) for k, (leaf, depth) in enumerate(leaves) if growth.max_depth is None or depth < growth.max_depth]
        able = [(s, k) for s, k in able if s]
        if not able:
            break
        split, k = max(able, key=lambda x: x[0][0])
        depth = leaves.pop(k)[1] + 1
        leaves += [(part, depth) for part in split[4]]
        gains.append(split[0])
    values = {}
    for leaf, _ in leaves:
        g, h = sum(r[0] for r in leaf), sum(r[1] for r in leaf)
        values |= {r[3]: -step * math.copysign(max(abs(g) - growth.alpha, 0), g) / (h + growth.lam) for r in leaf}
    return values, sorted(gains)


@pytest.mark.parametrize("growth", [
    {"max_depth": 3, "alpha": 0.25, "lam": 0.25, "min_weight": 3.0}, {"leaves": 6, "lam": 1.0, "min_rows": 5}, {"leaves": 5, "max_depth": 2}])
def test_trees_equal_brute_force(make, growth):
    rows, growth = rows_of(150, 7), B.Growth(**growth)
    model = B.boost(make(rows), FEATURES, 3, 0.5, growth)
    margins = [0.0] * len(rows)
    got = {r.customer_id: r.m for r in make(rows).select("customer_id", model.staged().alias("m")).collect()}
    for t in range(3):
        values, gains = grown(rows, margins, growth, 0.5)
        margins = [m + values[i] for i, m in enumerate(margins)]
        assert sorted(n["gain"] for n in model.nodes if n["tree"] == t and n["feature"]) == pytest.approx(gains, abs=1e-6)
        assert [got[i][t] for i in range(len(rows))] == pytest.approx(margins, abs=1e-6)


def test_trees_do_not_depend_on_partitions_and_margins_are_written_between(make, monkeypatch):
    rows = rows_of(300, 1)
    growth = B.Growth(leaves=7, lam=0.5)
    whole = B.boost(make(rows), FEATURES, 6, 0.3, growth)
    monkeypatch.setattr(B, "BLOCK", 2)
    other = B.boost(make(list(reversed(rows))).repartition(7), FEATURES, 6, 0.3, growth)
    assert whole.nodes == other.nodes and whole.rounds == 6


def test_scores_by_batches_by_expression_and_from_storage(make, tmp_path):
    train, test = make(rows_of(300, 1)), make(rows_of(100, 2))
    model = B.boost(train, FEATURES, 4, 0.3, B.Growth(max_depth=3, lam=0.25), start="mean")
    save_model(model, str(tmp_path / "m"))
    again = load_model(str(tmp_path / "m"))
    assert isinstance(again, TreeModel) and again.nodes == model.nodes and again.base == model.base
    rows = test.select("customer_id", model.margin().alias("x"), again.margin_expression().alias("y"), model.staged()[3].alias("z"),
                       model.first(2).margin().alias("two"), model.staged()[1].alias("second")).collect()
    for r in rows:
        assert r.x == pytest.approx(r.y, abs=1e-12) and r.x == pytest.approx(r.z, abs=1e-12) and r.two == pytest.approx(r.second, abs=1e-12)
    counts = {r.feature: r.splits for r in split_importances(model.node_table(train.sparkSession)).collect()}
    assert sum(counts.values()) == sum(1 for n in model.nodes if n["feature"])
    assert model.nodes[0]["n"] == 300


def test_early_stopping_keeps_the_best_round(make, monkeypatch):
    monkeypatch.setattr(B, "BLOCK", 2)
    train, test = make(rows_of(120, 3)), make(rows_of(300, 4))
    growth = B.Growth(leaves=30)
    whole = B.boost(train, FEATURES, 12, 1.0, growth)
    curve = {r.iteration: r.auc for r in B.staged_auc(whole, test).collect()}
    stopped = B.boost(train, FEATURES, 12, 1.0, growth, evaluation=test, patience=3)
    best = stopped.rounds
    assert curve[best] == max(v for k, v in curve.items() if k <= best + 3)
    assert L.fit_best("xgb", train, test, FEATURES, params={"rounds": 4})[1] in (1, 2, 3, 4)


def test_labels_of_one_class_and_empty_tables(make, spark):
    rows = rows_of(30, 5)
    same = B.boost(make([(*r[:4], 1) for r in rows]), FEATURES, 2, 0.3, B.Growth(max_depth=2, lam=0.25), start="mean")
    assert all(n["feature"] is None for n in same.nodes) and same.base == 0.0
    nothing = B.boost(make(rows).limit(0), FEATURES, 2, 0.3, B.Growth(max_depth=2))
    assert nothing.nodes == [] and {r.margin for r in nothing.transform(make(rows)).collect()} == {0.0}
    unlabelled = make(rows).union(make(rows_of(20, 6)).withColumn("label", F.lit(None).cast("int")))
    assert B.boost(unlabelled, FEATURES, 1, 0.3, B.Growth(max_depth=1)).nodes[0]["n"] == 30


def test_cut_points_are_quantiles(make, spark):
    rows = [(i, float(i % 7), float(i), None, 0) for i in range(100)]
    cuts = B.cut_points(make(rows), FEATURES, bins=10)
    assert list(cuts[0]) == [0, 1, 2, 3, 4, 5] and list(cuts[1]) == [9, 19, 29, 39, 49, 59, 69, 79, 89] and list(cuts[2]) == []


def test_permuted_columns_lower_the_area_where_they_matter(make):
    rows = rows_of(400, 8, gaps=False)
    model = L.fit("xgb", make(rows), FEATURES, {"rounds": 5})
    drops = {r.feature: r["drop"] for r in L.permutation_importances(model, make(rows), FEATURES).collect()}
    assert drops["a"] > 0.1 and drops["b"] > 0.02
    again = {r.feature: r["drop"] for r in L.permutation_importances(model, make(rows).repartition(7), FEATURES).collect()}
    assert again == pytest.approx(drops)


def test_gradient_steps(make):
    rows = rows_of(200, 9, gaps=False)
    model = R.descend(make(rows), FEATURES, steps=30, rate=0.5, keep_every=10)
    assert model.steps == [10, 20, 30]
    xs = [[r[1], r[2], r[3]] for r in rows]
    means = [sum(c) / len(c) for c in zip(*xs)]
    spreads = [math.sqrt(sum((v - m) ** 2 for v in c) / len(c)) for c, m in zip(zip(*xs), means)]
    xs = [[1.0, *[(v - m) / s for v, m, s in zip(x, means, spreads)]] for x in xs]
    w = [0.0] * 4
    for _ in range(30):
        off = [1 / (1 + math.exp(-sum(a * b for a, b in zip(w, x)))) - r[4] for x, r in zip(xs, rows)]
        w = [v - 0.5 * sum(o * x[j] for o, x in zip(off, xs)) / len(xs) for j, v in enumerate(w)]
    assert list(model.weights[-1]) == pytest.approx(w)
    curve = {r.iteration: r.auc for r in model.staged_auc(make(rows)).collect()}
    assert set(curve) == {10, 20, 30}
    assert curve[30] == pytest.approx(L.evaluate(model, make(rows)).first().auc)


def test_training_rows_are_dealt_over_tasks(spark):
    rows = spark.range(0, 60_000, 1, 1).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 2).cast("int").alias("label"))
    state = B.binned(rows, ["a"], B.cut_points(rows, ["a"]))
    assert state.rdd.getNumPartitions() > 1 and state.count() == 60_000
    assert state.groupBy("codes").count().count() == 7


def test_passes_read_blocks_of_rows_and_trees_do_not_depend_on_them(make, monkeypatch):
    rows = rows_of(300, 5)
    growth = B.Growth(leaves=7, lam=0.5)
    whole = B.boost(make(rows), FEATURES, 4, 0.3, growth)
    coded = B.binned(make(rows), FEATURES, B.cut_points(make(rows), FEATURES))
    assert B._packed(coded.coalesce(1), 3).count() == 1
    monkeypatch.setattr(B, "BLOCK_ROWS", 7)
    blocks = B._packed(coded.coalesce(1), 3).collect()
    assert sorted(b.n for b in blocks) == [300 % 7, *[7] * (300 // 7)] and all(len(b.codes) == 3 * b.n for b in blocks)
    assert B.boost(make(rows), FEATURES, 4, 0.3, growth).nodes == whole.nodes
