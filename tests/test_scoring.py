import math
import random

import pytest
from compare import by

from buycast.operators import metrics as M
from buycast.operators.submit import fill_template, flag_top_n, predicted_buyers, rollup_candidates


def scored(spark, rows):
    return spark.createDataFrame(rows, "label int, probability double")


def test_top_n_with_ties_at_the_border(spark):
    df = spark.createDataFrame([(c, 0.5 if c > 3 else 0.9) for c in range(1, 101)], "customer_id long, score double")
    got = by(flag_top_n(df, n=10), "customer_id")
    assert [c for c, r in got.items() if r["result"] == 1] and {c for c, r in got.items() if r["result"]} == set(range(1, 11))
    assert len(got) == 100


def test_rollup_uses_a_strict_threshold(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.2), (2, 0.500001)], "customer_id long, probability double")
    got = by(rollup_candidates(df), "customer_id")
    assert got[1]["result"] == 0 and got[2]["result"] == 1
    assert predicted_buyers(rollup_candidates(df)).first()[0] == 1


def test_template_keeps_order_and_repeats(spark):
    template = spark.createDataFrame([(5, 0), (1, 0), (5, 0), (7, 0)], "customer_id long, result int").coalesce(1)
    pred = spark.createDataFrame([(5, 1), (1, 0), (3, 1)], "customer_id long, result int")
    got = [tuple(r) for r in fill_template(template, pred, keep_order=True).collect()]
    assert got == [(5, 1), (1, 0), (5, 1), (7, 0)]


def brute_auc(rows):
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def test_auc_with_many_ties(spark):
    rng = random.Random(5)
    rows = [(rng.randint(0, 1), round(rng.random(), 1)) for _ in range(500)] + [(0, 0.3)] * 300
    assert M.auc(scored(spark, rows)).first()[0] == pytest.approx(brute_auc(rows))


def test_metrics_at_the_edges(spark):
    one_class = M.metrics(scored(spark, [(1, 0.2), (1, 0.9)])).first()
    assert one_class["auc"] is None and one_class["recall"] == 0.5 and one_class["precision"] == 1
    none_hit = M.metrics(scored(spark, [(1, 0.2), (0, 0.1)])).first()
    assert (none_hit["auc"], none_hit["accuracy"], none_hit["precision"], none_hit["recall"], none_hit["f1"]) == (1, 0.5, 0, 0, 0)
    border = M.metrics(scored(spark, [(1, 0.5), (0, 0.4)])).first()
    assert border["accuracy"] == 1  # 0.5 counts as a hit
    assert M.metric(scored(spark, [(1, 0.5), (0, 0.4)]), "f1").first()[0] == 1
    with pytest.raises(NotImplementedError):
        M.metric(scored(spark, [(1, 0.5)]), "gini")


def test_losses(spark):
    df = spark.createDataFrame([(1, 800.0), (0, -800.0), (1, 0.0)], "label int, score double")
    assert M.mean_loss(df).first()[0] == pytest.approx(math.log(2) / 3)
    assert M.mean_loss(df.filter("score = 0"), kind="mse").first()[0] == 1
    with pytest.raises(NotImplementedError):
        M.mean_loss(df, kind="hinge")


def test_best_iteration_is_the_first_of_equals(spark):
    df = spark.createDataFrame(
        [("a", 1, 0.5), ("a", 2, 0.7), ("a", 3, 0.7), ("b", 1, 0.6)], "run string, iteration int, value double")
    got = by(M.best_iteration(df), "run")
    assert (got["a"]["iteration"], got["b"]["iteration"]) == (2, 1)
    table = [r["run"] for r in M.compare_runs(df).collect()]
    assert table == ["a", "b"] and by(M.compare_runs(df), "run")["a"]["last"] == 0.7
