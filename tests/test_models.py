import random

import pytest
from compare import by

from buycast.plans import models as L
from buycast.plans import recommend as R
from buycast.sources import load_model, save_model
from contract import learning

FEATURES = ["a", "b", "c"]
FAST = {"reg": {"maxIter": 50}, "gd": {"steps": 20}, "xgb": {"rounds": 5}, "lgb": {"rounds": 5}, "mlp": {"hidden": [8], "maxIter": 40}}


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(11)

    def make(n, seed):
        rng.seed(seed)
        rows = []
        for i in range(n):
            a, b, c = rng.gauss(0, 1), rng.gauss(5, 3), -999.0
            rows.append((i, a, b, c, int(a + 0.3 * (b - 5) + rng.gauss(0, 0.5) > 0)))
        return spark.createDataFrame(rows, "customer_id long, a double, b double, c double, label int").cache()

    return make(600, 1), make(300, 2)


@pytest.mark.parametrize("name", sorted(FAST))
def test_models_find_the_signal_and_survive_storage(tables, tmp_path, name):
    train, test = tables
    model = L.fit(name, train, FEATURES, FAST[name])
    result = L.evaluate(model, test).first()
    assert result["auc"] > 0.85 and result["accuracy"] > 0.7
    assert L.quick_auc(model, test) == pytest.approx(result["auc"], abs=1e-6)
    save_model(model, str(tmp_path / "m"))
    before = L.score(model, test).orderBy("customer_id").collect()
    assert before == L.score(load_model(str(tmp_path / "m")), test).orderBy("customer_id").collect()


def test_curves_and_importances(spark, tables):
    train, test = tables
    model = L.fit("xgb", train, FEATURES, FAST["xgb"])
    losses = [r["value"] for r in L.loss_per_round(model, train).orderBy("iteration").collect()]
    assert len(losses) == 5 and losses[-1] < losses[0]
    top = [r["feature"] for r in L.importances(model, spark, top=2).collect()]
    assert top == ["a", "b"]
    curve = L.compare_feature_sets({"x": (train, test)}, ("reg",), {"x": FEATURES}, steps=(1, 10)).collect()
    assert [(r["run"], r["iteration"]) for r in curve] == [("reg_x", 1), ("reg_x", 10)]


def test_unknown_model():
    with pytest.raises(NotImplementedError):
        L.get_estimator("svm", FEATURES)


def test_standardize_reuses_training_statistics(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, flat double")
    out, stats = L.standardize(train, ["x", "flat"])
    assert sorted(tuple(r) for r in out.collect()) == [(-1.0, 0.0), (1.0, 0.0)]
    other, _ = L.standardize(spark.createDataFrame([(5.0, 6.0)], "x double, flat double"), ["x", "flat"], stats)
    assert tuple(other.first()) == (3.0, 1.0)


def test_best_candidates_equal_the_maximum_over_all_pairs(spark):
    rng = random.Random(4)
    samples = spark.createDataFrame(
        [(c, [rng.randint(1, 12) for _ in range(3)], [1, 2], g, g % 3 + 1, int(g % 4 == c % 4))
         for c in range(1, 31) for g in rng.sample(range(1, 13), 5)],
        "customer_id int, history_goods array<int>, history_classes array<int>, candidate_good int, "
        "candidate_class int, label int")
    model = R.fit_recommender(samples, {"factorSize": 4, "maxIter": 5, "numFeatures": 64})
    goods = spark.createDataFrame([(g, g % 3 + 1) for g in range(1, 13)], "goods_idx int, class_idx int")
    customers = spark.createDataFrame(
        [(c, None if c % 5 == 0 else [rng.randint(1, 12) for _ in range(c % 4)], [1] * (c % 4)) for c in range(1, 31)],
        "customer_idx int, history_goods array<int>, history_classes array<int>")
    from pyspark.sql import functions as F

    from buycast.functions.numbers import or_empty
    pairs = customers.crossJoin(goods).select(
        F.col("customer_idx").alias("customer_id"), or_empty("history_goods").alias("history_goods"),
        or_empty("history_classes").alias("history_classes"), F.col("goods_idx").alias("candidate_good"),
        F.col("class_idx").alias("candidate_class"))
    scored = R.score_pairs(model, pairs)
    want = {r["customer_id"]: r["m"] for r in scored.groupBy("customer_id").agg(F.max("probability").alias("m")).collect()}
    by_pair = {(r["customer_id"], r["candidate_good"]): r["probability"] for r in scored.collect()}
    for step in (65_536, 5, 1):  # one block, and several
        got = by(R.best_candidates(model, customers, goods, goods_per_block=step), "customer_id")
        assert set(got) == set(want)
        for c, r in got.items():
            assert r["probability"] == pytest.approx(want[c], abs=1e-9)
            assert by_pair[c, r["candidate_good"]] == pytest.approx(want[c], abs=1e-9)
    search = R.CandidateSearch(model, customers, goods, 2)
    counted = search.pairs().first()
    assert counted.pairs == 30 * 12 and 30 * 2 <= counted.looked_at <= counted.pairs


def test_samples_are_dealt_before_they_get_tokens(spark, monkeypatch):
    seen, deal = [], R.dealt
    monkeypatch.setattr(R, "dealt", lambda df: seen.append(df.columns) or deal(df))
    samples = spark.createDataFrame(
        [(c, [1, 2], [1, 2], g, 1, g % 2) for c in range(1, 6) for g in range(1, 5)],
        "customer_id int, history_goods array<int>, history_classes array<int>, candidate_good int, candidate_class int, label int")
    model = R.fit_recommender(samples, {"factorSize": 2, "maxIter": 2, "numFeatures": 64})
    assert seen == [samples.columns] and R.score_pairs(model, samples).count() == 20


def test_recommender_scores_learn_with_the_default_steps(spark, monkeypatch):
    """The registered query fits the factorisation machine whole: no fewer steps, factors or buckets than the defaults."""
    asked = []
    for name, value in (("lines", None), ("encode_events", (None, None)), ("sequence_samples", "samples")):
        monkeypatch.setattr(learning, name, lambda *a, value=value, **k: value)
    monkeypatch.setattr(learning, "stored", lambda df: df)
    for name in ("user_tokens", "item_tokens"):
        monkeypatch.setattr(R, name, lambda df: df)
    monkeypatch.setattr(R, "fit_recommender", lambda samples, params=None: asked.append(params))
    monkeypatch.setattr(L, "evaluate", lambda model, samples: samples)
    assert learning.recommender_scores_of_test_month(None, None) == "samples"
    stages, wanted = L.get_estimator("fm", params=asked[0]).getStages(), L.DEFAULTS["fm"]
    assert stages[0].getNumFeatures() == stages[1].getNumFeatures() == wanted["numFeatures"]
    assert (stages[-1].getFactorSize(), stages[-1].getMaxIter()) == (wanted["factorSize"], wanted["maxIter"])
