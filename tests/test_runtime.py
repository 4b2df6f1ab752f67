import random
import threading

from buycast.runtime import ROWS_PER_TASK, dealt, global_index, running_totals, side_by_side, top_k_per_key
from pyspark.sql import functions as F


def test_global_index_with_most_rows_in_one_value(spark):
    rows = [(1.0 if i % 3 else float(i % 50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "score double, id long").repartition(7)
    got = global_index(df, [F.desc("score"), F.asc("id")], "rank").orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(3000))
    assert [(r["score"], r["id"]) for r in got] == sorted(rows, key=lambda r: (-r[0], r[1]))


def test_running_totals_per_group(spark):
    rng = random.Random(3)
    rows = [(g, v, rng.randint(0, 9)) for g in "ab" for v in rng.sample(range(1000), 200)]
    df = spark.createDataFrame(rows, "g string, v long, n long")
    got = {(r["g"], r["v"]): r["n_before"] for r in running_totals(df, "v", ["n"], ["g"]).collect()}
    assert got == {(g, v): sum(m for h, w, m in rows if h == g and w < v) for g, v, _ in rows}
    alone = {r["v"]: r["n_before"] for r in running_totals(df.filter("g = 'a'"), "v", ["n"]).collect()}
    assert alone == {v: n for (g, v), n in got.items() if g == "a"}


def test_top_k_with_a_hot_key(spark):
    rows = [("hot", i) for i in range(5000)] + [(f"k{i % 20}", i) for i in range(100)]
    df = spark.createDataFrame(rows, "k string, t long").repartition(6)
    per = {}
    for r in top_k_per_key(df, ["k"], [F.desc("t")], 3).collect():
        per.setdefault(r["k"], []).append(r["t"])
    assert sorted(per["hot"]) == [4997, 4998, 4999]
    assert all(sorted(per[f"k{i}"]) == [i + 40, i + 60, i + 80] for i in range(20))


def test_limit_runs_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 5).alias("k"), "id")
    plan = top_k_per_key(df, ["k"], [F.desc("id")], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("WindowGroupLimit") == 2  # partial and final


def test_side_by_side_keeps_the_order_and_runs_at_the_same_time(spark):
    met = threading.Barrier(2, timeout=60)

    def call(n):
        met.wait()  # only passes if both run
        return spark.range(n).count()

    assert side_by_side([lambda: call(3), lambda: call(5)]) == [3, 5]


def test_dealt_spreads_rows_by_their_number(spark):
    few, many = spark.range(0, 500, 1, 1), spark.range(0, 4 * ROWS_PER_TASK, 1, 1)
    assert dealt(few).rdd.getNumPartitions() == 1
    sizes = [len(part) for part in dealt(many).rdd.glom().collect()]
    assert len(sizes) == 4 and sum(sizes) == 4 * ROWS_PER_TASK and max(sizes) < 1.1 * ROWS_PER_TASK
