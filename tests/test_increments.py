import datetime as dt
import re

import pytest
from compare import by
from pyspark.sql import functions as F

from buycast.operators.cutoffs import rolling_splits
from buycast.plans.features import feature_set
from buycast.plans.increments import add_month, add_months, features_from_months
from buycast.sources import attach_bucketed, read_families, write_bucketed
from buycast.sources.star import ORDER_KEY, order_detail

SF = "/root/testdata/sf0.001"
CUTS = rolling_splits("2001-05-31", "2001-06-30", "2001-07-31")
OPTIONS = {"ord_col": ORDER_KEY, "floor": "2001-01-01"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("months"))
    lines = order_detail(spark, SF)
    add_months(lines, root, "1990-01", "2001-06", ORDER_KEY)
    add_month(lines, root, "2001-07", ORDER_KEY)
    add_month(lines, root, "2001-08", ORDER_KEY)
    return root


@pytest.mark.parametrize("method", ["agg", "time"])
@pytest.mark.parametrize("rule", ["month", "open", "goods30"])
def test_months_give_the_features_of_all_lines(spark, kept, method, rule):
    if rule == "goods30" and method == "agg":
        pytest.skip("labels by goods are checked with the windows")
    want = feature_set(order_detail(spark, SF), CUTS, method, rule, **OPTIONS)
    if rule == "open":  # months after the last one kept are unknown here
        lines = order_detail(spark, SF).filter("order_pay_time < '2001-09-01'")
        want = feature_set(lines, CUTS, method, rule, **OPTIONS)
    got = features_from_months(spark, kept, CUTS, method, rule, **OPTIONS)
    key = ("split", "customer_id")
    got, want = by(got, *key), by(want, *key)
    assert set(got) == set(want)
    for k, row in want.items():
        assert got[k] == pytest.approx(row)


def test_a_month_read_again_replaces_itself(spark, kept):
    before = rows(features_from_months(spark, kept, CUTS, "time", **OPTIONS))
    add_month(order_detail(spark, SF), kept, "2001-07", ORDER_KEY)
    add_months(order_detail(spark, SF), kept, "2001-06", "2001-07", ORDER_KEY)
    assert rows(features_from_months(spark, kept, CUTS, "time", **OPTIONS)) == before


def test_no_line_is_read_again_and_a_new_month_reads_its_own(spark, kept):
    text = plan(features_from_months(spark, kept, CUTS, "both", **OPTIONS))
    assert "lineitem" not in text and "orders.parquet" not in text
    assert re.search(r"PartitionFilters: \[.*month", text)
    text = plan(features_from_months(spark, kept, CUTS, "time", **OPTIONS))
    assert "latest" not in text


def test_cut_offs_within_a_month_are_refused(spark, kept):
    with pytest.raises(ValueError, match="2001-06-15"):
        features_from_months(spark, kept, rolling_splits("2001-05-31", "2001-06-15", "2001-07-31"))


def test_families_in_buckets_are_joined_without_a_shuffle(spark, tmp_path):
    lines = order_detail(spark, SF)
    for method in ("agg", "time"):
        write_bucketed(feature_set(lines, CUTS, method, **OPTIONS), f"test_family_{method}", str(tmp_path / method), buckets=4)
    both = read_families(spark, "test_family_agg", "test_family_time")
    assert "SortMergeJoin" in plan(both) and "Exchange" not in plan(both)
    want = feature_set(lines, CUTS, "both", **OPTIONS)
    assert rows(both.select(*want.columns)) == rows(want)
    attach_bucketed(spark, "test_again", str(tmp_path / "time"), 4)
    again = read_families(spark, "test_family_agg", "test_again")
    assert "Exchange" not in plan(again) and again.count() == want.count()
    one = spark.read.parquet(str(tmp_path / "time")).select(F.input_file_name()).distinct().count()
    assert one <= 4
    for name in ("test_family_agg", "test_family_time", "test_again"):
        spark.sql(f"DROP TABLE {name}")


def test_query_joins_the_lines_once_for_all_months(spark, monkeypatch):
    from contract import features as queries

    given = []
    for name in ("add_month", "add_months"):
        monkeypatch.setattr(queries, name, lambda lines, *_: given.append(plan(lines)))
    monkeypatch.setattr(queries, "from_months", lambda *_, **__: spark.range(1))
    queries.features_from_months(spark, "/root/testdata/sf0.001")
    assert len(given) == 4 and not any("Join" in text for text in given)


def test_states_are_written_where_they_were_merged(spark, tmp_path, monkeypatch):
    """No further shuffle gathers the states of a month."""
    lines = order_detail(spark, SF)
    monkeypatch.setattr(type(lines), "hint", lambda *_: pytest.fail("shuffled again"))
    monkeypatch.setattr(type(lines), "repartition", lambda *_: pytest.fail("shuffled again"))
    add_months(lines, str(tmp_path), "2001-06", "2001-07", ORDER_KEY)
    assert {r.month for r in spark.read.parquet(f"{tmp_path}/states").select("month").collect()} == {"2001-06", "2001-07"}


def test_families_are_joined_in_their_buckets_in_any_session(spark, tmp_path):
    """The buckets hold whole customers; a row meets the row of its own split and cut-off, and one without a match stays."""
    def family(value, *keys):
        return spark.createDataFrame([(*k, f"{value}{i}", 1) for i, k in enumerate(keys)],
                                     f"split string, cutoff date, customer_id long, {value} string, label int")

    a, b = dt.date(2013, 1, 31), dt.date(2013, 2, 28)
    left = family("x", ("t", a, 1), ("v", b, 1), ("t", b, 1), ("t", a, 2), ("t", a, None))
    right = family("y", ("t", a, 1), ("v", b, 1), ("v", a, 1), ("t", a, 3), ("t", a, None))
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    was = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        for table, df in (("beside_x", left), ("beside_y", right)):
            write_bucketed(df, table, str(tmp_path / table), buckets=3)
        both = read_families(spark, "beside_x", "beside_y")
        assert "Exchange" not in plan(both)
        want = left.join(right.drop("label"), ["split", "cutoff", "customer_id"], "left")
        assert both.columns == left.columns + ["y"] and rows(both.select(want.columns)) == rows(want)
    finally:
        spark.conf.set(name, was)
        spark.sql("DROP TABLE IF EXISTS beside_x")
        spark.sql("DROP TABLE IF EXISTS beside_y")
