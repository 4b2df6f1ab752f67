"""What the physical plans must look like at any scale."""

import functools
import re

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buycast.operators.cutoffs import rolling_splits
from buycast.operators.static import customer_features
from buycast.operators.windows import daily, window_features
from buycast.sources.star import ORDER_KEY, order_detail

SF = "/root/testdata/sf0.001"
CUTS = rolling_splits("2001-05-31", "2001-06-30", "2001-07-31")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def narrow(spark):
    return order_detail(spark, SF, ["customer_id", "order_pay_time", "order_total_payment", "order_total_num"])


def test_dates_reach_the_scan_and_columns_are_pruned(narrow):
    text = plan(window_features(daily(narrow, "2001-01-01"), CUTS))
    orders = next(line for line in text.splitlines() if "FileScan" in line and "orders.parquet" in line)
    pushed = re.search(r"PushedFilters: \[(.*)", orders).group(1)
    assert "GreaterThanOrEqual(o_orderdate" in pushed or "o_orderdate" in orders.split("DataFilters")[1]
    assert "o_orderstatus" not in orders and "part.parquet" not in text and "customer.parquet" not in text


def test_windows_aggregate_in_place_after_one_narrow_shuffle(narrow):
    text = plan(window_features(daily(narrow, "2001-01-01"), CUTS))
    assert "SortAggregate" not in text and "Python" not in text
    # per-order sums, day sums, customers; joins may add their own
    assert text.count("Exchange hashpartitioning(customer_id") == 2


@pytest.mark.parametrize("build", ["windows", "static"])
def test_no_products_and_no_single_partition(spark, narrow, build):
    if build == "windows":
        df = window_features(daily(narrow, "2001-01-01"), CUTS)
    else:
        df = customer_features(order_detail(spark, SF), CUTS, ord_col=ORDER_KEY)
    text = plan(df)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in text


def test_lines_are_shuffled_once_for_all_cutoffs(spark):
    text = plan(customer_features(order_detail(spark, SF), CUTS, ord_col=ORDER_KEY))
    shuffles = re.findall(r"Exchange hashpartitioning\(customer_id#\d+L, (?:period|\d)", text)
    assert len(shuffles) == 2  # partial states by (customer, period, pattern), then by customer
    assert len(re.findall(r"FileScan parquet .*lineitem.parquet", text)) == 2  # lines, and their per-order sums


def test_single_cutoff_tables_read_the_lines_once(spark, make_lines):
    from buycast.plans.features import single_cutoff_tables

    read = spark.sparkContext.accumulator(0)
    rows = make_lines(*[{"customer_id": c, "order_id": c * 10 + i, "goods_id": i, "order_pay_time": t, "order_total_payment": 5}
                        for c in (1, 2, 3) for i, t in enumerate(("2013-05-01", "2013-06-02", None)[c - 1:])])

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    train, test = single_cutoff_tables(rows.mapInPandas(counted, rows.schema), "2013-05-31")
    assert {(r.customer_id, r.label, r.order_detail_count) for r in train.collect()} == {(1, 1, 1.0)}
    assert {(r.customer_id, r.order_detail_count) for r in test.collect()} == {(1, 3.0), (2, 2.0), (3, 1.0)}
    assert read.value == 6


def test_a_split_of_windows_reads_its_own_folder_only(narrow):
    from buycast.plans.features import build_splits

    splits = build_splits(narrow, CUTS, "time", ord_col=list(ORDER_KEY), floor="2001-01-01")
    for name, table in splits.items():
        scan = next(line for line in plan(table).splitlines() if "FileScan" in line)
        assert f"= {name})" in re.search(r"PartitionFilters: \[(.*?)\]", scan).group(1)
        assert table.columns[0] == "customer_id" and "split" not in table.columns


def test_stored_folders_keep_columns_and_rows(spark):
    from buycast.runtime import stored

    df = spark.createDataFrame([("b", 1, None), ("a", 2, 0.5), ("a", 3, 1.5)], "part string, n int, x double")
    back = stored(df, folders=["part"])
    assert back.schema == df.schema and sorted(back.collect()) == sorted(df.collect())


def test_parts_meet_the_lines_before_the_orders_do(spark):
    """What comes from parts, orders and customers is not shuffled by part, and an order's lines end up together."""
    text = order_detail(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert re.findall(r"Join Inner, .*?(l_(?:part|order)key)", text)[:2] == ["l_orderkey", "l_partkey"]


def test_repeated_parts_orders_and_missing_keys_multiply_and_drop_lines_as_before(spark, tmp_path):
    """One row per line, order and part that match; the sums of an order count each of its lines once, with or without a part."""
    for name in ("nation", "region", "customer"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    line, order, part = (spark.read.parquet(f"{SF}/{n}.parquet").limit(1).cache() for n in ("lineitem", "orders", "part"))
    change = lambda df, **values: df.withColumns({c: F.lit(v).cast(df.schema[c].dataType) for c, v in values.items()})
    lines = [change(line, l_orderkey=o, l_partkey=p, l_quantity=q) for o, p, q in
             ((1, 1, 2), (1, 2, 3), (1, 9, 5), (1, None, 7), (2, 1, 11), (None, 1, 13))]
    orders = [change(order, o_orderkey=o, o_custkey=1) for o in (1, 1, 3, None)]
    parts = [change(part, p_partkey=p) for p in (1, 1, 2, None)]
    for name, tables in (("lineitem", lines), ("orders", orders), ("part", parts)):
        functools.reduce(DataFrame.union, tables).write.parquet(f"{tmp_path}/{name}.parquet")
    got = order_detail(spark, str(tmp_path)).select("goods_id", "order_detail_goods_num", "order_total_num", "order_count").collect()
    assert sorted(map(tuple, got)) == [(1, 2, 17, 4)] * 4 + [(2, 3, 17, 4)] * 2


def test_features_that_lie_by_customer_are_joined_where_they_are(spark, narrow):
    """Also in sessions that join only on a layout by all keys, as is Spark's default."""
    from buycast.plans.features import feature_set

    name = "spark.sql.requireAllClusterKeysForCoPartition"
    was = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        assert "Exchange hashpartitioning(split" not in plan(feature_set(narrow, CUTS, "time", ord_col=ORDER_KEY, floor="2001-01-01"))
    finally:
        spark.conf.set(name, was)
