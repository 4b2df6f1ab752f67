"""One customer and one good hold a third of all lines: results must stay whole and equal to the SQL."""

import os

import duckdb
import pytest
from compare import connect, differences

import __spark_entry__ as entry_point
from buycast.operators.sequences import encode_events, histories
from buycast.sources.star import ORDER_KEY, order_detail

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("skewed"))
    for name in os.listdir(SF):
        if name not in ("orders.parquet", "lineitem.parquet"):
            os.symlink(f"{SF}/{name}", f"{root}/{name}")
    duckdb.sql(f"""COPY (SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey)
      FROM '{SF}/orders.parquet') TO '{root}/orders.parquet'""")
    duckdb.sql(f"""COPY (SELECT * REPLACE (CASE WHEN hash(l_orderkey, l_linenumber, l_suppkey) % 3 = 0 THEN 7
      ELSE l_partkey END AS l_partkey) FROM '{SF}/lineitem.parquet') TO '{root}/lineitem.parquet'""")
    return root


@pytest.mark.parametrize("name", [
    "features_both", "purchase_histories", "sequence_samples_train", "candidate_sets", "top_buyers", "area_under_curve",
    "upper_quantiles", "goods_class_map",
])
def test_skewed_tables_match_sql(spark, skewed, name):
    con = connect(skewed)
    assert differences(spark, con, name, entry_point.queries()[name], entry_point.oracle_sql()[name], skewed) is None


def test_histories_of_a_hot_customer_do_not_depend_on_partitions(spark, skewed):
    rows = order_detail(spark, skewed, ["customer_id", "goods_id", "goods_class_id", *ORDER_KEY])
    events, _ = encode_events(rows, ORDER_KEY)
    plain = histories(events, "2001-06", ORDER_KEY).orderBy("customer_idx").collect()
    salted = histories(events.repartition(7), "2001-06", ORDER_KEY).orderBy("customer_idx").collect()
    assert plain == salted and max(len(r["history_goods"]) for r in plain) == 50
