import datetime as dt
import glob
import re

import pytest

from buycast.functions.numbers import finite, last_items, pad
from buycast.sources import (
    read_codes, read_customers, read_features, read_logs, read_order_detail, write_candidates, write_codes, write_csv,
    write_features,
)
from buycast.sources.schemas import ORDER_DETAIL, TIME_COLUMNS
from pyspark.sql import functions as F
from pyspark.sql import types as T


def test_order_csv_by_name_with_bad_times(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "order_id,order_detail_id,customer_id,order_pay_time,order_total_payment,goods_id,customer_city\n"
        "5,1,7.0,2013-07-01 10:11:12,12.50,3,x\n6,2,,not a time,,4,\n")
    rows = read_order_detail(spark, str(tmp_path)).orderBy("order_id").collect()
    assert rows[0]["order_pay_time"] == dt.datetime(2013, 7, 1, 10, 11, 12)
    assert (rows[0]["order_id"], rows[0]["customer_id"], float(rows[0]["order_total_payment"])) == (5, 7, 12.5)
    assert rows[1]["order_pay_time"] is None and rows[1]["customer_id"] is None and rows[1]["customer_city"] is None
    with pytest.raises(Exception):
        read_order_detail(spark, str(tmp_path), strict_times=True).collect()


def test_wide_csv_lines_are_typed_by_compiled_code(spark, tmp_path):
    """The JVM compiles no method of over 8,000 bytes; odd numbers take the interpreted path."""
    names = [f.name for f in ORDER_DETAIL.fields]
    number = [f.name for f in ORDER_DETAIL.fields if f.name not in TIME_COLUMNS and f.dataType != T.StringType()]
    line = {**dict.fromkeys(names, ""), **dict.fromkeys(number, " 3.0 "), "order_pay_time": "2013-07-01 10:11:12", "customer_city": " x "}
    path = tmp_path / "wide"
    path.mkdir()
    (path / "a.csv").write_text(",".join(names) + "\n" + ",".join(line.values()) + "\n")
    read = read_order_detail(spark, str(path), strict_times=True)
    row = read.first()
    assert {float(row[c]) for c in number} == {3.0} and row.customer_city == "x" and row.goods_list_time is None
    explained = spark._jvm.PythonSQLUtils.explainString(read._jdf.queryExecution(), "codegen")
    assert all(int(size) <= 8000 for size in re.findall(r"maxMethodCodeSize:(\d+)", explained))
    for bad in ("3.5", "x"):
        (path / "a.csv").write_text(",".join(names) + "\n" + ",".join({**line, "goods_id": bad}.values()) + "\n")
        with pytest.raises(Exception, match=f"goods_id: {bad} does not parse"):
            read_order_detail(spark, str(path)).collect()


def test_csv_puts_the_index_first(spark, tmp_path):
    write_csv(spark.createDataFrame([(1, 7)], "result int, customer_id long"), str(tmp_path / "o"), index="customer_id")
    text = {line for name in glob.glob(f"{tmp_path}/o/part-*") for line in open(name).read().splitlines()}
    assert text == {"customer_id,result", "7,1"}
    assert read_customers(spark, str(tmp_path / "o")).first().asDict() == {"customer_id": 7, "result": 1}


def test_feature_folder_replaces_one_split_only(spark, tmp_path):
    root = str(tmp_path / "f")
    a, b = spark.createDataFrame([(1, 2.0)], "customer_id long, x double"), spark.createDataFrame([(2, 3.0)], "customer_id long, x double")
    write_features(a, root, "agg", "train")
    write_features(b, root, "agg", "test")
    write_features(b, root, "agg", "train")
    assert read_features(spark, root, "agg", "train").collect() == b.collect()
    whole = spark.read.parquet(root)
    assert whole.count() == 2 and {"method", "split"} <= set(whole.columns)


def test_chunks_hold_whole_customers_and_replace_old_ones(spark, tmp_path):
    path = str(tmp_path / "c")
    rows = spark.range(1, 26).select(F.col("id").cast("int").alias("customer_id")).withColumn(
        "candidate_good", F.explode(F.sequence(F.lit(1), F.lit(4))))
    write_candidates(rows, path, customers_per_chunk=10)
    write_candidates(rows, path, customers_per_chunk=10)
    assert spark.read.parquet(path).count() == 100
    sizes = {r["chunk"]: r["n"] for r in spark.read.parquet(path).groupBy("chunk").agg(
        F.count_distinct("customer_id").alias("n")).collect()}
    assert sizes == {0: 10, 1: 10, 2: 5}
    assert all(len(glob.glob(f"{path}/chunk={c}/*.parquet")) == 1 for c in sizes)


def test_codes_round_trip(spark, tmp_path):
    codes = spark.createDataFrame([("a", 0)], "value string, idx long")
    write_codes(codes, str(tmp_path), "city")
    assert read_codes(spark, str(tmp_path), "city").collect() == codes.collect()


def test_logs_of_every_kind(spark, tmp_path):
    (tmp_path / "mlp_agg.log").write_text("Epoch 1:\neval metric auc = 0.67, \nEpoch 2:\neval metric auc = 0.71, \n")
    (tmp_path / "xgb_both.log").write_text("[0]\tvalidation_0-auc:0.79000\n[100]\tvalidation_0-auc:0.79500\n")
    (tmp_path / "lgb_time.log").write_text("[100]\tvalid_0's auc: 0.701\tvalid_0's binary_logloss: 0.3\nnoise\n")
    (tmp_path / "reg_agg.log").write_text("Iteration 1/400:\n  eval metric auc = 0.753074\n" * 3)

    def curve(kind, name):
        rows = read_logs(spark, f"{tmp_path}/{name}.log", kind).orderBy("iteration").collect()
        assert {r["run"] for r in rows} == {name} and {r["metric"] for r in rows} == {"auc"}
        return [r["value"] for r in rows]

    assert curve("mlp", "mlp_agg") == [0.67, 0.71]
    assert curve("xgb", "xgb_both") == [0.79, 0.795]
    assert curve("lgb", "lgb_time") == [0.701]
    assert curve("reg", "reg_agg") == [0.753074] * 3
    with pytest.raises(NotImplementedError):
        read_logs(spark, str(tmp_path), "svm")


def test_array_and_number_helpers(spark):
    df = spark.createDataFrame([([1, 2, 3], float("inf"))], "a array<int>, x double")
    row = df.select(pad("a", 5), pad("a", 2), last_items("a", 2), last_items("a", 9), finite(F.col("x"))).first()
    assert list(row) == [[1, 2, 3, 0, 0], [1, 2, 3], [2, 3], [1, 2, 3], None]


def test_the_csv_of_all_lines_is_packed(spark, monkeypatch):
    """Its text is several times as long as the tables; packed files are read back alike."""
    from contract import features

    written = []

    def noted(df, path, *args, **options):
        written.append(path)
        write_csv(df, path, *args, **options)

    monkeypatch.setattr(features, "write_csv", noted)
    back = features.order_lines_from_csv(spark, "/root/testdata/sf0.001")
    assert {name.split(".", 1)[1] for name in glob.glob(f"{written[0].removeprefix('file:')}/part-*")} == {"csv.gz"}
    assert back.count() == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
