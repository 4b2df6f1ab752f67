import datetime as dt
import math
import random

import numpy as np
import pytest
from compare import by

from buycast.operators import profile as P


def numbers(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def test_quantiles_interpolate(spark):
    rng = random.Random(1)
    values = [round(rng.gauss(0, 10), 1) for _ in range(999)] + [5.0] * 500
    got = P.exact_quantiles(numbers(spark, values + [None]), ["x"], [0, 0.25, 0.5, 0.95, 1]).first()
    assert list(got)[1:] == pytest.approx(list(np.quantile(values, [0, 0.25, 0.5, 0.95, 1])))
    assert P.quantile(numbers(spark, [1.0, 2.0, 3.0]), "x", 0.95).first()[0] == pytest.approx(2.9)
    assert P.quantile(numbers(spark, [1.0, 2.0, 3.0]), "x", 0.5, "approx").first()[0] == 2


def test_describe_exact_and_approximate(spark):
    values = [float(i) for i in range(101)]
    for method in ("exact", "approx"):
        row = P.describe_numeric(numbers(spark, values + [float("nan"), None]), method=method).first()
        assert (row["count"], row["mean"], row["min"], row["q25"], row["q50"], row["q75"], row["max"]) == (
            101, 50, 0, 25, 50, 75, 100)
        assert row["std"] == pytest.approx(np.std(values, ddof=1))


def test_histogram_matches_numpy(spark):
    rng = random.Random(2)
    values = [rng.expovariate(1) for _ in range(2000)]
    got = [r["n"] for r in P.histogram(numbers(spark, values + [None]), "x").collect()]
    assert got == list(np.histogram(values, bins=50)[0])


def test_histogram_of_constant_column(spark):
    rows = P.histogram(numbers(spark, [3.0] * 4), "x", bins=2).collect()
    assert [(r["left_edge"], r["right_edge"], r["n"]) for r in rows] == [(2.5, 3.0, 0), (3.0, 3.5, 4)]


def test_density_matches_definition(spark):
    values = [1.0, 1.0, 2.0, 4.0, 9.0]
    rows = P.density(numbers(spark, values), "x", points=5).collect()
    h = np.std(values, ddof=1) * len(values) ** -0.2
    for r, x in zip(rows, np.linspace(1, 9, 5)):
        want = np.mean([math.exp(-0.5 * ((x - v) / h) ** 2) / (h * math.sqrt(2 * math.pi)) for v in values])
        assert r["x"] == pytest.approx(x) and r["density"] == pytest.approx(want)


def test_empty_month_is_zero(make_lines):
    df = make_lines(
        {"order_pay_time": "2013-01-31T10:00:00", "order_total_payment": 5},
        {"order_pay_time": "2013-03-01T10:00:00", "order_total_payment": 7},
        {"order_pay_time": None, "order_total_payment": 7},
    )
    assert [tuple(r) for r in P.monthly_sales(df).collect()] == [
        (dt.date(2013, 1, 31), 5), (dt.date(2013, 2, 28), 0), (dt.date(2013, 3, 31), 7)]


def test_missing_and_share(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, float("nan")), ("b", 2.0)], "k string, x double")
    assert [tuple(r) for r in P.profile_missing(df).collect()] == [("x", 2, 50.0), ("k", 1, 25.0)]
    assert [tuple(r) for r in P.value_share(df, "k", top=1).collect()] == [("a", 2, pytest.approx(200 / 3))]
    assert by(P.profile_schema(df), "column")["x"]["dtype"] == "double"
    assert by(P.unique_counts(df, approximate=True), "column")["k"]["n_unique"] == 2


def test_correlation_over_complete_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.5), (3.0, None), (4.0, 7.0)], "a double, b double")
    got = {(r["a"], r["b"]): r["corr"] for r in P.correlations(df, ["a", "b"]).collect()}
    assert got["a", "b"] == got["b", "a"] == pytest.approx(np.corrcoef([1, 2, 4], [2, 4.5, 7])[0, 1])
    assert got["a", "a"] == pytest.approx(1)


def test_narrowing(spark):
    df = spark.createDataFrame(
        [(0, 300, 70_000, 5_000_000_000, -5, 1.5, 2.0, "t", True, None), (255, 1, 1, 1, 5, 2.0, 3.0, "u", False, 7)],
        "u8 long, u16 long, u32 long, u64 long, i8 long, f double, whole double, s string, b boolean, gaps long")
    out = P.narrow_types(df)
    assert dict(out.dtypes) == {
        "u8": "smallint", "u16": "int", "u32": "bigint", "u64": "decimal(20,0)", "i8": "tinyint", "f": "float",
        "whole": "smallint", "s": "string", "b": "boolean", "gaps": "smallint"}
    assert {r["gaps"] for r in out.collect()} == {-999, 7}
    wild = spark.createDataFrame([(float("inf"),), (1.0,)], "x double")
    assert dict(P.narrow_types(wild).dtypes) == {"x": "float"}


def test_hours_and_counts(make_lines):
    df = make_lines(
        {"customer_id": 1, "order_id": 1, "order_pay_time": "2013-01-31T10:00:00", "order_total_payment": 5},
        {"customer_id": 1, "order_id": 1, "order_pay_time": "2013-01-31T10:59:00", "order_total_payment": 5},
        {"customer_id": 2, "order_id": 2, "order_pay_time": "2013-01-31T00:00:00"},
    )
    assert [tuple(r) for r in P.hourly_counts(df).collect()] == [(0, 1), (10, 2)]
    assert [tuple(r) for r in P.orders_per_customer(df).collect()] == [(1, 1), (2, 1)]
    assert [tuple(r) for r in P.spend_per_customer(df).collect()] == [(1, 10), (2, 0)]


def test_description_reads_the_lines_once(spark, tmp_path):
    values = [3.0, 3.0, -1.5, 8.0, None, float("nan")]
    rows = [(v, 7 if i == 0 else None, None) for i, v in enumerate(values)]
    spark.createDataFrame(rows, "x double, one int, none int").write.parquet(str(tmp_path / "t"))
    table = P.describe_numeric(spark.read.parquet(str(tmp_path / "t")))
    assert "FileScan" not in table._jdf.queryExecution().toString()  # all figures come from the counted values
    got = {r["column"]: r for r in table.collect()}
    assert tuple(got["x"])[1:] == pytest.approx((4, 3.125, np.std([3, 3, -1.5, 8], ddof=1), -1.5, 1.875, 3, 4.25, 8))
    assert tuple(got["one"])[1:] == (1, 7, None, 7, 7, 7, 7, 7)
    assert tuple(got["none"])[1:] == (0, *[None] * 7)
