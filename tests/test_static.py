import math

from compare import by

from buycast.operators.cutoffs import cutoff, rolling_splits
from buycast.operators.static import STATIC_COLUMNS, agg_features, partial_rows
from buycast.plans.features import build_splits, feature_columns, feature_set


def test_last_skips_nulls_per_column_and_breaks_ties_by_line(make_lines):
    df = make_lines(
        {"customer_id": 1, "order_pay_time": "2013-01-01T10:00:00", "goods_status": 1, "customer_city": "a", "goods_id": 7},
        {"customer_id": 1, "order_pay_time": "2013-01-02T10:00:00", "goods_status": 2, "goods_id": 8},
        {"customer_id": 1, "order_pay_time": "2013-01-02T10:00:00", "goods_id": 9, "customer_gender": None},
    )
    row = by(agg_features(df), "customer_id")[1]
    assert row["goods_id_last"] == 9
    assert row["goods_status_last"] == 2
    assert row["customer_city"] == "a"
    assert row["customer_province"] == "-999"
    assert row["customer_gender"] == 0
    assert row["member_id_last"] == -999


def test_single_row_and_equal_values(make_lines):
    df = make_lines(
        {"customer_id": 1, "order_pay_time": "2013-01-01", "goods_price": 9.99, "order_total_payment": 5},
        *[{"customer_id": 2, "order_pay_time": "2013-01-01", "goods_price": 98401.51, "order_total_payment": p}
          for p in (1, 2, 4)],
    )
    rows = by(agg_features(df), "customer_id")
    assert rows[1]["goods_price_std"] == -999
    assert rows[2]["goods_price_std"] == 0
    assert math.isclose(rows[2]["order_total_payment_std"], math.sqrt(7 / 3))
    assert math.isclose(rows[2]["goods_price_mean"], 98401.51)


def test_all_null_column_sums_to_zero(make_lines):
    row = by(agg_features(make_lines({"customer_id": 1, "order_pay_time": "2013-01-01"})), "customer_id")[1]
    assert row["is_customer_rate_sum"] == 0
    assert row["is_customer_rate_mean"] == -999
    assert row["order_count"] == 0 and row["order_detail_count"] == 1


def test_discount_without_payment_is_missing(make_lines):
    df = make_lines(
        {"customer_id": 1, "order_pay_time": "2013-01-01", "order_detail_amount": 0, "order_detail_payment": 0},
        {"customer_id": 2, "order_pay_time": "2013-01-01", "order_detail_amount": 3, "order_detail_payment": 0},
        {"customer_id": 3, "order_pay_time": "2013-01-01", "order_detail_amount": 3, "order_detail_payment": 4},
    )
    rows = by(agg_features(df), "customer_id")
    assert rows[1]["discount"] == -999 and rows[2]["discount"] == -999 and rows[3]["discount"] == 0.75


def test_clock_parts_and_day_differences(make_lines):
    df = make_lines({
        "customer_id": 1, "order_pay_time": "2013-07-01T23:59:58", "goods_list_time": "2012-10-10T23:00:00",
        "goods_delist_time": "2012-10-12T01:00:00"})
    row = by(agg_features(df), "customer_id")[1]
    assert [row[f"order_pay_time_last_{p}"] for p in ("m", "d", "h", "min", "s", "weekday")] == [7, 1, 23, 59, 58, 0]
    assert row["goods_list_time_diff"] == -1 and row["goods_delist_time_diff"] == 1 and row["goods_time_diff"] == 2


def test_columns():
    assert len(STATIC_COLUMNS) == 61 and len(feature_columns("time")) == 65 and len(feature_columns("both")) == 126


def _shop(make_lines, *more):
    base = [
        {"customer_id": 1, "order_pay_time": "2013-03-01", "order_total_payment": 10, "order_total_num": 1, "customer_city": "x"},
        {"customer_id": 1, "order_pay_time": "2013-07-31T23:59:59", "order_total_payment": 20, "order_total_num": 2},
        {"customer_id": 2, "order_pay_time": "2013-01-05", "order_total_payment": 5, "order_total_num": 1, "customer_city": "y"},
        {"customer_id": 3, "order_pay_time": "2013-07-15", "order_total_payment": 5, "order_total_num": 0, "customer_city": "z"},
        {"customer_id": None, "order_pay_time": "2013-03-01", "order_total_payment": 5, "order_total_num": 1},
        {"customer_id": 4, "order_pay_time": None, "order_total_payment": 5, "order_total_num": 1},
    ]
    return make_lines(*base, *more)


def test_labels_and_population(make_lines):
    rows = by(feature_set(_shop(make_lines), rolling_splits(), "time"), "split", "customer_id")
    assert {k for k in rows if k[0] == "train"} == {("train", 1), ("train", 2)}
    assert rows["train", 1]["label"] == 1 and rows["train", 2]["label"] == 0
    assert rows["validation", 1]["label"] == 0 and rows["validation", 3]["payment_sum_30d"] == 5
    assert rows["test", 1]["label"] is None
    # customer 2 bought before the history floor only
    assert rows["train", 2]["payment_sum_91d"] == -999


def test_label_rules(make_lines):
    shop = _shop(make_lines, {"customer_id": 2, "order_pay_time": "2013-12-24", "order_total_num": 1})
    cuts = [cutoff("train", "2013-06-30")]

    def labels(rule):
        return {k: r["label"] for k, r in by(feature_set(shop, cuts, "time", label_rule=rule), "customer_id").items()}

    assert labels("month") == {1: 1, 2: 0}
    assert labels("open") == {1: 1, 2: 1}
    assert labels("goods30") == {1: 0, 2: 0}  # 07-31 is day 31


def test_rows_after_the_cutoff_do_not_leak(make_lines):
    cuts = [cutoff("a", "2013-06-30", False)]
    later = {"customer_id": 1, "order_pay_time": "2013-07-01", "order_total_payment": 999, "order_total_num": 9,
             "goods_price": 1, "customer_city": "new"}
    before = feature_set(_shop(make_lines), cuts, "both").orderBy("customer_id").collect()
    assert before == feature_set(_shop(make_lines, later), cuts, "both").orderBy("customer_id").collect()


def test_cutoffs_in_one_plan_equal_separate_runs(make_lines):
    shop, cuts = _shop(make_lines), rolling_splits()
    together = by(feature_set(shop, cuts, "both"), "split", "customer_id")
    apart = {}
    for c in cuts:
        apart.update(by(feature_set(shop, [c], "both"), "split", "customer_id"))
    assert together == apart


def test_unseen_and_missing_cities(make_lines):
    splits = build_splits(_shop(make_lines), rolling_splits(), "agg")
    codes = {n: {r["customer_id"]: r["customer_city"] for r in df.collect()} for n, df in splits.items()}
    assert codes["train"] == {1: 0, 2: 1}
    assert codes["validation"] == {1: 0, 2: 1, 3: -1}
    assert splits["train"].columns == splits["validation"].columns
    assert splits["test"].columns == splits["train"].columns[:-1]
    # no province anywhere: the missing text is an ordinary class
    assert {r["customer_province"] for r in splits["test"].collect()} == {0}


def test_partial_rows_keep_no_counts_that_the_null_pattern_gives(make_lines):
    df = make_lines(
        {"customer_id": 1, "order_id": 1, "order_pay_time": "2013-01-01", "goods_id": 7, "goods_price": 4, "order_total_discount": 1},
        {"customer_id": 1, "order_id": 2, "order_pay_time": "2013-01-02", "goods_id": 7, "order_total_discount": 4},
        {"customer_id": 1, "order_pay_time": "2013-01-03", "goods_price": 8},
    )
    kept = partial_rows(df, ["customer_id"], ["order_pay_time", "order_detail_id"], extras=True).columns
    assert [c for c in kept if c.startswith("n_")] == ["n_order_id", "n_rows"]
    row = by(agg_features(df, extras=True), "customer_id")[1]
    assert (row["goods_price_mean"], row["order_total_discount_mean"], row["goods_status_mean"]) == (6, 2.5, -999)
    assert (row["goods_count"], row["order_count"], row["order_detail_count"]) == (2, 2, 3)
