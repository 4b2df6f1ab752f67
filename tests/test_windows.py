import datetime as dt
import random

import pytest
from compare import by

from buycast.functions.times import add_months, month_window
from buycast.operators.cutoffs import cutoff, slots
from buycast.operators.windows import daily, pivot_daily, window_columns, window_features

D = dt.date(2013, 6, 30)


def days(spark, rows):
    """(customer, age at D, payment, goods) to daily rows."""
    return spark.createDataFrame(
        [(c, D - dt.timedelta(days=a), float(p), float(g)) for c, a, p, g in rows],
        "customer_id long, day date, payment double, goods double")


def brute(rows, variant="uni", shift=0):
    """The features of one customer from a dict age → (payment, goods), straight from their definition."""
    out = {}

    def series(i, start, n):
        return [rows.get(a, (0.0, 0.0))[i] for a in range(start, start + n)]

    for i, name, lengths in ((0, "payment", (14, 30, 60, 91)), (1, "goods", (21, 49, 84))):
        for n in lengths:
            now, prev = series(i, 0, n), series(i, 7, n)
            on = [x != 0 if i == 0 else x > 0 for x in now]
            step = 1 if variant == "legacy" else 0
            last = next((a + step for a, x in enumerate(on) if x), n)
            first = max((a + 1 for a, x in enumerate(on) if x), default=0)
            out[f"{name}_max_{n}d"], out[f"{name}_sum_{n}d"] = max(now), sum(now)
            out[f"{name}_max_{n}d_prev_week"] = max(prev)
            if i == 0:
                out[f"payment_mean_{n}d_decay"] = sum(x * 0.9**a for a, x in enumerate(now))
                out[f"payment_mean_{n}d_decay_prev_week"] = sum(x * 0.9**a for a, x in enumerate(prev))
                out[f"payment_sales_days_in_last_{n}d"] = sum(on)
                out[f"payment_last_sale_days_ago_{n}d"], out[f"payment_first_sale_days_ago_{n}d"] = last, first
            else:
                out[f"goods_mean_{n}d"], out[f"goods_mean_{n}d_prev_week"] = sum(now) / n, sum(prev) / n
                out[f"goods_sum_{n}d_prev_week"] = sum(prev)
                out[f"goods_purchase_days_in_last_{n}d"] = sum(on)
                out[f"goods_last_purchase_days_ago_{n}d"] = last
                out[f"goods_first_purchase_from_start_{n}d"] = first
    for i in (1, 2, 3):
        out[f"payment_sum_month_{i}_before"] = sum(series(0, 30 * (i - 1), 30))
        out[f"goods_sum_pseudomonth_{i}_before"] = sum(series(1, 28 * (i - 1), 28))
    return out


@pytest.mark.parametrize("variant", ["uni", "legacy"])
def test_against_definition(spark, variant):
    rng = random.Random(7)
    people = {
        1: {0: (5, 1)}, 2: {13: (5, 1)}, 3: {14: (5, 1)}, 4: {20: (5, 2)}, 5: {97: (1, 1)}, 6: {150: (1, 1)},
        7: {a: (-3, 1) for a in range(14)}, 8: {a: (-2, 0) for a in range(120)}, 9: {3: (0, 0)},
        10: {a: (round(rng.uniform(-5, 50), 2), rng.randint(0, 3)) for a in rng.sample(range(110), 60)},
    }
    table = days(spark, [(c, a, *v) for c, rows in people.items() for a, v in rows.items()])
    got = by(window_features(table, [cutoff("x", D)], variant=variant), "customer_id")
    assert set(got) == set(people) and set(window_columns()) <= set(got[1])
    for c, rows in people.items():
        want = brute(rows, variant)
        assert set(want) == set(window_columns())
        for name, value in want.items():
            assert got[c][name] == pytest.approx(value, abs=1e-9), (c, name)


def test_populations_and_label(spark):
    table = days(spark, [(1, 5, 1, 1), (2, -1, 1, 1), (3, -30, 1, 1), (3, 0, 0, 0), (4, -31, 1, 1), (4, 200, 1, 1)])
    cuts = [cutoff("x", D)]
    some = by(window_features(table, cuts, label=True), "customer_id")
    assert {c: r["label"] for c, r in some.items()} == {1: 0, 3: 1, 4: 0}
    everyone = by(window_features(table, cuts, population="all", label=True), "customer_id")
    assert {c: r["label"] for c, r in everyone.items()} == {1: 0, 2: 1, 3: 1, 4: 0}
    assert everyone[2]["payment_sum_91d"] == 0 and everyone[2]["payment_last_sale_days_ago_14d"] == 14


def test_slots_are_the_day_before():
    assert [c.day for c in slots("2013-07-01", 2)] == [dt.date(2013, 6, 30), dt.date(2013, 7, 7)]


def test_daily_floor_and_null_sums(make_lines):
    df = make_lines(
        {"customer_id": 1, "order_pay_time": "2013-01-31T23:59:59", "order_total_payment": 1, "order_total_num": 1},
        {"customer_id": 1, "order_pay_time": "2013-02-01T00:00:00", "order_total_payment": 2, "order_total_num": 1},
        {"customer_id": 1, "order_pay_time": "2013-02-01T09:00:00", "order_total_payment": 3},
        {"customer_id": 2, "order_pay_time": "2013-02-02T09:00:00"},
    )
    rows = by(daily(df), "customer_id", "day")
    assert {k: (r["payment"], r["goods"]) for k, r in rows.items()} == {
        (1, dt.date(2013, 2, 1)): (5, 1), (2, dt.date(2013, 2, 2)): (0, 0)}


def test_matrix_gives_the_same_sums(spark):
    table = days(spark, [(1, a, a, 1) for a in range(0, 20, 3)] + [(2, 6, 2, 2)])
    wide = by(pivot_daily(table, D - dt.timedelta(days=13), D), "customer_id")
    long = by(window_features(table, [cutoff("x", D)]), "customer_id")
    for c, row in wide.items():
        assert sum(v for k, v in row.items() if k != "customer_id") == long[c]["payment_sum_14d"]
        assert len(row) == 15


def test_month_steps():
    assert month_window("2013-06-30") == (dt.date(2013, 7, 1), dt.date(2013, 7, 31))
    assert month_window("2013-01-31") == (dt.date(2013, 2, 1), dt.date(2013, 2, 28))
    assert month_window("2013-02-28") == (dt.date(2013, 3, 1), dt.date(2013, 3, 31))
    assert month_window("2012-01-30") == (dt.date(2012, 1, 31), dt.date(2012, 2, 28))
    assert add_months("2012-12-31", 2) == dt.date(2013, 2, 28)


def test_unknown_options_raise(spark):
    table = days(spark, [(1, 0, 1, 1)])
    with pytest.raises(NotImplementedError):
        window_features(table, [cutoff("x", D)], variant="other")
    with pytest.raises(NotImplementedError):
        window_features(table, [cutoff("x", D)], population="other")
