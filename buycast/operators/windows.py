"""Trailing-window features over daily sums, kept in long form: the customer × day matrix is never built."""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buycast.functions.times import as_date, days, start_of
from buycast.operators.cutoffs import Cutoff
from buycast.operators.static import by_number

FLOOR = "2013-02-01"
PAYMENT_WINDOWS = (14, 30, 60, 91)
GOODS_WINDOWS = (21, 49, 84)
LABEL_DAYS = 30


def daily(df: DataFrame, floor=FLOOR) -> DataFrame:
    """(customer_id, day, payment, goods): sums per customer and day from ``floor`` on, zero if all null."""
    paid = F.col("order_pay_time")
    return (
        df.filter(F.col("customer_id").isNotNull() & (paid >= start_of(floor)))
        .groupBy("customer_id", F.to_date(paid).alias("day"))
        .agg(
            F.coalesce(F.sum("order_total_payment").cast("double"), F.lit(0.0)).alias("payment"),
            F.coalesce(F.sum("order_total_num").cast("double"), F.lit(0.0)).alias("goods"),
        )
    )


def pivot_daily(daily_rows: DataFrame, start, end, value="payment") -> DataFrame:
    """The matrix as a view for a bounded list of days: one column per day, 0 where nothing was bought.

    Every customer with a row on any day has one here, also if it lies outside the days listed.
    """
    start, end = as_date(start), as_date(end)
    listed = [start + dt.timedelta(days=i) for i in range((end - start).days + 1)]
    return daily_rows.groupBy("customer_id").agg(*[
        F.coalesce(F.sum(F.when(F.col("day") == F.lit(d), F.col(value))), F.lit(0.0)).alias(d.isoformat()) for d in listed])


def calendar(spark, start, end) -> DataFrame:
    """One row per day."""
    return spark.range(1).select(F.explode(days(start, end)).alias("day"))


class _Series:
    """SQL aggregates of one daily value over windows of age a = cut-off day − day, 0 ≤ a < T."""

    def __init__(self, value, active, variant, base):
        self.x, self.active, self.variant, self.base = value, active, variant, base

    def inside(self, length, shift=0):
        return f"a >= {shift} AND a < {shift + length}"

    def total(self, length, shift=0):
        return f"coalesce(sum(if({self.inside(length, shift)}, {self.x}, null)), 0D)"

    def decayed(self, length, shift=0):
        weighted = f"{self.x} * power({self.base}D, a - {shift})"
        return f"coalesce(sum(if({self.inside(length, shift)}, {weighted}, null)), 0D)"

    def highest(self, length, shift=0):
        """The maximum, where a day without a row counts as 0."""
        inside = self.inside(length, shift)
        top = f"max(if({inside}, {self.x}, null))"
        return f"if(count_if({inside}) = {length}, {top}, greatest(coalesce({top}, 0D), 0D))"

    def _active_inside(self, length):
        return f"{self.inside(length)} AND {self.active}"

    def active_days(self, length):
        return f"count_if({self._active_inside(length)})"

    def last_active(self, length):
        nearest = "a + 1" if self.variant == "legacy" else "a"
        return f"coalesce(min(if({self._active_inside(length)}, {nearest}, null)), {length})"

    def first_active(self, length):
        return f"coalesce(max(if({self._active_inside(length)}, a + 1, null)), 0)"

    def block(self, number, length):
        return self.total(length, (number - 1) * length)


def _features(payment_windows, goods_windows, base, variant):
    """Feature name → SQL aggregate over rows with age ``a``, ``payment`` and ``goods``."""
    pay = _Series("payment", "payment != 0", variant, base)
    goods = _Series("goods", "goods > 0", variant, base)
    out = {}
    for n in payment_windows:
        out[f"payment_mean_{n}d_decay"] = pay.decayed(n)
        out[f"payment_max_{n}d"] = pay.highest(n)
        out[f"payment_sum_{n}d"] = pay.total(n)
        out[f"payment_mean_{n}d_decay_prev_week"] = pay.decayed(n, 7)
        out[f"payment_max_{n}d_prev_week"] = pay.highest(n, 7)
        out[f"payment_sales_days_in_last_{n}d"] = pay.active_days(n)
        out[f"payment_last_sale_days_ago_{n}d"] = pay.last_active(n)
        out[f"payment_first_sale_days_ago_{n}d"] = pay.first_active(n)
    for i in (1, 2, 3):
        out[f"payment_sum_month_{i}_before"] = pay.block(i, 30)
    for n in goods_windows:
        out[f"goods_mean_{n}d"] = f"{goods.total(n)} / {n}"
        out[f"goods_max_{n}d"] = goods.highest(n)
        out[f"goods_sum_{n}d"] = goods.total(n)
        out[f"goods_mean_{n}d_prev_week"] = f"{goods.total(n, 7)} / {n}"
        out[f"goods_max_{n}d_prev_week"] = goods.highest(n, 7)
        out[f"goods_sum_{n}d_prev_week"] = goods.total(n, 7)
        out[f"goods_purchase_days_in_last_{n}d"] = goods.active_days(n)
        out[f"goods_last_purchase_days_ago_{n}d"] = goods.last_active(n)
        out[f"goods_first_purchase_from_start_{n}d"] = goods.first_active(n)
    for i in (1, 2, 3):
        out[f"goods_sum_pseudomonth_{i}_before"] = goods.block(i, 28)
    return out


def window_columns(payment_windows=PAYMENT_WINDOWS, goods_windows=GOODS_WINDOWS):
    return list(_features(payment_windows, goods_windows, 0.9, "uni"))


def window_features(daily_rows: DataFrame, cutoffs: list[Cutoff], payment_windows=PAYMENT_WINDOWS,
                    goods_windows=GOODS_WINDOWS, decay=0.9, variant="uni", population="upto_cutoff",
                    label=False) -> DataFrame:
    """(split, cutoff, customer_id, 65 features [, label]) from ``daily`` rows.

    A cut-off D covers days D−T+1 … D; a slot date B means D = B − 1 (``variant="legacy"`` differs
    only in how the last active day is counted). ``population="upto_cutoff"`` has the customers with
    a row up to D, ``"all"`` every customer of ``daily_rows``. ``label=True`` adds 1 if goods were
    bought on any of the 30 days after D.

    A customer has at most one row per day, so hashing the narrow daily rows by customer is even
    whatever the skew of the order lines; the cut-offs are then spread out and aggregated in place.
    """
    if variant not in ("uni", "legacy"):
        raise NotImplementedError(f"unknown variant {variant!r}")
    if population not in ("upto_cutoff", "all"):
        raise NotImplementedError(f"unknown population {population!r}")
    listed = F.array(*[
        F.struct(F.lit(i).alias("no"), F.lit(c.day).alias("day")) for i, c in enumerate(cutoffs)
    ])
    ahead = LABEL_DAYS if label else 0
    if population == "upto_cutoff":
        last_day = max(c.day for c in cutoffs) + dt.timedelta(days=ahead)
        daily_rows = daily_rows.filter(F.col("day") <= F.lit(last_day))
        listed = F.filter(listed, lambda c: F.datediff(c["day"], F.col("day")) >= -ahead)
    aged = (
        daily_rows.repartition("customer_id")
        .select("customer_id", "payment", "goods", "day", F.explode(listed).alias("c"))
        .select("customer_id", "payment", "goods", F.col("c.no").alias("cutoff_no"),
                F.datediff("c.day", "day").alias("a"))
    )
    features = _features(payment_windows, goods_windows, decay, variant)
    aggregates = [f"cast({e} as double) AS {n}" for n, e in features.items()]
    aggregates.append("count_if(a >= 0) AS seen")
    if label:
        bought = f"max(if(a BETWEEN -{LABEL_DAYS} AND -1, goods, null)) > 0"
        aggregates.append(f"cast(coalesce({bought}, false) as int) AS label")
    out = aged.groupBy("cutoff_no", "customer_id").agg(*[F.expr(e) for e in aggregates])
    if population == "upto_cutoff":
        out = out.filter(F.col("seen") > 0)
    return out.select(
        by_number([c.split for c in cutoffs]).alias("split"),
        by_number([c.day for c in cutoffs]).alias("cutoff"),
        "customer_id", *features, *(["label"] if label else []),
    )
