"""Static features: one row per (cut-off, customer) that sums up all order lines so far.

Lines are first reduced to one partial row per customer, period and null pattern. A period lies
between two neighbouring boundaries (cut-offs and label ends). Rows with the same null pattern have
the same columns set, so one "latest line" holds the last value of all of them: the state of a group
is a single line instead of one (order, value) pair per column. Every state merges by max, min or
sum, and the few partial rows of a customer are then combined per cut-off. The order lines are
shuffled once for any number of cut-offs, after map-side reduction, so a customer with a third of
all lines sends a few rows per task.
"""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buycast.functions.times import start_of, up_to
from buycast.operators.cutoffs import Cutoff, label_end

ORIGIN = "2012-10-11"
MISSING = -999

# The columns of the static feature table, by how they are formed.
LAST = [
    "customer_gender",
    "goods_id", "goods_status", "goods_price", "goods_has_discount", "goods_list_time", "goods_delist_time",
    "order_total_num", "order_amount", "order_total_payment", "order_total_discount", "order_pay_time",
    "order_status", "order_count", "is_customer_rate", "order_detail_status", "order_detail_goods_num",
    "order_detail_amount", "order_detail_payment", "order_detail_discount",
    "member_id", "member_status", "is_member_actived",
    "customer_province", "customer_city",
]
SPREAD = ["goods_price", "order_total_payment"]
MEAN_AND_SUM = [
    "is_customer_rate", "member_status", "order_detail_discount", "goods_status", "is_member_actived",
    "order_status", "goods_has_discount", "order_total_num",
]
CATEGORIES = ["customer_province", "customer_city"]
UNSUFFIXED = {"customer_gender", "customer_province", "customer_city"}
TIME_PARTS = ["m", "d", "h", "min", "s", "weekday", "diff"]
EXTRAS = ["days_since_last_order", "order_total_discount_mean", "order_detail_goods_num_sum"]

STATIC_COLUMNS = (
    ["customer_gender"]
    + [f"goods_{c}_last" for c in ("id", "status", "price", "has_discount")]
    + [f"{c}_last" for c in (
        "order_total_num", "order_amount", "order_total_payment", "order_total_discount", "order_status",
        "order_count", "is_customer_rate", "order_detail_status", "order_detail_goods_num",
        "order_detail_amount", "order_detail_payment", "order_detail_discount", "member_id",
        "member_status", "is_member_actived")]
    + [f"{c}_{how}" for c in SPREAD for how in ("min", "max", "mean", "std")]
    + ["order_count", "goods_count"] + CATEGORIES
    + [f"{c}_{how}" for c in MEAN_AND_SUM for how in ("mean", "sum")]
    + ["order_total_payment_sum", "order_detail_count", "discount"]
    + [f"order_pay_time_last_{p}" for p in TIME_PARTS]
    + ["goods_list_time_diff", "goods_delist_time_diff", "goods_time_diff"]
)

REQUIRED = sorted(set(LAST) | {"customer_id", "order_id"})


def _null_pattern():
    """One bit per column of LAST, set where the line has no value."""
    return " | ".join(f"if({c} is null, {1 << i}, 0)" for i, c in enumerate(LAST))


def partial_rows(df, keys, order, extras):
    """One row per ``keys`` and null pattern holding the mergeable states.

    How many values a column of ``LAST`` has is no state: all rows of a null pattern have one, or none has.
    """
    key = ", ".join(f"'o{i}', {c}" for i, c in enumerate(order))
    values = ", ".join(f"'{c}', {c}" for c in LAST)
    states = {"latest": f"max(named_struct({key}, 'v', named_struct({values})))"}
    for c in SPREAD:
        exact = f"cast({c} as decimal(18,4))"
        states[f"min_{c}"] = f"min({c})"
        states[f"max_{c}"] = f"max({c})"
        states[f"square_{c}"] = f"sum({exact} * {exact})"
        states[f"sum_{c}"] = f"sum({exact})"
    for c in MEAN_AND_SUM:
        states[f"sum_{c}"] = f"sum({c})"
    if extras:
        states["sum_order_total_discount"] = "sum(order_total_discount)"
        states["sum_order_detail_goods_num"] = "sum(order_detail_goods_num)"
    states["n_order_id"] = "count(order_id)"
    states["n_rows"] = "count(1)"
    rows = df.withColumn("nulls", F.expr(_null_pattern()))
    return rows.groupBy(*keys, "nulls").agg(*[F.expr(f"{e} AS {n}") for n, e in states.items()]).drop("nulls")


def _merged_states(partial, keys, order, condition="true"):
    """SQL aggregates that combine the partial rows for which ``condition`` holds."""
    key = ", ".join(f"'o{i}', latest.o{i}" for i in range(len(order)))
    out = []
    for name in partial.columns:
        if name == "latest":
            for c in LAST:
                pair = f"named_struct({key}, 'v', latest.v.{c})"
                out.append(f"max(if({condition} AND latest.v.{c} is not null, {pair}, null)) AS last_{c}")
            for c in LAST:
                if c == "goods_id" or f"sum_{c}" in partial.columns:
                    out.append(f"sum(if({condition}, if(latest.v.{c} is null, 0L, n_rows), null)) AS n_{c}")
        elif name not in keys:
            how = {"max": "max", "min": "min"}.get(name.split("_", 1)[0], "sum")
            out.append(f"{how}(if({condition}, {name}, null)) AS {name}")
    return [F.expr(e) for e in out]


def _std(c):
    """Sample standard deviation from exact sums: null for a single value, exactly 0 for equal ones."""
    n, total, square = f"n_{c}", f"sum_{c}", f"square_{c}"
    exact = f"try_subtract(try_multiply({square}, cast({n} as decimal(18,0))), try_multiply({total}, {total}))"
    rough = f"greatest(cast({square} as double) * {n} - power(cast({total} as double), 2), 0D)"
    spread = f"coalesce(cast({exact} as double), {rough})"
    return f"if({n} > 1, sqrt({spread} / (cast({n} as double) * ({n} - 1))), null)"


def _finish(origin, extras, day):
    """(names, name → SQL) of the feature columns over merged states, still with nulls."""
    def mean(c):
        return f"cast(sum_{c} as double) / nullif(n_{c}, 0)"

    def total(c):
        return f"coalesce(cast(sum_{c} as double), 0D)"

    def since(time):
        return f"datediff(cast({time} as date), DATE'{origin}')"

    out = {}
    for c in LAST:
        if c in UNSUFFIXED:
            out[c] = f"last_{c}.v"
        elif not c.endswith("_time"):
            out[f"{c}_last"] = f"last_{c}.v"
    out["customer_gender"] = "coalesce(last_customer_gender.v, 0)"
    for c in SPREAD:
        out[f"{c}_min"], out[f"{c}_max"], out[f"{c}_mean"], out[f"{c}_std"] = f"min_{c}", f"max_{c}", mean(c), _std(c)
    out["order_count"], out["goods_count"] = "n_order_id", "n_goods_id"
    for c in MEAN_AND_SUM:
        out[f"{c}_mean"], out[f"{c}_sum"] = mean(c), total(c)
    out["order_total_payment_sum"] = total("order_total_payment")
    out["order_detail_count"] = "n_rows"
    out["discount"] = "try_divide(cast(last_order_detail_amount.v as double), cast(last_order_detail_payment.v as double))"
    paid = "last_order_pay_time.v"
    clock = {"m": "month", "d": "day", "h": "hour", "min": "minute", "s": "second", "weekday": "weekday"}
    for part, function in clock.items():
        out[f"order_pay_time_last_{part}"] = f"{function}({paid})"
    out["order_pay_time_last_diff"] = since(paid)
    listed, gone = since("last_goods_list_time.v"), since("last_goods_delist_time.v")
    out["goods_list_time_diff"], out["goods_delist_time_diff"] = listed, gone
    out["goods_time_diff"] = f"{gone} - {listed}"
    names = list(STATIC_COLUMNS)
    if extras:
        out["days_since_last_order"] = f"datediff({day}, cast({paid} as date))"
        out["order_total_discount_mean"] = mean("order_total_discount")
        out["order_detail_goods_num_sum"] = total("order_detail_goods_num")
        names += EXTRAS
    return names, out


def _as_feature(name, value):
    """Numbers as double, so that every feature can hold the fill value; categories stay text."""
    return F.expr(value if name in CATEGORIES else f"cast({value} as double)").alias(name)


def fill_missing(df: DataFrame, value=MISSING, columns=None) -> DataFrame:
    """Null to the fill value, as a number or as text by the type of the column."""
    columns = columns or df.columns
    return df.fillna(value, subset=columns).fillna(str(value), subset=columns)


def agg_features(df: DataFrame, ord_col=("order_pay_time", "order_detail_id"), origin=ORIGIN, fill=MISSING,
                 extras=False) -> DataFrame:
    """One row of static features per customer over all lines of ``df``.

    ``ord_col`` names the columns whose order decides which value is the last; together they must
    be unique per customer. ``fill=None`` leaves nulls.
    """
    order = [ord_col] if isinstance(ord_col, str) else list(ord_col)
    partial = partial_rows(df.filter(F.col("customer_id").isNotNull()), ["customer_id"], order, extras)
    return agg_of_partial(partial, order, origin, fill, extras)


def agg_of_partial(partial: DataFrame, order, origin=ORIGIN, fill=MISSING, extras=False) -> DataFrame:
    """``agg_features`` from partial rows (customer_id, mergeable states)."""
    merged = partial.groupBy("customer_id").agg(*_merged_states(partial, ["customer_id"], order))
    names, out = _finish(origin, extras, "cast(last_order_pay_time.v as date)")
    result = merged.select("customer_id", *[_as_feature(n, out[n]) for n in names])
    return result if fill is None else fill_missing(result, fill, names)


def boundaries_of(cutoffs, label_rule):
    """The days that cut-offs and label windows end with, in order."""
    ends = {c.day for c in cutoffs}
    if label_rule is not None:
        ends |= {label_end(c.day, label_rule) for c in cutoffs if c.has_label} - {None}
    return sorted(ends)


def period_of(time_col, boundaries):
    """Number of boundary days that end before ``time_col``: 0 up to the first one, and so on."""
    period = F.lit(0)
    for b in boundaries:
        period = period + (time_col >= start_of(b + dt.timedelta(days=1))).cast("int")
    return period


def _uses(cutoffs, boundaries, label_rule):
    """For each period number, the (cut-off, part) pairs it feeds; part 0 is features, 1 the label."""
    uses = []
    for period in range(len(boundaries) + 1):
        feeds = []
        for i, c in enumerate(cutoffs):
            if period <= boundaries.index(c.day):
                feeds.append((i, 0))
            elif label_rule is not None and c.has_label:
                end = label_end(c.day, label_rule)
                if end is None or period <= boundaries.index(end):
                    feeds.append((i, 1))
        uses.append(feeds)
    return uses


def _uses_column(uses):
    kind = "array<struct<cutoff_no:int,part:int>>"
    arrays = [
        F.array(*[F.struct(F.lit(i).alias("cutoff_no"), F.lit(p).alias("part")) for i, p in feeds]).cast(kind)
        if feeds else F.array().cast(kind)
        for feeds in uses
    ]
    return F.get(F.array(*arrays), F.col("period"))


def by_number(values, index=None):
    """Literal looked up by the ``cutoff_no`` column."""
    return F.get(F.array(*[F.lit(v) for v in values]), index if index is not None else F.col("cutoff_no"))


def customer_features(df: DataFrame, cutoffs: list[Cutoff], label_rule="month",
                      ord_col=("order_pay_time", "order_detail_id"), origin=ORIGIN,
                      with_static=True, extras=False) -> DataFrame:
    """(split, cutoff, customer_id [, static features], label) for every customer with a line up to the cut-off.

    The label is 1 if the customer has a line in the label window, 0 if not, null where the cut-off
    has none. Nulls among the features are left for the caller to fill.
    """
    order = [ord_col] if isinstance(ord_col, str) else list(ord_col)
    boundaries = boundaries_of(cutoffs, label_rule)
    rows = df.filter(F.col("customer_id").isNotNull() & F.col("order_pay_time").isNotNull())
    if not (label_rule == "open" and any(c.has_label for c in cutoffs)):
        rows = rows.filter(up_to(F.col("order_pay_time"), boundaries[-1]))
    rows = rows.withColumn("period", period_of(F.col("order_pay_time"), boundaries))
    if with_static:
        partial = partial_rows(rows, ["customer_id", "period"], order, extras)
    else:
        partial = rows.groupBy("customer_id", "period").agg(F.count(F.lit(1)).alias("n_rows"))
    return merged_features(partial, cutoffs, boundaries, label_rule, order, origin, with_static, extras)


def merged_features(partial: DataFrame, cutoffs: list[Cutoff], boundaries, label_rule, order, origin=ORIGIN,
                    with_static=True, extras=False) -> DataFrame:
    """``customer_features`` from partial rows (customer_id, period, mergeable states)."""
    # a few rows per customer (periods × null patterns) from here on, so hashing by customer is even
    spread = (
        partial.repartition("customer_id")
        .withColumn("use", F.explode(_uses_column(_uses(cutoffs, boundaries, label_rule))))
        .select("*", "use.cutoff_no", "use.part").drop("use", "period")
    )
    merged = (
        spread.groupBy("cutoff_no", "customer_id")
        .agg(
            *_merged_states(partial, ["customer_id", "period"], order, "part = 0"),
            F.max("part").alias("bought"),
        )
        .filter(F.col("n_rows") > 0)
    )
    merged = merged.withColumn("cutoff", by_number([c.day for c in cutoffs]))
    label = F.when(by_number([c.has_label for c in cutoffs]), F.col("bought"))
    names, out = _finish(origin, extras, "cutoff") if with_static else ([], {})
    return merged.select(
        by_number([c.split for c in cutoffs]).alias("split"),
        "cutoff",
        "customer_id",
        *[_as_feature(n, out[n]) for n in names],
        label.cast("int").alias("label"),
    )
