"""Whole feature tables: method switch, labels, splits and encoding."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buycast.functions.times import up_to
from buycast.operators.clean import align
from buycast.operators.cutoffs import Cutoff
from buycast.operators.encode import apply_codes, encode_each, fit_codes
from buycast.operators.profile import narrow_types
from buycast.operators.static import (
    CATEGORIES, MISSING, ORIGIN, STATIC_COLUMNS, agg_of_partial, by_number, customer_features, fill_missing, partial_rows,
)
from buycast.operators.windows import FLOOR, LABEL_DAYS, daily, window_columns, window_features
from buycast.runtime import beside, stored

KEYS = ["split", "cutoff", "customer_id"]
METHODS = ("agg", "time", "both")


def feature_columns(method):
    if method not in METHODS:
        raise NotImplementedError(f"unknown method {method!r}")
    static = STATIC_COLUMNS if method in ("agg", "both") else []
    return static + (window_columns() if method in ("time", "both") else [])


def goods_labels(daily_rows: DataFrame, cutoffs: list[Cutoff]) -> DataFrame:
    """(split, cutoff, customer_id) that bought goods on any of the 30 days after the cut-off."""
    listed = F.array(*[
        F.struct(F.lit(i).alias("no"), F.lit(c.day).alias("day")) for i, c in enumerate(cutoffs) if c.has_label
    ])
    hit = F.filter(listed, lambda c: F.datediff(F.col("day"), c["day"]).between(1, LABEL_DAYS))
    return (
        daily_rows.filter(F.col("goods") > 0)
        .select("customer_id", F.explode(hit).alias("c"))
        .select("customer_id", F.col("c.no").alias("no")).distinct()
        .select(
            by_number([c.split for c in cutoffs], F.col("no")).alias("split"),
            by_number([c.day for c in cutoffs], F.col("no")).alias("cutoff"),
            "customer_id", F.lit(1).alias("bought"),
        )
    )


def feature_set(df: DataFrame, cutoffs: list[Cutoff], method="both", label_rule="month",
                ord_col=("order_pay_time", "order_detail_id"), floor=FLOOR, origin=None, fill=MISSING,
                daily_rows: DataFrame | None = None, people: DataFrame | None = None) -> DataFrame:
    """(split, cutoff, customer_id, features, label) for all cut-offs in one plan.

    The customers of a cut-off are those with a line up to it. Static features and label come out of
    one pass over the lines; window features join them by (cut-off, customer), both sides having one
    row per pair. Missing values are filled last; ``fill=None`` leaves them null.

    ``daily_rows`` may bring ready ``daily`` sums, for example from a source that reads fewer tables
    for them than for ``df``, and ``people`` ready ``customer_features``; with both, ``df`` is not read.
    """
    names = feature_columns(method)
    extra = {} if origin is None else {"origin": origin}
    by_goods = label_rule == "goods30"
    out = people if people is not None else customer_features(
        df, cutoffs, label_rule=None if by_goods else label_rule, ord_col=ord_col,
        with_static=method != "time", **extra,
    )
    per_day = daily(df, floor) if daily_rows is None else daily_rows
    if method != "agg":
        out = beside(out, window_features(per_day, cutoffs), "customer_id", ["split", "cutoff"])
    if by_goods:
        has_label = by_number([c.has_label for c in cutoffs], F.array_position(
            F.array(*[F.lit(c.split) for c in cutoffs]), F.col("split")).cast("int") - 1)
        out = out.join(goods_labels(per_day, cutoffs), KEYS, "left").withColumn(
            "label", F.when(has_label, F.coalesce("bought", F.lit(0))))
    out = out.select(*KEYS, *names, "label")
    return out if fill is None else fill_missing(out, fill, names)


def build_splits(df: DataFrame, cutoffs: list[Cutoff], method="both", train="train", **options):
    """{split: DataFrame} with ``customer_id``, the features in the training order and, where known, ``label``.

    Province and city become codes learnt on the training split; a value it lacks becomes −1. The
    features are written once before that, a folder per split, since the dictionary and every split read them.
    """
    names = feature_columns(method)
    features = stored(feature_set(df, cutoffs, method, **options), folders=["split"])
    for col in CATEGORIES if method != "time" else []:
        codes = fit_codes(features.filter(F.col("split") == train), col)
        features = apply_codes(features, codes, col)
    return {
        c.split: align(
            features.filter(F.col("split") == c.split),
            ["customer_id", *names, *(["label"] if c.has_label else [])],
        )
        for c in cutoffs
    }


def single_cutoff_tables(df: DataFrame, day, ord_col=("order_pay_time", "order_detail_id"), origin=ORIGIN):
    """(train, test) of static features: train up to ``day`` with the label "any later line", test over all lines.

    Province and city get codes per table, so the codes of the two tables are not comparable. The lines are read once:
    both tables and the label come from partial rows per customer and side of ``day``.
    """
    order = [ord_col] if isinstance(ord_col, str) else list(ord_col)
    # null where the time is unknown: such a line is in the test table alone
    rows = df.filter(F.col("customer_id").isNotNull()).withColumn("later", ~up_to(F.col("order_pay_time"), day))
    partial = stored(partial_rows(rows, ["customer_id", "later"], order, extras=False))
    train = agg_of_partial(partial.filter(~F.col("later")).drop("later"), order, origin)
    buyers = partial.filter("later").select("customer_id").distinct().withColumn("label", F.lit(1))
    train = train.join(buyers, "customer_id", "left").withColumn("label", F.coalesce("label", F.lit(0)))
    train, test = stored(train), stored(agg_of_partial(partial.drop("later"), order, origin))
    for col in CATEGORIES:
        train, test = encode_each([train, test], col)
    return train, test


def slot_tables(daily_rows: DataFrame, train_slots: list[Cutoff], scoring_slot: Cutoff):
    """(train, test) of window features by slots: all train slots stacked with their 30-day goods label, and the
    scoring slot without one. Both hold every customer of ``daily_rows`` and use the smallest column types."""
    train = window_features(daily_rows, train_slots, variant="legacy", population="all", label=True)
    test = window_features(daily_rows, [scoring_slot], variant="legacy", population="all")
    return narrow_types(stored(train)), narrow_types(stored(test))
