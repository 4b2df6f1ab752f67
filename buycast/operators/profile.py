"""Profiling of a table: what the usual look at a new data set reports, as DataFrames."""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from buycast.runtime import running_totals


def _long(row: DataFrame, names, fields) -> DataFrame:
    """One wide row of aggregates to one row per column name. ``fields``: output name → (name → column)."""
    entries = [
        F.struct(F.lit(n).alias("column"), *[make(n).alias(f) for f, make in fields.items()]) for n in names
    ]
    return row.select(F.inline(F.array(*entries)))


def numeric_columns(df: DataFrame):
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _is_missing(df, name):
    c = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def profile_schema(df: DataFrame) -> DataFrame:
    """(column, dtype, non_null, n_rows, n_columns)."""
    counted = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(~_is_missing(df, c)).alias(f"c_{c}") for c in df.columns],
    )
    types = dict(df.dtypes)
    return _long(counted, df.columns, {
        "dtype": lambda n: F.lit(types[n]),
        "non_null": lambda n: F.col(f"c_{n}"),
        "n_rows": lambda n: F.col("n_rows"),
        "n_columns": lambda n: F.lit(len(df.columns)),
    })


def profile_missing(df: DataFrame) -> DataFrame:
    """(column, missing, percent) of the columns with nulls, most first."""
    counted = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(_is_missing(df, c)).alias(f"c_{c}") for c in df.columns],
    )
    return _long(counted, df.columns, {
        "missing": lambda n: F.col(f"c_{n}"),
        "percent": lambda n: F.lit(100.0) * F.col(f"c_{n}") / F.col("n_rows"),
    }).filter(F.col("missing") > 0).orderBy(F.desc("percent"), "column")


def unique_counts(df: DataFrame, columns=None, approximate=False) -> DataFrame:
    """(column, n_unique). The exact count shuffles each distinct value once; the other keeps sketches.

    Exact: a line becomes one short (column, value as text) row per column, and repeated pairs are
    dropped before the shuffle. 0.0 and -0.0 are one value; NaN counts as missing.
    """
    columns = columns or df.columns
    if approximate:
        row = df.agg(*[F.approx_count_distinct(F.col(c)).alias(f"c_{c}") for c in columns])
        return _long(row, columns, {"n_unique": lambda n: F.col(f"c_{n}")})
    real = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    text = {c: f"cast(nanvl(`{c}`, null) + 0.0D as string)" if c in real else f"cast(`{c}` as string)" for c in columns}
    entries = ", ".join(f"named_struct('i', {i}, 'v', {text[c]})" for i, c in enumerate(columns))
    seen = df.select(F.expr(f"inline(array({entries}))")).groupBy("i", "v").agg(F.lit(1).alias("one"))
    names = F.array(*[F.lit(c) for c in columns])
    counted = seen.groupBy("i").agg(F.count("v").alias("n_unique"))
    return counted.select(F.get(names, F.col("i")).alias("column"), "n_unique")


def _values(df, columns):
    """(column, value) rows of the set values, as double. Keeps per-column aggregates small for any number of columns."""
    entries = ", ".join(f"named_struct('column', '{c}', 'value', cast(`{c}` as double))" for c in columns)
    rows = df.select(F.expr(f"inline(array({entries}))"))
    return rows.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def _exact_figures(df, columns, probs):
    """(column, total, mean, std, min, max, p0, p1, …) of the columns with values, from one pass over the lines.

    Values are counted first, so repeated values are one row; ranks come from running totals over
    the sorted distinct values, which stay range-partitioned. No task holds a whole column.
    """
    values = _values(df, columns)
    counts = values.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    ranked = running_totals(counts, "value", ["n"], groups=["column"])
    # one row per profiled column
    totals = ranked.groupBy("column").agg(
        F.sum("n").alias("total"), (F.sum(F.col("n") * F.col("value")) / F.sum("n")).alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"))
    ranked = ranked.join(F.broadcast(totals), "column")
    found, result = [], []
    for i, p in enumerate(probs):
        place = F.lit(float(p)) * (F.col("total") - 1)
        for side, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            holds = (F.col("n_before") <= rank) & (rank < F.col("n_before") + F.col("n"))
            found.append(F.max(F.when(holds, F.col("value"))).alias(f"{side}{i}"))
        part = F.lit(float(p)) * (F.col("total") - 1)
        lo, hi = F.col(f"lo{i}"), F.col(f"hi{i}")
        result.append((lo + (hi - lo) * (part - F.floor(part))).alias(f"p{i}"))
    away = F.col("value") - F.col("mean")
    whole = ["total", "mean", "min", "max"]
    out = ranked.groupBy("column").agg(*[F.first(c).alias(c) for c in whole], F.sum(F.col("n") * away * away).alias("squares"), *found)
    std = F.when(F.col("total") > 1, F.sqrt(F.col("squares") / (F.col("total") - 1)))
    return out.select("column", *whole, std.alias("std"), *result)


def exact_quantiles(df: DataFrame, columns, probs) -> DataFrame:
    """(column, p0, p1, …): exact quantiles with linear interpolation between neighbours."""
    return _exact_figures(df, columns, probs).select("column", *[f"p{i}" for i in range(len(probs))])


def quantile(df: DataFrame, col: str, q: float, method="exact") -> DataFrame:
    """One row (value). ``method="approx"`` keeps a bounded sketch per task instead of sorting."""
    if method == "approx":
        return df.agg(F.percentile_approx(F.col(col).cast("double"), q, 10_000).alias("value"))
    return exact_quantiles(df, [col], [q]).select(F.col("p0").alias("value"))


def describe_numeric(df: DataFrame, columns=None, method="exact") -> DataFrame:
    """(column, count, mean, std, min, q25, q50, q75, max)."""
    columns = columns or numeric_columns(df)
    if method == "approx":
        kinds = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max,
                 "q": lambda x: F.percentile_approx(x, [0.25, 0.5, 0.75], 10_000)}
        # all columns in one pass and one row; a column without values shows with count 0
        values = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
        row = df.agg(*[make(values[c]).alias(f"{kind}_{c}") for c in columns for kind, make in kinds.items()])
        rows = _long(row, columns, {kind: (lambda n, kind=kind: F.col(f"{kind}_{n}")) for kind in kinds})
        rows = rows.withColumns({f"q{p}": F.col("q")[i] for i, p in enumerate((25, 50, 75))})
    else:
        # the counted values give all figures; a column without values shows with count 0
        names = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("column"))
        figures = _exact_figures(df, columns, [0.25, 0.5, 0.75]).withColumnsRenamed({"total": "count", "p0": "q25", "p1": "q50", "p2": "q75"})
        rows = names.join(figures, "column", "left").fillna(0, "count")
    return rows.select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def value_share(df: DataFrame, col: str, top=None) -> DataFrame:
    """(value, n, percent) of the non-null values, most frequent first; ``top`` keeps that many."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    out = counts.withColumn("percent", F.lit(100.0) * F.col("n") / total).orderBy(F.desc("n"), "value")
    return out if top is None else out.limit(top)


#: Widths of the kernel within which it is above double precision.
REACH = 9.0


def _range_of(df, col):
    """Scalar struct (lo, hi) of a double column, widened by a half on each side if all values agree."""
    lo, hi = F.min(col), F.max(col)
    flat = lo == hi
    return df.agg(F.struct(
        F.when(flat, lo - 0.5).otherwise(lo).alias("lo"),
        F.when(flat, hi + 0.5).otherwise(hi).alias("hi"),
    )).scalar()


def _finite_values(df, col):
    x = df.select(F.col(col).cast("double").alias("x"))
    return x.filter(F.col("x").isNotNull() & ~F.isnan("x"))


def histogram(df: DataFrame, col: str, bins=50) -> DataFrame:
    """(bin, left_edge, right_edge, n): equal widths from min to max; the last bin includes the maximum."""
    values = _finite_values(df, col)
    limits = _range_of(values, "x")
    width = F.col("r.hi") - F.col("r.lo")
    counted = (
        values.withColumn("r", limits)
        .select(F.least(F.floor((F.col("x") - F.col("r.lo")) / width * bins), F.lit(bins - 1)).alias("bin"))
        .groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    )
    frame = df.sparkSession.range(bins).select(F.col("id").alias("bin")).withColumn("r", limits)
    return (
        frame.join(counted, "bin", "left")
        .select(
            "bin",
            (F.col("r.lo") + width * F.col("bin") / bins).alias("left_edge"),
            (F.col("r.lo") + width * (F.col("bin") + 1) / bins).alias("right_edge"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
        .orderBy("bin")
    )


def density(df: DataFrame, col: str, points=200) -> DataFrame:
    """(point, x, density): Gaussian kernel estimate from min to max, width std · n^(-1/5).

    Values are counted first; each distinct value then adds to the grid points that lie within ``REACH``
    widths, beyond which the kernel is below double precision. The sums are reduced to ``points`` rows
    before the shuffle. Where all values agree, or there is only one, the density is null.
    """
    values = _finite_values(df, col)
    weighted = values.groupBy("x").agg(F.count(F.lit(1)).alias("w"))
    shape = values.agg(F.struct(
        F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"),
        (F.stddev_samp("x") * F.pow(F.count("x").cast("double"), F.lit(-0.2))).alias("h"),
    )).scalar()
    at = F.col("s.lo") + (F.col("s.hi") - F.col("s.lo")) * F.col("point") / (points - 1)
    z = F.try_divide(at - F.col("x"), F.col("s.h"))
    step = F.try_divide(F.lit(float(points - 1)), F.col("s.hi") - F.col("s.lo"))
    first, last = ((F.col("x") - F.col("s.lo") + side * REACH * F.col("s.h")) * step for side in (-1, 1))
    near = F.sequence(F.greatest(F.ceil(first), F.lit(0)).cast("int"), F.least(F.floor(last), F.lit(points - 1)).cast("int"))
    # narrower than the grid, a value may reach no point at all
    near = F.when(F.greatest(F.ceil(first), F.lit(0)) <= F.least(F.floor(last), F.lit(points - 1)), near)
    sums = weighted.withColumn("s", shape).withColumn("point", F.explode(near)).groupBy("point").agg(
        F.sum(F.col("w") * F.exp(-0.5 * z * z)).alias("mass"))
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("point")).withColumn("s", shape)
    scale = F.when(F.col("s.h") > 0, F.col("s.n") * F.col("s.h") * math.sqrt(2 * math.pi))
    return grid.join(sums, "point", "left").select(
        "point", at.alias("x"), F.try_divide(F.coalesce("mass", F.lit(0.0)), scale).alias("density")).orderBy("point")


def orders_per_customer(df: DataFrame) -> DataFrame:
    """(customer_id, n_orders), most first."""
    return (
        df.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id").agg(F.count_distinct("order_id").alias("n_orders"))
        .orderBy(F.desc("n_orders"), "customer_id")
    )


def spend_per_customer(df: DataFrame) -> DataFrame:
    """(customer_id, spend), most first."""
    return (
        df.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.coalesce(F.sum("order_total_payment").cast("double"), F.lit(0.0)).alias("spend"))
        .orderBy(F.desc("spend"), "customer_id")
    )


def monthly_sales(df: DataFrame) -> DataFrame:
    """(month_end, payment): every month from the first to the last one, 0 where nothing was paid."""
    sales = (
        df.filter(F.col("order_pay_time").isNotNull())
        .groupBy(F.last_day(F.to_date("order_pay_time")).alias("month_end"))
        .agg(F.sum("order_total_payment").cast("double").alias("payment"))
    )
    first = F.trunc(F.min("month_end"), "month")
    last = F.trunc(F.max("month_end"), "month")
    months = (
        sales.agg(F.sequence(first, last, F.expr("interval 1 month")).alias("months"))
        .select(F.explode("months").alias("first_day"))
        .select(F.last_day("first_day").alias("month_end"))
    )
    return (
        months.join(sales, "month_end", "left")
        .select("month_end", F.coalesce("payment", F.lit(0.0)).alias("payment"))
        .orderBy("month_end")
    )


def hourly_counts(df: DataFrame) -> DataFrame:
    """(hour, n) by hour of day."""
    return (
        df.filter(F.col("order_pay_time").isNotNull())
        .groupBy(F.hour("order_pay_time").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
        .orderBy("hour")
    )


# The columns of the correlation matrix.
CORRELATED = [
    "order_total_num", "order_amount", "order_total_payment", "order_total_discount",
    "order_detail_goods_num", "order_detail_amount", "order_detail_payment", "goods_price",
]


def correlations(df: DataFrame, columns=None) -> DataFrame:
    """(a, b, corr) for all pairs, each over the rows where both are set; all pairs in one pass.

    A line becomes one short row per pair, which the map-side aggregate folds into one state per pair.
    """
    columns = columns or CORRELATED
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    entries = ", ".join(f"named_struct('a', '{a}', 'b', '{b}', 'x', `{a}`, 'y', `{b}`)" for a, b in pairs)
    found = (
        doubles.select(F.expr(f"inline(array({entries}))"))
        .groupBy("a", "b").agg(F.corr("x", "y").alias("corr"))
    )
    mirrored = F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b"))).otherwise(
        F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    return found.select("corr", F.explode(mirrored).alias("p")).select("p.a", "p.b", "corr")


def narrow_types(df: DataFrame, null_fill=-999) -> DataFrame:
    """Cast every numeric column to the smallest type that holds its values, nulls filled first.

    Whole-numbered columns become short, int, long or decimal(20,0) if never negative (room for the
    unsigned ranges up to 255, 65535, 2^32−1 and beyond), else byte, short, int or long; others
    become float.
    """
    names = [c for c in numeric_columns(df)]
    filled = df.select(*[
        F.when(_is_missing(df, c), F.lit(null_fill)).otherwise(F.col(c)).alias(c) if c in names else F.col(c)
        for c in df.columns
    ])
    x = F.col("value")
    finite = ~x.isin(float("inf"), float("-inf"))
    whole_part = F.when(x >= 0, F.floor(x)).otherwise(F.ceil(x))
    found = _values(filled, names).groupBy("column").agg(
        F.min(x).alias("lo"), F.max(x).alias("hi"), F.sum(F.when(finite, F.abs(x - whole_part))).alias("off"),
        F.count_if(~finite).alias("wild"),
    ) if names else None
    # one row per column
    stats = {r["column"]: r for r in found.collect()} if names else {}
    casts = []
    for c in df.columns:
        if c not in stats:
            casts.append(F.col(c))
            continue
        s = stats[c]
        whole = s["wild"] == 0 and s["off"] < 0.01  # infinities leave no usable sum
        casts.append(F.col(c).cast(_smallest(s["lo"], s["hi"]) if whole else "float").alias(c))
    return filled.select(*casts)


def _smallest(lo, hi):
    if lo >= 0:
        for limit, kind in ((2**8, "smallint"), (2**16, "int"), (2**32, "bigint")):
            if hi < limit:
                return kind
        return "decimal(20,0)"
    for bits, kind in ((7, "tinyint"), (15, "smallint"), (31, "int")):
        if lo >= -(2**bits) and hi < 2**bits:
            return kind
    return "bigint"


def top_rows(df: DataFrame, n=5) -> DataFrame:
    return df.limit(n)
