"""Queries that profile the order lines."""

from pyspark.sql import functions as F

from buycast.operators import profile as P
from buycast.operators.windows import calendar
from buycast.sources import events_as_orders, read_logs
from contract.common import lines, plain, query, r, scratch, with_od

NUMERIC = [
    "order_id", "order_total_num", "order_amount", "order_total_payment", "order_total_discount", "order_status", "order_count",
    "is_customer_rate", "order_detail_status", "order_detail_goods_num", "order_detail_amount", "order_detail_payment",
    "order_detail_discount", "member_id", "customer_id", "customer_gender", "member_status", "is_member_actived", "goods_id",
    "goods_class_id", "goods_price", "goods_status", "goods_has_discount"]
ALL = [
    "order_detail_id", "order_id", "order_total_num", "order_amount", "order_total_payment", "order_total_discount",
    "order_pay_time", "order_status", "order_count", "is_customer_rate", "order_detail_status",
    "order_detail_goods_num", "order_detail_amount", "order_detail_payment", "order_detail_discount",
    "customer_province", "customer_city", "member_id", "customer_id", "customer_gender", "member_status",
    "is_member_actived", "goods_id", "goods_class_id", "goods_price", "goods_status", "goods_has_discount",
    "goods_list_time", "goods_delist_time",
]


def _each(columns, template, tail=""):
    return with_od(" UNION ALL ".join(template.format(c=c) for c in columns) + tail)


# The types of the order-line columns.
_TYPES = {
    "string": "order_detail_id customer_province customer_city",
    "bigint": "order_id member_id customer_id goods_id goods_class_id",
    "int": "order_status order_count is_customer_rate order_detail_status customer_gender member_status is_member_actived goods_status goods_has_discount",
    "double": "order_total_num order_detail_goods_num",
    "decimal(18,2)": "order_amount order_total_payment order_detail_amount goods_price",
    "decimal(18,4)": "order_total_discount order_detail_payment order_detail_discount",
    "timestamp_ntz": "order_pay_time",
    "timestamp": "goods_list_time goods_delist_time",
}
_TYPE_OF = {c: kind for kind, columns in _TYPES.items() for c in columns.split()}


@query(with_od(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{_TYPE_OF[c]}' AS dtype, CAST(count({c}) AS BIGINT) AS non_null,
  CAST(count(*) AS BIGINT) AS n_rows, CAST(29 AS BIGINT) AS n_columns FROM od""" for c in ALL)))
def shape_and_counts(spark, sf):
    return plain(P.profile_schema(lines(spark, sf, *ALL)))


@query("SELECT * FROM (" .join(["", _each(ALL, f"""SELECT '{{c}}' AS "column",
  CAST(count(*) - count({{c}}) AS BIGINT) AS missing,
  {r('100.0 * (count(*) - count({c})) / count(*)')} AS percent FROM od""") + ") WHERE missing > 0"]))
def missing_values(spark, sf):
    return plain(P.profile_missing(lines(spark, sf, *ALL)))


@query(_each(ALL, """SELECT '{c}' AS "column", CAST(count(DISTINCT {c}) AS BIGINT) AS n_unique FROM od"""))
def unique_values(spark, sf):
    return plain(P.unique_counts(lines(spark, sf, *ALL)))


def _describe(c, source, name=None):
    x = f"CAST({c} AS DOUBLE)"
    return f"""SELECT '{name or c}' AS "column", CAST(count({c}) AS BIGINT) AS count, {r(f'avg({x})')} AS mean,
      {r(f'stddev_samp({x})')} AS std, {r(f'min({x})')} AS min, {r(f'quantile_cont({x}, 0.25)')} AS q25,
      {r(f'quantile_cont({x}, 0.5)')} AS q50, {r(f'quantile_cont({x}, 0.75)')} AS q75, {r(f'max({x})')} AS max FROM {source}"""


@query(with_od(" UNION ALL ".join(_describe(c, "od") for c in NUMERIC)))
def describe_columns(spark, sf):
    return plain(P.describe_numeric(lines(spark, sf, *NUMERIC)))


_PER_CUSTOMER = "per_customer AS (SELECT customer_id, count(DISTINCT order_id) AS n_orders FROM od GROUP BY 1)"
_SPEND = "spend AS (SELECT customer_id, CAST(sum(order_total_payment) AS DOUBLE) AS spend FROM od GROUP BY 1)"


@query(with_od(_describe("n_orders", "per_customer"), _PER_CUSTOMER))
def describe_order_counts(spark, sf):
    counts = P.orders_per_customer(lines(spark, sf, "customer_id", "order_id"))
    return plain(P.describe_numeric(counts, ["n_orders"]))


def _share(c, limit=""):
    return with_od(f"""SELECT CAST({c} AS VARCHAR) AS value, CAST(count(*) AS BIGINT) AS n,
      {r('100.0 * count(*) / (SELECT count(' + c + ') FROM od)')} AS percent
      FROM od WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY n DESC, {c} {limit}""")


@query(_share("customer_province", "LIMIT 15"))
def top_provinces(spark, sf):
    return plain(P.value_share(lines(spark, sf, "customer_province"), "customer_province", top=15))


@query(_share("customer_city", "LIMIT 15"))
def top_cities(spark, sf):
    return plain(P.value_share(lines(spark, sf, "customer_city"), "customer_city", top=15))


@query(_share("order_status"))
def order_status_share(spark, sf):
    table = P.value_share(lines(spark, sf, "order_status"), "order_status")
    return plain(table.withColumn("value", F.col("value").cast("string")))


@query(with_od("SELECT customer_id, CAST(n_orders AS BIGINT) AS n_orders FROM per_customer", _PER_CUSTOMER))
def orders_per_customer(spark, sf):
    return plain(P.orders_per_customer(lines(spark, sf, "customer_id", "order_id")))


@query(with_od(f"SELECT customer_id, {r('spend')} AS spend FROM spend", _SPEND))
def spend_per_customer(spark, sf):
    return plain(P.spend_per_customer(lines(spark, sf, "customer_id", "order_total_payment")))


def _months(source, time, value):
    return f"""SELECT strftime(last_day(m), '%Y-%m-%d') AS month_end, {r(f'coalesce(sum({value}), 0)')} AS payment
      FROM (SELECT unnest(generate_series(date_trunc('month', min({time})), date_trunc('month', max({time})),
        INTERVAL 1 MONTH)) AS m FROM {source}) LEFT JOIN {source} ON date_trunc('month', {time}) = m GROUP BY m"""


@query(with_od(_months("od", "order_pay_time", "order_total_payment")))
def monthly_sales(spark, sf):
    return plain(P.monthly_sales(lines(spark, sf, "order_pay_time", "order_total_payment")))


@query(with_od(_months("part_year", "order_pay_time", "order_total_payment"),
               "part_year AS (SELECT * FROM od WHERE month(order_pay_time) IN (1, 4, 5))"))
def monthly_sales_with_gaps(spark, sf):
    """Only January, April and May sell, so the months between must show as 0."""
    rows = lines(spark, sf, "order_pay_time", "order_total_payment")
    return plain(P.monthly_sales(rows.filter(F.month("order_pay_time").isin(1, 4, 5))))


@query("""SELECT CAST(hour(ts) AS BIGINT) AS hour, CAST(count(*) AS BIGINT) AS n FROM events
  WHERE event_type = 'purchase' GROUP BY 1""")
def hourly_purchases(spark, sf):
    return plain(P.hourly_counts(events_as_orders(spark, sf)))


_Q95 = ["order_total_payment", "goods_price"]


@query(with_od(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {r(f'quantile_cont(CAST({c} AS DOUBLE), 0.95)')} AS p0 FROM od""" for c in _Q95)
    + f""" UNION ALL SELECT 'spend', {r('quantile_cont(spend, 0.95)')} FROM spend""", _SPEND))
def upper_quantiles(spark, sf):
    rows = lines(spark, sf, "customer_id", *_Q95)
    spend = P.exact_quantiles(P.spend_per_customer(rows), ["spend"], [0.95])
    return plain(P.exact_quantiles(rows, _Q95, [0.95]).unionByName(spend))


def _histogram(c, source, bins=50):
    x = f"CAST({c} AS DOUBLE)"
    return f"""SELECT CAST(b.bin AS BIGINT) AS bin, {r(f'lo + (hi - lo) * b.bin / {bins}')} AS left_edge,
      {r(f'lo + (hi - lo) * (b.bin + 1) / {bins}')} AS right_edge, CAST(coalesce(n, 0) AS BIGINT) AS n
      FROM (SELECT unnest(range({bins})) AS bin) b,
        (SELECT min({x}) AS lo, max({x}) AS hi FROM {source})
      LEFT JOIN (SELECT least(floor(({x} - lo) / (hi - lo) * {bins}), {bins - 1}) AS bin, count(*) AS n
        FROM {source}, (SELECT min({x}) AS lo, max({x}) AS hi FROM {source}) WHERE {c} IS NOT NULL GROUP BY 1) h
      ON h.bin = b.bin"""


@query(with_od(_histogram("order_total_payment", "od")))
def histogram_payment(spark, sf):
    return plain(P.histogram(lines(spark, sf, "order_total_payment"), "order_total_payment"))


@query(with_od(_histogram("goods_price", "od")))
def histogram_price(spark, sf):
    return plain(P.histogram(lines(spark, sf, "goods_price"), "goods_price"))


@query(with_od(_histogram("n_orders", "per_customer"), _PER_CUSTOMER))
def histogram_order_counts(spark, sf):
    return plain(P.histogram(P.orders_per_customer(lines(spark, sf, "customer_id", "order_id")), "n_orders"))


@query(with_od(_histogram("spend", "spend"), _SPEND))
def histogram_spend(spark, sf):
    return plain(P.histogram(P.spend_per_customer(lines(spark, sf, "customer_id", "order_total_payment")), "spend"))


def _density(c, source, points=200):
    x = f"CAST({c} AS DOUBLE)"
    return f"""SELECT CAST(point AS BIGINT) AS point, {r('gx')} AS x,
      {r('sum(w * exp(-0.5 * ((gx - v) / h) * ((gx - v) / h))) / (max(n) * max(h) * sqrt(2 * pi())) * 1e6')} AS density
      FROM (SELECT {x} AS v, count(*) AS w FROM {source} WHERE {c} IS NOT NULL GROUP BY 1),
        (SELECT n, h, point, lo + (hi - lo) * point / {points - 1} AS gx FROM (
          SELECT count({x}) AS n, min({x}) AS lo, max({x}) AS hi, stddev_samp({x}) * pow(count({x}), -0.2) AS h FROM {source}),
          (SELECT unnest(range({points})) AS point))
      GROUP BY point, gx"""


def _per_million(table):
    return plain(table.withColumn("density", F.col("density") * 1e6))


@query(with_od(_density("goods_price", "od")))
def density_price(spark, sf):
    return _per_million(P.density(lines(spark, sf, "goods_price"), "goods_price"))


@query(with_od(_density("order_total_payment", "od")))
def density_payment(spark, sf):
    return _per_million(P.density(lines(spark, sf, "order_total_payment"), "order_total_payment"))


@query(with_od(_density("spend", "spend"), _SPEND))
def density_spend(spark, sf):
    return _per_million(P.density(P.spend_per_customer(lines(spark, sf, "customer_id", "order_total_payment")), "spend"))


@query(with_od(" UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {r(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))')} AS corr FROM od"
    for a in P.CORRELATED for b in P.CORRELATED)))
def correlation_matrix(spark, sf):
    return plain(P.correlations(lines(spark, sf, *P.CORRELATED)))


@query(with_od("""SELECT strftime(d, '%Y-%m-%d') AS day, CAST(count(order_id) AS BIGINT) AS n
  FROM (SELECT unnest(generate_series(DATE '2001-07-01', DATE '2001-08-05', INTERVAL 1 DAY)) AS d)
  LEFT JOIN od ON CAST(order_pay_time AS DATE) = d GROUP BY d"""))
def lines_per_calendar_day(spark, sf):
    """Day range with the days that sold nothing."""
    rows = lines(spark, sf, "order_id", "order_pay_time").select("order_id", F.to_date("order_pay_time").alias("day"))
    per_day = rows.groupBy("day").agg(F.count("order_id").alias("n"))
    days = calendar(spark, "2001-07-01", "2001-08-05")
    return plain(days.join(per_day, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n")))


_MONTHLY_SCORES = """SELECT o_orderstatus AS status, strftime(o_orderdate, '%Y-%m') AS month,
  avg(CAST(o_totalprice AS DOUBLE)) / 1000000 AS score FROM orders GROUP BY 1, 2"""


@query(f"""SELECT kind || '/' || status AS run, CAST(row_number() OVER (PARTITION BY kind, status ORDER BY month) AS BIGINT) AS iteration,
  'auc' AS metric, round(score + 1e-9, 4) AS value FROM ({_MONTHLY_SCORES}), (SELECT unnest(['xgb', 'reg']) AS kind)""")
def training_log_values(spark, sf):
    """Monthly scores printed as two trainers print them, among other lines, and read back: a run per file, files of one
    name in several folders."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    scores = orders.groupBy(F.col("o_orderstatus").alias("status"), F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        F.round(F.avg(F.col("o_totalprice").cast("double")) / 1_000_000 + 1e-9, 4).alias("score"))
    shown = F.format_string("%.4f", "score")
    printed = {
        "xgb": [F.concat(F.lit("[0]\tvalidation_0-auc:"), shown), F.lit("saved")],
        "reg": [F.concat(F.lit("Iteration of "), "month"), F.concat(F.lit("  eval metric auc = "), shown)],
    }
    out = None
    for kind, texts in printed.items():
        path = scratch(spark, f"logs-{kind}")
        rows = scores.select("status", "month", F.posexplode(F.array(*texts)).alias("place", "value"))
        # a row per status and month: one file per status
        rows.coalesce(1).sortWithinPartitions("status", "month", "place").select("status", "value").write.partitionBy("status").text(path)
        read = read_logs(spark, path, kind)
        one = read.withColumn("run", F.concat(F.lit(f"{kind}/"), F.regexp_extract("run", "status=([A-Z])/", 1)))
        out = one if out is None else out.unionByName(one)
    return out.select("run", F.col("iteration").cast("bigint").alias("iteration"), "metric", F.col("value"))
