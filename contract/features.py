"""Queries on sources, labels, static and window features, splits and encoding."""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from buycast.operators.clean import clean_events, label_buyers, labelled, stack_splits, unlabelled, upto
from buycast.operators.encode import apply_codes, dense_ids, encode_each, fit_codes, last_pair, vocab_sizes
from buycast.operators.profile import narrow_types
from buycast.operators.static import REQUIRED, agg_features
from buycast.operators.windows import daily, pivot_daily, window_features
from buycast.plans.features import KEYS as KEYS_OF_FEATURES
from buycast.plans.features import build_splits, feature_columns, feature_set, single_cutoff_tables, slot_tables
from buycast.plans.increments import add_month, add_months
from buycast.plans.increments import features_from_months as from_months
from buycast.runtime import stored
from buycast.sources import (
    events_as_orders, read_codes, read_customers, read_families, read_features, read_order_detail, rejected_lines, write_bucketed,
    write_codes, write_csv, write_features,
)
from contract.common import (
    FLOOR, KEY, ORIGIN, SCORING, SPLITS, TEST, TRAIN, VALIDATION, WEEKLY, cuts_sql, lines, plain, query, r, scratch, with_od,
)
from contract.sql_features import (
    as_select, daily_cte, feature_sql_ctes, names, places, static_items, window_items,
)

DAILY_COLUMNS = ("customer_id", "order_pay_time", "order_total_payment", "order_total_num")

_OD_COLUMNS = ", ".join(
    ["order_detail_id"]
    + [f"{r(c)} AS {c}" for c in (
        "order_total_num", "order_amount", "order_total_payment", "order_total_discount", "order_detail_goods_num",
        "order_detail_amount", "order_detail_payment", "order_detail_discount", "goods_price")]
    + [f"CAST({c} AS BIGINT) AS {c}" for c in (
        "order_id", "order_status", "order_count", "is_customer_rate", "order_detail_status", "member_id",
        "customer_id", "customer_gender", "member_status", "is_member_actived", "goods_id", "goods_class_id",
        "goods_status", "goods_has_discount")]
    + ["customer_province", "customer_city"]
    + [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in ("order_pay_time", "goods_list_time", "goods_delist_time")]
)


@query(with_od(f"SELECT {_OD_COLUMNS} FROM od"))
def order_lines(spark, sf):
    return plain(lines(spark, sf).drop("line_key"))


@query(with_od(f"SELECT {_OD_COLUMNS} FROM od").replace("SELECT order_detail_id,", "SELECT", 1))
def order_lines_from_csv(spark, sf):
    """The same lines written as CSV and read back by the CSV reader (whose line id is a number)."""
    path = scratch(spark, "lines")
    # the text of all lines is several times as long as the tables
    write_csv(lines(spark, sf).drop("line_key", "order_detail_id"), path, compression="gzip")
    return plain(read_order_detail(spark, path, strict_times=True))


# Some values go wrong on their way into the file, told by the order's number.
_SPOILT = """
spoilt AS (SELECT order_id, goods_id,
  CASE WHEN order_id % 50 = 0 THEN 'x' ELSE '' END || customer_id AS customer_id,
  order_count || CASE WHEN order_id % 70 = 0 THEN '.7' WHEN order_id % 3 = 0 THEN '.0' ELSE '' END AS order_count,
  CASE WHEN order_id % 40 = 0 THEN 'no time' ELSE strftime(order_pay_time, '%Y-%m-%d %H:%M:%S') END AS order_pay_time
  FROM od)"""


def _spoilt_csv(spark, sf, numbers):
    at = lambda n: F.col("order_id") % n == 0
    rows = lines(spark, sf, "order_id", "goods_id", "customer_id", "order_count", "order_pay_time").select(
        "order_id", "goods_id",
        F.concat(F.when(at(50) & F.lit(numbers), "x").otherwise(""), F.col("customer_id").cast("string")).alias("customer_id"),
        F.concat(F.col("order_count").cast("string"),
                 F.when(at(70) & F.lit(numbers), ".7").when(at(3), ".0").otherwise("")).alias("order_count"),
        F.when(at(40), "no time").otherwise(F.date_format("order_pay_time", "yyyy-MM-dd HH:mm:ss")).alias("order_pay_time"))
    path = scratch(spark, "spoilt")
    write_csv(rows, path)
    return path


@query(with_od("SELECT order_id, goods_id, customer_id, order_count, concat_ws(',', "
               "CASE WHEN order_count LIKE '%.7' THEN 'order_count' END, CASE WHEN customer_id LIKE 'x%' THEN 'customer_id' END"
               ") AS bad_columns FROM spoilt WHERE customer_id LIKE 'x%' OR order_count LIKE '%.7'", _SPOILT))
def rejected_csv_lines(spark, sf):
    """Lines whose numbers do not parse are listed with the columns at fault."""
    bad = rejected_lines(spark, _spoilt_csv(spark, sf, True))
    return bad.select(F.col("order_id").cast("bigint").alias("order_id"), F.col("goods_id").cast("bigint").alias("goods_id"),
                      "customer_id", "order_count", "bad_columns")


@query(with_od("SELECT order_id, goods_id, CAST(customer_id AS BIGINT) AS customer_id, CAST(order_count AS BIGINT) AS order_count, "
               "CASE WHEN order_pay_time <> 'no time' THEN order_pay_time END AS order_pay_time "
               "FROM (SELECT * REPLACE (ltrim(customer_id, 'x') AS customer_id, split_part(order_count, '.', 1) AS order_count) "
               "FROM spoilt)", _SPOILT))
def csv_lines_with_lenient_times(spark, sf):
    """Unreadable times become null, whole numbers written as 3.0 are read as 3."""
    back = read_order_detail(spark, _spoilt_csv(spark, sf, False))
    return plain(back.select("order_id", "goods_id", "customer_id", "order_count", "order_pay_time"))


@query("SELECT c_custkey AS customer_id, CAST(0 AS BIGINT) AS result FROM customer")
def customers_from_csv(spark, sf):
    path = scratch(spark, "customers")
    listed = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("customer_id"))
    write_csv(listed.withColumn("result", F.lit(0)), path, index="customer_id")
    return plain(read_customers(spark, path))


@query("""SELECT event_id AS order_id, user_id AS customer_id, round(value + 1e-7, 4) AS order_total_payment,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS order_pay_time FROM events WHERE event_type = 'purchase'""")
def purchase_events(spark, sf):
    return plain(events_as_orders(spark, sf))


@query(with_od(f"SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT customer_id) AS BIGINT) AS customers "
               f"FROM od WHERE order_pay_time < DATE '{TRAIN}' + 1"))
def lines_up_to_cutoff(spark, sf):
    kept = upto(lines(spark, sf, "customer_id", "order_pay_time"), TRAIN)
    return plain(kept.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("customer_id").alias("customers")))


def _buyers(condition, source="od"):
    return f"SELECT DISTINCT customer_id FROM {source} WHERE {condition}"


@query(with_od(_buyers(f"order_pay_time >= DATE '{TRAIN}' + 1 AND order_pay_time < DATE '{TRAIN}' + 1 + INTERVAL 1 MONTH")))
def label_buyers_month(spark, sf):
    return label_buyers(lines(spark, sf, "customer_id", "order_pay_time"), TRAIN, "month")


@query(with_od(_buyers(f"order_pay_time >= DATE '{VALIDATION}' + 1")))
def label_buyers_open(spark, sf):
    return label_buyers(lines(spark, sf, "customer_id", "order_pay_time"), VALIDATION, "open")


@query(with_od(_buyers(f"day BETWEEN DATE '{TRAIN}' + 1 AND DATE '{TRAIN}' + 30 AND goods > 0", "daily"), daily_cte()))
def label_buyers_goods30(spark, sf):
    return label_buyers(lines(spark, sf, *DAILY_COLUMNS), TRAIN, "goods30")


@query(with_od("""SELECT CAST(order_id AS BIGINT) AS order_id, customer_id, goods_id, goods_class_id,
  strftime(order_pay_time, '%Y-%m') AS month FROM od"""))
def cleaned_lines(spark, sf):
    cols = ["order_id", "customer_id", "goods_id", "goods_class_id", "order_pay_time"]
    return plain(clean_events(lines(spark, sf, *cols)).drop("order_pay_time"))


@query(with_od("""SELECT CAST(order_id AS BIGINT) AS order_id, customer_id, goods_id, goods_class_id,
  strftime(order_pay_time, '%Y-%m') AS month FROM od
  WHERE order_id % 13 <> 0 AND order_id % 17 <> 0 AND order_id % 19 <> 0 AND order_id % 23 <> 0"""))
def cleaned_lines_with_gaps(spark, sf):
    """The same where one of the keys or the time is missing in some orders: those lines go."""
    rows = lines(spark, sf, "order_id", "customer_id", "goods_id", "goods_class_id", "order_pay_time")
    lost = {"customer_id": 13, "goods_id": 17, "goods_class_id": 19, "order_pay_time": 23}
    rows = rows.withColumns({c: F.when(F.col("order_id") % n != 0, F.col(c)) for c, n in lost.items()})
    return plain(clean_events(rows).drop("order_pay_time"))


@query(with_od(f"SELECT customer_id, strftime(day, '%Y-%m-%d') AS day, {r('payment')} AS payment, {r('goods')} AS goods "
               "FROM daily", daily_cte()))
def daily_sums(spark, sf):
    return plain(daily(lines(spark, sf, *DAILY_COLUMNS), FLOOR))


def _matrix_sql(value):
    """Every customer of the daily sums, every day from the floor to the last cut-off."""
    days = [d for d in _days(FLOOR, TEST)]
    cells = ", ".join(f"{r(f'''max(CASE WHEN c.day = DATE '{d}' THEN {value} ELSE 0 END)''')} AS \"{d}\"" for d in days)
    return with_od(f"SELECT p.customer_id, {cells} FROM (SELECT DISTINCT customer_id FROM daily) p "
                   "JOIN daily c ON c.customer_id = p.customer_id GROUP BY p.customer_id", daily_cte())


def _days(start, end):
    first, last = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    return [(first + dt.timedelta(days=i)).isoformat() for i in range((last - first).days + 1)]


@query(_matrix_sql("payment"))
def daily_matrix(spark, sf):
    return plain(pivot_daily(daily(lines(spark, sf, *DAILY_COLUMNS), FLOOR), FLOOR, TEST))


@query(_matrix_sql("goods"))
def daily_goods_matrix(spark, sf):
    return plain(pivot_daily(daily(lines(spark, sf, *DAILY_COLUMNS), FLOOR), FLOOR, TEST, value="goods"))


_STATIC_AT_TRAIN = (
    f"FROM od WHERE order_pay_time < DATE '{TRAIN}' + 1 GROUP BY customer_id")


@query(with_od(f"SELECT customer_id, {as_select(static_items() + places())} {_STATIC_AT_TRAIN}"))
def static_features(spark, sf):
    return plain(agg_features(upto(lines(spark, sf), TRAIN), KEY, ORIGIN))


@query(with_od(f"SELECT customer_id, {as_select(static_items(fill=False) + places(fill=False))} {_STATIC_AT_TRAIN}"))
def static_features_with_nulls(spark, sf):
    return plain(agg_features(upto(lines(spark, sf), TRAIN), KEY, ORIGIN, fill=None))


@query(with_od(f"""SELECT customer_id, {r("date_diff('day', CAST(max(order_pay_time) AS DATE), max(CAST(order_pay_time AS DATE)))")}
  AS days_since_last_order, {as_select(static_items(extras=True)[-2:])} {_STATIC_AT_TRAIN}"""))
def static_feature_extras(spark, sf):
    table = agg_features(upto(lines(spark, sf), TRAIN), KEY, ORIGIN, extras=True)
    return plain(table.select(
        "customer_id", "days_since_last_order", "order_total_discount_mean", "order_detail_goods_num_sum"))


@query("""WITH l AS (SELECT user_id AS customer_id, max(ts) AS t FROM events WHERE event_type = 'purchase' GROUP BY user_id)
SELECT customer_id, CAST(hour(t) AS BIGINT) AS h, CAST(minute(t) AS BIGINT) AS min, CAST(floor(second(t)) AS BIGINT) AS s,
  CAST(isodow(t) - 1 AS BIGINT) AS weekday, CAST(date_diff('day', DATE '2024-01-15', CAST(t AS DATE)) AS BIGINT) AS diff
FROM l""")
def clock_features(spark, sf):
    """Clock parts of each customer's last purchase event, with an origin that gives negative days too."""
    from buycast.functions.times import days_since, monday_first_weekday

    last = events_as_orders(spark, sf).groupBy("customer_id").agg(F.max("order_pay_time").alias("t"))
    return plain(last.select(
        "customer_id", F.hour("t").alias("h"), F.minute("t").alias("min"), F.second("t").alias("s"),
        monday_first_weekday(F.col("t")).alias("weekday"), days_since(F.col("t"), "2024-01-15").alias("diff"),
    ))


def _window_sql(cutoffs, variant, population, label):
    items = window_items(variant)
    seen = "HAVING count(*) FILTER (WHERE a >= 0) > 0" if population == "upto_cutoff" else ""
    bought = "coalesce(max(goods) FILTER (WHERE a BETWEEN -30 AND -1), 0) > 0"
    extra = f", CAST({bought} AS BIGINT) AS label" if label else ""
    return with_od(f"""SELECT split, strftime(d, '%Y-%m-%d') AS cutoff, customer_id, {as_select(items)}{extra}
      FROM (SELECT split, d, customer_id, date_diff('day', day, d) AS a, payment, goods FROM daily, cuts)
      GROUP BY split, d, customer_id {seen}""", cuts_sql(cutoffs), daily_cte())


@query(_window_sql(SPLITS, "uni", "upto_cutoff", False))
def window_features_rolling(spark, sf):
    return plain(window_features(daily(lines(spark, sf, *DAILY_COLUMNS), FLOOR), SPLITS))


@query(_window_sql(WEEKLY, "legacy", "all", True))
def window_features_weekly_slots(spark, sf):
    per_day = daily(lines(spark, sf, *DAILY_COLUMNS), FLOOR)
    return plain(window_features(per_day, WEEKLY, variant="legacy", population="all", label=True))


@query(_window_sql(SCORING, "legacy", "all", False))
def window_features_scoring_slot(spark, sf):
    per_day = daily(lines(spark, sf, *DAILY_COLUMNS), FLOOR)
    return plain(window_features(per_day, SCORING, variant="legacy", population="all"))


@query(_window_sql(SPLITS, "uni", "upto_cutoff", True))
def window_features_with_goods_label(spark, sf):
    per_day = daily(lines(spark, sf, *DAILY_COLUMNS), FLOOR)
    return plain(window_features(per_day, SPLITS, label=True))


def _features(spark, sf, method, **options):
    narrow = lines(spark, sf, *DAILY_COLUMNS)
    rows = lines(spark, sf) if method != "time" else narrow
    return feature_set(
        rows, SPLITS, method, ord_col=KEY, origin=ORIGIN, daily_rows=daily(narrow, FLOOR), **options)


@query(with_od("SELECT * FROM features", cuts_sql(SPLITS), *feature_sql_ctes("agg")))
def features_agg(spark, sf):
    return plain(_features(spark, sf, "agg"))


@query(with_od("SELECT * FROM features", cuts_sql(SPLITS), *feature_sql_ctes("time")))
def features_time(spark, sf):
    return plain(_features(spark, sf, "time"))


@query(with_od("SELECT * FROM features", cuts_sql(SPLITS), *feature_sql_ctes("both")))
def features_both(spark, sf):
    return plain(_features(spark, sf, "both"))


@query(with_od("SELECT * FROM features", cuts_sql(SPLITS), *feature_sql_ctes("both")))
def features_from_months(spark, sf):
    """All features from monthly states: the past in one pass, then the last months one by one."""
    # the states and the daily sums of every call read the lines
    root, rows = scratch(spark, "months"), stored(lines(spark, sf, *REQUIRED, "line_key"))
    add_months(rows, root, "1990-01", "2001-05", KEY)
    for month in ("2001-06", "2001-07", "2001-08"):
        add_month(rows, root, month, KEY)
    return plain(from_months(spark, root, SPLITS, ord_col=KEY, floor=FLOOR, origin=ORIGIN))


@query(with_od("SELECT * FROM features", cuts_sql(SPLITS), *feature_sql_ctes("both")))
def features_of_bucketed_families(spark, sf):
    """Both families, each kept in buckets of customers and joined in place."""
    names = []
    for method in ("agg", "time"):
        names.append(f"family_{method}_{uuid.uuid4().hex}")
        write_bucketed(_features(spark, sf, method), names[-1], scratch(spark, names[-1]), buckets=8)
    both = read_families(spark, *names)
    return plain(both.select(*KEYS_OF_FEATURES, *feature_columns("both"), "label"))


def _label_only(rule_sql):
    return with_od(f"""SELECT p.split, p.customer_id, CASE WHEN p.has_label THEN CAST(EXISTS (
      SELECT 1 FROM {rule_sql}) AS BIGINT) END AS label FROM people p""",
                   cuts_sql(SPLITS), daily_cte(), """people AS (
      SELECT DISTINCT split, d, has_label, customer_id FROM od JOIN cuts ON order_pay_time < d + 1)""")


@query(_label_only("od b WHERE b.customer_id = p.customer_id AND b.order_pay_time >= p.d + 1"))
def labels_open_rule(spark, sf):
    return plain(_features(spark, sf, "time", label_rule="open").select("split", "customer_id", "label"))


@query(_label_only("daily b WHERE b.customer_id = p.customer_id AND b.day BETWEEN p.d + 1 AND p.d + 30 AND b.goods > 0"))
def labels_goods30_rule(spark, sf):
    return plain(_features(spark, sf, "time", label_rule="goods30").select("split", "customer_id", "label"))


def _encoded(col):
    return f"""code_{col} AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (
      SELECT DISTINCT {col} AS v FROM features WHERE split = 'train'))"""


_ENCODED_BOTH = with_od(
    """SELECT * REPLACE (CAST(coalesce(cp.code, -1) AS BIGINT) AS customer_province,
        CAST(coalesce(cc.code, -1) AS BIGINT) AS customer_city)
      FROM features f LEFT JOIN code_customer_province cp ON cp.v = f.customer_province
      LEFT JOIN code_customer_city cc ON cc.v = f.customer_city""",
    cuts_sql(SPLITS), *feature_sql_ctes("both"), _encoded("customer_province"), _encoded("customer_city"),
).replace("SELECT * REPLACE", "SELECT f.* EXCLUDE (cutoff) REPLACE")


@query(_ENCODED_BOTH)
def encoded_splits(spark, sf):
    per_day = daily(lines(spark, sf, *DAILY_COLUMNS), FLOOR)
    splits = build_splits(lines(spark, sf), SPLITS, "both", ord_col=KEY, origin=ORIGIN, daily_rows=per_day)
    out = None
    for name, table in splits.items():
        table = table.withColumn("split", F.lit(name))
        out = table if out is None else stack_splits(out, table)
    return plain(out)


@query(with_od("SELECT CAST(label IS NULL AS BIGINT) AS is_test, CAST(count(*) AS BIGINT) AS n FROM features "
               "WHERE split <> 'validation' GROUP BY 1", cuts_sql(SPLITS), *feature_sql_ctes("time")))
def stacked_train_and_test(spark, sf):
    """Train and label-less test rows in one table, told apart by the label again."""
    table = _features(spark, sf, "time")
    train = table.filter(F.col("split") == "train")
    test = table.filter(F.col("split") == "test").drop("label")
    both = stack_splits(train, test)
    count = lambda df, flag: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(flag).alias("is_test"), "n")
    return plain(count(labelled(both), 0).unionByName(count(unlabelled(both), 1)))


@query(with_od(f"SELECT customer_id, {', '.join(names(window_items()))}, label FROM features WHERE split = 'train'",
               cuts_sql(SPLITS), *feature_sql_ctes("time")))
def stored_features(spark, sf):
    """One split written to the feature folder and read back."""
    root = scratch(spark, "features")
    splits = build_splits(lines(spark, sf, *DAILY_COLUMNS), SPLITS, "time", floor=FLOOR)
    for name, table in splits.items():
        write_features(table, root, "time", name)
    return plain(read_features(spark, root, "time", "train"))


@query(with_od("SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS BIGINT) AS idx FROM "
               "(SELECT DISTINCT customer_city AS value FROM od WHERE customer_city IS NOT NULL)"))
def city_codes(spark, sf):
    return plain(fit_codes(lines(spark, sf, "customer_city"), "customer_city"))


_CITY_CUT = "DATE '1995-01-10'"


@query(with_od(f"""SELECT order_detail_id, CAST(coalesce(idx, -1) AS BIGINT) AS customer_city FROM od LEFT JOIN (
  SELECT v, row_number() OVER (ORDER BY v) - 1 AS idx FROM (
    SELECT DISTINCT customer_city AS v FROM od WHERE order_pay_time < {_CITY_CUT} AND customer_city IS NOT NULL)) c
  ON c.v = customer_city"""))
def unseen_city_codes(spark, sf):
    """Codes learnt on the first days only, so that later lines hold cities without a code."""
    rows = lines(spark, sf, "order_detail_id", "customer_city", "order_pay_time")
    codes = fit_codes(upto(rows, "1995-01-09"), "customer_city")
    return plain(apply_codes(rows, codes, "customer_city").drop("order_pay_time"))


@query(with_od("""SELECT part, customer_id, CAST(dense_rank() OVER (PARTITION BY part ORDER BY city) - 1 AS BIGINT) AS city
  FROM (SELECT 'early' AS part, customer_id, coalesce(customer_city, '-999') AS city FROM od
        WHERE order_pay_time < DATE '1995-01-10'
        UNION ALL SELECT 'late', customer_id, coalesce(customer_city, '-999') FROM od
        WHERE order_pay_time >= DATE '2001-07-31')"""))
def city_codes_per_frame(spark, sf):
    """Codes learnt anew on each of two tables."""
    rows = lines(spark, sf, "customer_id", "customer_city", "order_pay_time").select(
        "customer_id", "order_pay_time", F.coalesce("customer_city", F.lit("-999")).alias("city"))
    early = rows.filter(F.col("order_pay_time") < "1995-01-10")
    late = rows.filter(F.col("order_pay_time") >= "2001-07-31")
    early, late = encode_each([early, late], "city")
    both = early.withColumn("part", F.lit("early")).unionByName(late.withColumn("part", F.lit("late")))
    return plain(both.select("part", "customer_id", "city"))


@query(with_od("SELECT value, CAST(row_number() OVER (ORDER BY value) AS BIGINT) AS idx FROM "
               "(SELECT DISTINCT goods_id AS value FROM od)"))
def goods_ids(spark, sf):
    return plain(dense_ids(lines(spark, sf, "goods_id"), "goods_id"))


@query(with_od("""SELECT 'customer' AS name, CAST(count(DISTINCT customer_id) + 1 AS BIGINT) AS size FROM od
  UNION ALL SELECT 'goods', CAST(count(DISTINCT goods_id) + 1 AS BIGINT) FROM od
  UNION ALL SELECT 'class', CAST(count(DISTINCT goods_class_id) + 1 AS BIGINT) FROM od"""))
def vocabulary_sizes(spark, sf):
    rows = lines(spark, sf, "customer_id", "goods_id", "goods_class_id")
    columns = {"customer": "customer_id", "goods": "goods_id", "class": "goods_class_id"}
    return plain(vocab_sizes(**{n: dense_ids(rows, c) for n, c in columns.items()}))


@query(with_od("SELECT goods_id, arg_max(goods_class_id, ord) AS goods_class_id FROM od GROUP BY goods_id"))
def goods_class_map(spark, sf):
    rows = lines(spark, sf, "goods_id", "goods_class_id", *KEY)
    return plain(last_pair(rows, "goods_id", "goods_class_id", KEY))


@query(with_od("SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS BIGINT) AS idx FROM "
               "(SELECT DISTINCT customer_province AS value FROM od WHERE customer_province IS NOT NULL)"))
def stored_province_codes(spark, sf):
    """A dictionary written and read back."""
    root = scratch(spark, "codes")
    write_codes(fit_codes(lines(spark, sf, "customer_province"), "customer_province"), root, "province")
    return plain(read_codes(spark, root, "province"))


def _frame_sql(condition, label):
    codes = [f"""code_{c} AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (
      SELECT DISTINCT {c} AS v FROM static))""" for c in ("customer_province", "customer_city")]
    buyers = f"later AS (SELECT DISTINCT customer_id FROM od WHERE order_pay_time >= DATE '{VALIDATION}' + 1)"
    return with_od(f"""SELECT s.* REPLACE (CAST(cp.code AS BIGINT) AS customer_province,
        CAST(cc.code AS BIGINT) AS customer_city){label}
      FROM static s JOIN code_customer_province cp ON cp.v = s.customer_province
      JOIN code_customer_city cc ON cc.v = s.customer_city LEFT JOIN later l ON l.customer_id = s.customer_id""",
                   f"static AS (SELECT customer_id, {as_select(static_items() + places())} FROM od WHERE {condition} "
                   "GROUP BY customer_id)", buyers, *codes)


@query(_frame_sql(f"order_pay_time < DATE '{VALIDATION}' + 1",
                  ", CAST(l.customer_id IS NOT NULL AS BIGINT) AS label"))
def single_cutoff_train(spark, sf):
    return plain(single_cutoff_tables(lines(spark, sf), VALIDATION, KEY, ORIGIN)[0])


@query(_frame_sql("true", ""))
def single_cutoff_test(spark, sf):
    return plain(single_cutoff_tables(lines(spark, sf), VALIDATION, KEY, ORIGIN)[1])


def _slot_types_sql():
    """Type, minimum and row count of each narrowed column of the stacked weekly slots."""
    names_ = names(window_items())
    parts = []
    for n in [*names_, "label"]:
        parts.append(f"""SELECT '{n}' AS "column", CASE
          WHEN sum(abs({n} - trunc({n}))) >= 0.01 THEN 'float'
          WHEN min({n}) >= 0 THEN CASE WHEN max({n}) <= 255 THEN 'smallint' WHEN max({n}) <= 65535 THEN 'int'
            WHEN max({n}) <= 4294967295 THEN 'bigint' ELSE 'decimal(20,0)' END
          WHEN min({n}) >= -128 AND max({n}) <= 127 THEN 'tinyint'
          WHEN min({n}) >= -32768 AND max({n}) <= 32767 THEN 'smallint'
          WHEN min({n}) >= -2147483648 AND max({n}) <= 2147483647 THEN 'int' ELSE 'bigint' END AS dtype,
          CAST(count(*) AS BIGINT) AS n FROM slots""")
    inner = _window_sql(WEEKLY, "legacy", "all", True)
    head, tail = inner.rsplit("\nSELECT", 1)
    return f"{head},\nslots AS (SELECT{tail})\n" + " UNION ALL ".join(parts)


@query(_slot_types_sql())
def narrowed_slot_columns(spark, sf):
    train, _ = slot_tables(daily(lines(spark, sf, *DAILY_COLUMNS), FLOOR), WEEKLY, SCORING[0])
    kept = [c for c in train.columns if c not in ("split", "cutoff", "customer_id")]
    types = dict(train.dtypes)
    counted = train.agg(F.count(F.lit(1)).alias("n"))
    return plain(counted.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"), F.col("n")) for c in kept]))))


_NARROWED = ["order_id", "order_total_num", "order_amount", "customer_gender", "goods_price", "member_id", "order_status"]


def _narrow_sql():
    parts = []
    for c in _NARROWED:
        x = f"coalesce(CAST({c} AS DOUBLE), -999)"
        parts.append(f"""SELECT '{c}' AS "column", CASE
          WHEN sum(abs({x} - trunc({x}))) >= 0.01 THEN 'float'
          WHEN min({x}) >= 0 THEN CASE WHEN max({x}) <= 255 THEN 'smallint' WHEN max({x}) <= 65535 THEN 'int'
            WHEN max({x}) <= 4294967295 THEN 'bigint' ELSE 'decimal(20,0)' END
          WHEN min({x}) >= -128 AND max({x}) <= 127 THEN 'tinyint'
          WHEN min({x}) >= -32768 AND max({x}) <= 32767 THEN 'smallint'
          WHEN min({x}) >= -2147483648 AND max({x}) <= 2147483647 THEN 'int' ELSE 'bigint' END AS dtype,
          {r(f'min({x})')} AS lo FROM od""")
    return with_od(" UNION ALL ".join(parts))


@query(_narrow_sql())
def narrowed_types(spark, sf):
    table = narrow_types(lines(spark, sf, *_NARROWED))
    types = dict(table.dtypes)
    low = table.agg(*[F.min(c).cast("double").alias(c) for c in _NARROWED])
    return plain(low.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"), F.col(c).alias("lo")) for c in _NARROWED
    ]))))
