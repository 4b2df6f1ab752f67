"""Parameters and helpers shared by the registered queries and their SQL."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from buycast.operators.cutoffs import cutoff, rolling_splits, slots
from buycast.runtime import checkpoint_dir
from buycast.sources.star import ORDER_KEY, order_detail

TRAIN, VALIDATION, TEST = "2001-05-31", "2001-06-30", "2001-07-31"
FLOOR = "2001-01-01"
ORIGIN = "1994-10-11"
SLOT_START, SCORING_SLOT = "2001-06-01", "2001-08-01"
TRAIN_MONTH, TEST_MONTH, PREDICT_MONTH = "2001-05", "2001-06", "2001-07"
TOP_N = 301
DIGITS = 4

SPLITS = rolling_splits(TRAIN, VALIDATION, TEST)
WEEKLY = slots(SLOT_START, 4)
SCORING = [cutoff("scoring", "2001-07-31", False)]
KEY = list(ORDER_KEY)

QUERIES = {}
ORACLES = {}


def query(sql=None):
    """Register a function under its name, with its SQL if there is one."""
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return add


def rounded(col):
    """Four decimals. The small shift keeps exact halves from falling differently in the two engines."""
    return F.round(col + F.lit(1e-7), DIGITS)


def r(sql):
    return f"round(CAST({sql} AS DOUBLE) + 1e-7, {DIGITS})"


def plain(df, exact=()):
    """Columns in types both engines print alike: bigint, rounded double, text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = c.cast("double") if f.name in exact else rounded(c.cast("double"))
        elif isinstance(f.dataType, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ",")
        out.append(c.alias(f.name))
    return df.select(*out)


def lines(spark, sf, *columns):
    """Order lines with only the named columns, or all of them."""
    return order_detail(spark, sf, list(columns) if columns else None)


def scratch(spark, name):
    """A fresh folder below the checkpoint folder, which every executor can reach."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


# --- SQL for the order-line table and the things most checks build on

OD = """
od AS (
  SELECT *, row_number() OVER (ORDER BY order_pay_time, k1, k2, k3, k4, k5, k6) AS ord FROM (
    SELECT
      l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' ||
        CAST(l_extendedprice AS DECIMAL(18,2)) || '-' || CAST(l_quantity AS DECIMAL(18,2)) AS order_detail_id,
      l_orderkey AS order_id,
      s.num AS order_total_num, s.amount AS order_amount, s.disc AS order_total_discount, s.n AS order_count,
      CAST(o_totalprice AS DECIMAL(18,2)) AS order_total_payment,
      o_orderdate AS order_pay_time,
      CASE o_orderstatus WHEN 'F' THEN 6 WHEN 'O' THEN 3 WHEN 'P' THEN 1 END AS order_status,
      CASE WHEN o_orderpriority[1] IN ('1', '2') THEN 1 ELSE 0 END AS is_customer_rate,
      CASE l_linestatus WHEN 'F' THEN 6 WHEN 'O' THEN 3 END AS order_detail_status,
      l_quantity AS order_detail_goods_num,
      CAST(l_extendedprice AS DECIMAL(18,2)) AS order_detail_amount,
      CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS order_detail_discount,
      CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS order_detail_payment,
      CASE WHEN c_custkey % 97 <> 0 THEN r_name END AS customer_province,
      CASE WHEN c_custkey % 97 <> 0 THEN n_name END AS customer_city,
      o_custkey AS customer_id,
      CASE WHEN c_custkey % 4 = 0 THEN c_custkey END AS member_id,
      CASE WHEN c_custkey % 4 = 0 THEN 1 END AS member_status,
      CASE WHEN c_custkey % 4 = 0 THEN 1 END AS is_member_actived,
      CASE WHEN c_custkey % 4 = 0 THEN c_custkey % 3 END AS customer_gender,
      l_partkey AS goods_id,
      CAST(split_part(p_brand, '#', 2) AS BIGINT) AS goods_class_id,
      CASE WHEN p_partkey % 499 <> 0 THEN CAST(p_retailprice AS DECIMAL(18,2)) END AS goods_price,
      p_size % 3 AS goods_status,
      CASE WHEN l_discount >= 0.09 THEN 1 ELSE 0 END AS goods_has_discount,
      DATE '1994-01-01' + CAST(p_partkey % 365 AS INTEGER) AS goods_list_time,
      DATE '1994-01-01' + CAST(p_partkey % 365 AS INTEGER) + 30 * p_size AS goods_delist_time,
      l_orderkey AS k1, l_linenumber AS k2, l_partkey AS k3, l_suppkey AS k4,
      CAST(l_extendedprice AS DECIMAL(18,2)) AS k5, l_quantity AS k6
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    JOIN part ON l_partkey = p_partkey
    JOIN (
      SELECT l_orderkey AS k, sum(l_quantity) AS num, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS amount,
        sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))) AS disc, count(*) AS n
      FROM lineitem GROUP BY l_orderkey) s ON s.k = l_orderkey)
)"""


def with_od(body, *ctes):
    return "WITH " + ",\n".join([OD.strip(), *[c.strip() for c in ctes]]) + "\n" + body.strip()


def recursive(body, *ctes):
    """``with_od`` for CTEs that may refer to themselves."""
    return with_od(body, *ctes).replace("WITH ", "WITH RECURSIVE ", 1)


def cuts_sql(cutoffs, name="cuts"):
    rows = ", ".join(
        f"({i}, '{c.split}', DATE '{c.day}', {'true' if c.has_label else 'false'})" for i, c in enumerate(cutoffs))
    return f"{name} AS (SELECT * FROM (VALUES {rows}) t(no, split, d, has_label))"
