"""The order-line table seen through a star of lineitem, orders, customer, nation, region and part."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
PRODUCT = "decimal(18,4)"

# Which output columns each joined table brings.
_FROM_ORDER_SUMS = {"order_total_num", "order_amount", "order_total_discount", "order_count"}
_FROM_PLACE = {"customer_province", "customer_city"}
_FROM_PART = {
    "goods_class_id", "goods_price", "goods_status", "goods_list_time", "goods_delist_time",
}

ORDER_KEY = ("order_pay_time", "line_key")


def _money(name):
    return F.col(name).cast(MONEY)


def _discount():
    return (_money("l_extendedprice") * F.col("l_discount").cast("decimal(4,2)")).cast(PRODUCT)


def order_detail(spark: SparkSession, root: str, columns=None) -> DataFrame:
    """Order lines with the columns of the order-detail table, plus ``line_key``, which orders the
    lines within one pay time.

    ``columns`` limits the result, and with it the tables that are joined: each line has exactly one
    order, customer, nation, region and part, so a table whose columns are not asked for is left out.
    Customers join the orders before the lines do, because there are fewer orders. Nation and region
    are broadcast by Spark's own size check on the files; the other joins shuffle on their key, with
    skewed partitions split at run time.
    """
    def table(name):
        return spark.read.parquet(f"{root}/{name}.parquet")

    wanted = None if columns is None else set(columns)

    def need(group):
        return wanted is None or bool(wanted & group)

    orders = table("orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("customer_id"),
        _money("o_totalprice").alias("order_total_payment"),
        F.col("o_orderdate").alias("order_pay_time"),
        F.expr("case o_orderstatus when 'F' then 6 when 'O' then 3 when 'P' then 1 end").alias("order_status"),
        F.substring("o_orderpriority", 1, 1).isin("1", "2").cast("int").alias("is_customer_rate"),
    )
    if need(_FROM_PLACE):
        places = (
            table("nation").join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
        )
        customers = (
            table("customer").join(places, "c_nationkey")
            .select(F.col("c_custkey").alias("customer_id"), "n_name", "r_name")
        )
        orders = orders.join(customers, "customer_id")
        known = F.col("customer_id") % 97 != 0
        orders = orders.select(
            "*",
            F.when(known, F.col("r_name")).alias("customer_province"),
            F.when(known, F.col("n_name")).alias("customer_city"),
        ).drop("n_name", "r_name")

    lines = table("lineitem")
    if need(_FROM_ORDER_SUMS):
        sums = lines.groupBy("l_orderkey").agg(
            F.sum("l_quantity").alias("order_total_num"),
            F.sum(_money("l_extendedprice")).cast(MONEY).alias("order_amount"),
            F.sum(_discount()).cast(PRODUCT).alias("order_total_discount"),
            F.count(F.lit(1)).cast("int").alias("order_count"),
        )
        orders = orders.join(sums, "l_orderkey")

    parts, ahead = None, lines
    if need(_FROM_PART):
        parts = table("part").select(
            F.col("p_partkey").alias("l_partkey"),
            F.substring_index("p_brand", "#", -1).cast("long").alias("goods_class_id"),
            F.when(F.col("p_partkey") % 499 != 0, _money("p_retailprice")).alias("goods_price"),
            (F.col("p_size") % 3).cast("int").alias("goods_status"),
            F.date_add(F.lit("1994-01-01").cast("date"), (F.col("l_partkey") % 365).cast("int")).alias("_listed"),
            F.col("p_size"),
        ).withColumns({
            "goods_list_time": F.col("_listed").cast("timestamp"),
            "goods_delist_time": F.date_add("_listed", F.col("p_size") * 30).cast("timestamp"),
        }).drop("_listed", "p_size")
    if parts is not None:
        # Parts meet the lines while these are narrow. The orders' columns are then shuffled once per order, and the lines of an
        # order lie together for what follows, so that it can be reduced in place.
        ahead = lines.join(parts, "l_partkey")
    # What follows from a line alone is worked out before the orders are joined: its generated code is then short enough to be compiled,
    # and the columns it is made from need not be shuffled.
    # Cents are rounded as by F.round (but for negative halves), which goes through decimal text for every value.
    cents = lambda name: F.floor(F.col(name) * 100 + 0.5).cast("long")
    ahead = ahead.withColumns({
        "l_cents": cents("l_extendedprice"),
        "l_hundredths": cents("l_quantity"),
        "order_detail_status": F.expr("case l_linestatus when 'F' then 6 when 'O' then 3 end"),
        "order_detail_amount": _money("l_extendedprice"),
        "order_detail_discount": _discount(),
        "order_detail_payment": (_money("l_extendedprice") - _discount()).cast(PRODUCT),
        "goods_has_discount": (F.col("l_discount") >= 0.09).cast("int"),
    })
    rows = ahead.join(orders, "l_orderkey")
    from_parts = [] if parts is None else [c for c in parts.columns if c != "l_partkey"]
    rows = rows.select(*[c for c in ahead.columns if c not in from_parts], *[c for c in orders.columns if c != "l_orderkey"], *from_parts)

    member = F.col("customer_id") % 4 == 0
    rows = rows.withColumns({
        "order_id": F.col("l_orderkey"),
        "line_key": F.struct(
            F.col("l_orderkey").alias("k1"), F.col("l_linenumber").alias("k2"),
            F.col("l_partkey").alias("k3"), F.col("l_suppkey").alias("k4"),
            F.col("l_cents").alias("k5"), F.col("l_hundredths").alias("k6"),
        ),
        "order_detail_id": F.concat_ws(
            "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            _money("l_extendedprice"), _money("l_quantity"),
        ),
        "order_detail_goods_num": F.col("l_quantity"),
        "member_id": F.when(member, F.col("customer_id")),
        "member_status": F.when(member, F.lit(1)),
        "is_member_actived": F.when(member, F.lit(1)),
        "customer_gender": F.when(member, (F.col("customer_id") % 3).cast("int")),
        "goods_id": F.col("l_partkey"),
    })
    if columns is not None:
        return rows.select(*columns)
    return rows.drop(*[c for c in rows.columns if c.startswith("l_")])


def events_as_orders(spark: SparkSession, root: str) -> DataFrame:
    """Purchase events as order lines. They carry real clock times, which the orders do not."""
    return (
        spark.read.parquet(f"{root}/events.parquet")
        .filter(F.col("event_type") == "purchase")
        .select(
            F.col("event_id").alias("order_id"),
            F.col("user_id").alias("customer_id"),
            F.col("ts").alias("order_pay_time"),
            F.col("value").cast(MONEY).alias("order_total_payment"),
        )
    )
