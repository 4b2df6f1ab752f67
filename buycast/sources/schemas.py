"""Column types of the inputs.

Money is decimal: sums are then exact and do not depend on how the rows are partitioned.
"""

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)

# The 29 columns of the order-detail table, in file order.
ORDER_DETAIL = T.StructType([
    T.StructField("order_detail_id", T.LongType()),
    T.StructField("order_id", T.LongType()),
    T.StructField("order_total_num", T.DoubleType()),
    T.StructField("order_amount", MONEY),
    T.StructField("order_total_payment", MONEY),
    T.StructField("order_total_discount", MONEY),
    T.StructField("order_pay_time", T.StringType()),
    T.StructField("order_status", T.IntegerType()),
    T.StructField("order_count", T.IntegerType()),
    T.StructField("is_customer_rate", T.IntegerType()),
    T.StructField("order_detail_status", T.IntegerType()),
    T.StructField("order_detail_goods_num", T.DoubleType()),
    T.StructField("order_detail_amount", MONEY),
    T.StructField("order_detail_payment", MONEY),
    T.StructField("order_detail_discount", MONEY),
    T.StructField("customer_province", T.StringType()),
    T.StructField("customer_city", T.StringType()),
    T.StructField("member_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("customer_gender", T.IntegerType()),
    T.StructField("member_status", T.IntegerType()),
    T.StructField("is_member_actived", T.IntegerType()),
    T.StructField("goods_id", T.LongType()),
    T.StructField("goods_class_id", T.LongType()),
    T.StructField("goods_price", MONEY),
    T.StructField("goods_status", T.IntegerType()),
    T.StructField("goods_has_discount", T.IntegerType()),
    T.StructField("goods_list_time", T.StringType()),
    T.StructField("goods_delist_time", T.StringType()),
])

TIME_COLUMNS = ["order_pay_time", "goods_list_time", "goods_delist_time"]

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("result", T.IntegerType()),
])
