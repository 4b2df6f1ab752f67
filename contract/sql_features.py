"""SQL for static and window features, written out column by column."""

from contract.common import FLOOR, ORIGIN, r

MEANS = [
    "is_customer_rate", "member_status", "order_detail_discount", "goods_status", "is_member_actived",
    "order_status", "goods_has_discount", "order_total_num",
]


def _last(c):
    return f"arg_max({c}, ord) FILTER (WHERE {c} IS NOT NULL)"


def static_items(extras=False, fill=True):
    """(name, aggregate SQL over od rows) of the static features."""
    items = [("customer_gender", f"coalesce({_last('customer_gender')}, 0)")]
    items += [(f"goods_{c}_last", _last(f"goods_{c}")) for c in ("id", "status", "price", "has_discount")]
    for c in ("order_total_num", "order_amount", "order_total_payment", "order_total_discount", "order_status",
              "order_count", "is_customer_rate", "order_detail_status", "order_detail_goods_num",
              "order_detail_amount", "order_detail_payment", "order_detail_discount", "member_id",
              "member_status", "is_member_actived"):
        items.append((f"{c}_last", _last(c)))
    for c in ("goods_price", "order_total_payment"):
        items += [(f"{c}_min", f"min({c})"), (f"{c}_max", f"max({c})"),
                  (f"{c}_mean", f"avg(CAST({c} AS DOUBLE))"), (f"{c}_std", f"stddev_samp(CAST({c} AS DOUBLE))")]
    items += [("order_count", "count(order_id)"), ("goods_count", "count(goods_id)")]
    for c in MEANS:
        items += [(f"{c}_mean", f"avg(CAST({c} AS DOUBLE))"), (f"{c}_sum", f"coalesce(sum({c}), 0)")]
    items += [("order_total_payment_sum", "coalesce(sum(order_total_payment), 0)"),
              ("order_detail_count", "count(*)")]
    amount, payment = _last("order_detail_amount"), _last("order_detail_payment")
    items.append(("discount", f"CAST({amount} AS DOUBLE) / nullif(CAST({payment} AS DOUBLE), 0)"))
    t = _last("order_pay_time")
    items += [
        ("order_pay_time_last_m", f"month({t})"), ("order_pay_time_last_d", f"day({t})"),
        ("order_pay_time_last_h", f"hour({t})"), ("order_pay_time_last_min", f"minute({t})"),
        ("order_pay_time_last_s", f"second({t})"), ("order_pay_time_last_weekday", f"isodow({t}) - 1"),
        ("order_pay_time_last_diff", f"date_diff('day', DATE '{ORIGIN}', CAST({t} AS DATE))"),
    ]
    listed = f"date_diff('day', DATE '{ORIGIN}', {_last('goods_list_time')})"
    gone = f"date_diff('day', DATE '{ORIGIN}', {_last('goods_delist_time')})"
    items += [("goods_list_time_diff", listed), ("goods_delist_time_diff", gone),
              ("goods_time_diff", f"{gone} - {listed}")]
    if extras:
        items += [("order_total_discount_mean", "avg(CAST(order_total_discount AS DOUBLE))"),
                  ("order_detail_goods_num_sum", "coalesce(sum(order_detail_goods_num), 0)")]
    missing = lambda e: f"coalesce(CAST({e} AS DOUBLE), -999)" if fill else f"CAST({e} AS DOUBLE)"
    return [(n, r(missing(e))) for n, e in items]


def places(fill=True):
    out = []
    for c in ("customer_province", "customer_city"):
        e = _last(c)
        out.append((c, f"coalesce({e}, '-999')" if fill else e))
    return out


def as_select(items):
    return ",\n  ".join(f"{e} AS {n}" for n, e in items)


def names(items):
    return [n for n, _ in items]


def daily_cte(floor=FLOOR):
    return f"""daily AS (
  SELECT customer_id, CAST(order_pay_time AS DATE) AS day, CAST(sum(order_total_payment) AS DOUBLE) AS payment,
    CAST(sum(order_total_num) AS DOUBLE) AS goods
  FROM od WHERE order_pay_time >= DATE '{floor}' GROUP BY ALL)"""


def window_items(variant="uni"):
    """(name, aggregate SQL over rows with age a, payment, goods) of the 65 window features."""
    step = 1 if variant == "legacy" else 0

    def inside(length, shift=0):
        return f"a >= {shift} AND a < {shift + length}"

    def total(x, length, shift=0):
        return f"coalesce(sum({x}) FILTER (WHERE {inside(length, shift)}), 0)"

    def decayed(length, shift=0):
        return f"coalesce(sum(payment * pow(0.9, a - {shift})) FILTER (WHERE {inside(length, shift)}), 0)"

    def top(x, length, shift=0):
        where = f"FILTER (WHERE {inside(length, shift)})"
        return (f"CASE WHEN count(*) {where} = {length} THEN max({x}) {where} "
                f"ELSE greatest(coalesce(max({x}) {where}, 0), 0) END")

    def days(x, active, n, first_name, last_name, count_name):
        where = f"FILTER (WHERE {inside(n)} AND {active})"
        return [(count_name, f"count(*) {where}"),
                (last_name, f"coalesce(min(a + {step}) {where}, {n})"),
                (first_name, f"coalesce(max(a + 1) {where}, 0)")]

    items = []
    for n in (14, 30, 60, 91):
        items += [
            (f"payment_mean_{n}d_decay", decayed(n)), (f"payment_max_{n}d", top("payment", n)),
            (f"payment_sum_{n}d", total("payment", n)),
            (f"payment_mean_{n}d_decay_prev_week", decayed(n, 7)),
            (f"payment_max_{n}d_prev_week", top("payment", n, 7)),
            *days("payment", "payment <> 0", n, f"payment_first_sale_days_ago_{n}d",
                  f"payment_last_sale_days_ago_{n}d", f"payment_sales_days_in_last_{n}d"),
        ]
    items += [(f"payment_sum_month_{i}_before", total("payment", 30, 30 * (i - 1))) for i in (1, 2, 3)]
    for n in (21, 49, 84):
        items += [
            (f"goods_mean_{n}d", f"{total('goods', n)} / {n}"), (f"goods_max_{n}d", top("goods", n)),
            (f"goods_sum_{n}d", total("goods", n)),
            (f"goods_mean_{n}d_prev_week", f"{total('goods', n, 7)} / {n}"),
            (f"goods_max_{n}d_prev_week", top("goods", n, 7)), (f"goods_sum_{n}d_prev_week", total("goods", n, 7)),
            *days("goods", "goods > 0", n, f"goods_first_purchase_from_start_{n}d",
                  f"goods_last_purchase_days_ago_{n}d", f"goods_purchase_days_in_last_{n}d"),
        ]
    items += [(f"goods_sum_pseudomonth_{i}_before", total("goods", 28, 28 * (i - 1))) for i in (1, 2, 3)]
    return [(n, r(e)) for n, e in items]


STATIC_CTE = """static AS (
  SELECT cuts.no, customer_id, {cols}
  FROM od JOIN cuts ON order_pay_time < d + 1 GROUP BY cuts.no, customer_id)"""

WINDOW_CTE = """windowed AS (
  SELECT no, customer_id, {cols}
  FROM (SELECT cuts.no, customer_id, date_diff('day', day, d) AS a, payment, goods FROM daily JOIN cuts ON day <= d)
  GROUP BY no, customer_id)"""

PEOPLE_CTE = """people AS (
  SELECT DISTINCT cuts.no, cuts.split, cuts.d, cuts.has_label, customer_id FROM od JOIN cuts ON order_pay_time < d + 1)"""

MONTH_LABEL_CTE = """bought AS (
  SELECT DISTINCT cuts.no, customer_id FROM od JOIN cuts
  ON order_pay_time >= d + 1 AND order_pay_time < d + 1 + INTERVAL 1 MONTH)"""


def feature_sql_ctes(method):
    """CTEs after od and cuts that end in ``features`` (split, cutoff, customer_id, features, label)."""
    static, windows = static_items() + places(), window_items()
    ctes = [PEOPLE_CTE, MONTH_LABEL_CTE]
    cols, joins = [], []
    if method != "time":
        ctes.append(STATIC_CTE.format(cols=as_select(static)))
        joins.append("LEFT JOIN static s ON s.no = p.no AND s.customer_id = p.customer_id")
        cols += [f"s.{n}" for n in names(static)]
    if method != "agg":
        ctes += [daily_cte(), WINDOW_CTE.format(cols=as_select(windows))]
        joins.append("LEFT JOIN windowed w ON w.no = p.no AND w.customer_id = p.customer_id")
        cols += [f"coalesce(w.{n}, {r('-999')}) AS {n}" for n in names(windows)]
    ctes.append(f"""features AS (
  SELECT p.split, strftime(p.d, '%Y-%m-%d') AS cutoff, p.customer_id, {', '.join(cols)},
    CASE WHEN p.has_label THEN CAST(b.customer_id IS NOT NULL AS BIGINT) END AS label
  FROM people p {' '.join(joins)}
  LEFT JOIN bought b ON b.no = p.no AND b.customer_id = p.customer_id)""")
    return ctes
