"""DuckDB SQL for every registered query, written from the definitions
over the raw test tables.

Every statement starts with the same CTEs that map the test tables onto the
marketplace tables.  Ratios use exact half-up integer rounding, as the Spark
side does; money and ratios come back as DOUBLE.
"""

from __future__ import annotations


def half_up_int(num: str, den: str, multiplier: int = 1) -> str:
    """SQL for round(num * multiplier / den) half away from zero, as HUGEINT;
    num and den integral, NULL when den is 0."""
    n = f"CAST(({num}) AS HUGEINT)"
    d = f"CAST(({den}) AS HUGEINT)"
    return (
        f"(CASE WHEN {d} <> 0 THEN sign({n}) * sign({d}) * "
        f"((2 * abs({n}) * {multiplier} + abs({d})) // (2 * abs({d}))) END)"
    )


def half_up(num: str, den: str, scale: int) -> str:
    """SQL for round(num/den, scale) half away from zero, as DOUBLE."""
    m = 10**scale
    return f"(CAST({half_up_int(num, den, m)} AS DOUBLE) / {float(m)})"


def cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS HUGEINT)"


SOURCES = """
m_orders AS (
  SELECT CASE WHEN o_orderkey % 211 <> 3 THEN CAST(o_orderkey AS VARCHAR) END AS order_id,
         CASE WHEN o_custkey % 50 <> 7 THEN CAST(o_custkey AS VARCHAR)
              WHEN o_orderkey % 2 <> 0 THEN 'x' || o_custkey END AS customer_id,
         CASE WHEN o_orderstatus = 'F' THEN 'delivered'
              WHEN o_orderstatus = 'O' THEN 'shipped'
              WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'canceled'
              WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'unavailable'
              WHEN o_orderstatus = 'P' THEN 'processing' END AS order_status,
         CASE WHEN o_orderkey % 97 <> 5 THEN o_orderdate END AS order_purchase_timestamp,
         CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderdate + INTERVAL 1 DAY END AS order_approved_at,
         CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderdate + INTERVAL 2 DAY END AS order_delivered_carrier_date,
         CASE WHEN o_orderstatus = 'F'
              THEN o_orderdate + to_days(CAST((o_orderkey * 37) % 130 AS INTEGER)) END
           AS order_delivered_customer_date,
         o_orderdate + to_days(20 + 10 * CAST(substr(o_orderpriority, 1, 1) AS INTEGER))
           AS order_estimated_delivery_date
  FROM orders
),
m_lines AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber NULLS LAST,
         l_partkey NULLS LAST, l_suppkey NULLS LAST, l_extendedprice NULLS LAST) AS INTEGER) AS line_no
  FROM lineitem
),
m_order_items AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, line_no AS order_item_id,
         CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
         l_shipdate AS shipping_limit_date,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
         CAST(l_quantity AS DECIMAL(12,2)) AS freight_value
  FROM m_lines
),
m_payments AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, line_no AS payment_sequential,
         CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto'
                           WHEN 'R' THEN 'voucher' END AS payment_type,
         CAST(trunc(l_quantity) AS INTEGER) AS payment_installments,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS payment_value
  FROM m_lines
),
m_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id,
         CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_brand END AS product_category_name,
         CAST(NULL AS INTEGER) AS product_name_length,
         CAST(NULL AS INTEGER) AS product_description_length,
         CAST(NULL AS INTEGER) AS product_photos_qty,
         p_size AS product_weight_g,
         CAST(NULL AS INTEGER) AS product_length_cm,
         CAST(NULL AS INTEGER) AS product_height_cm,
         CAST(NULL AS INTEGER) AS product_width_cm
  FROM part
),
m_customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
         CAST(CASE WHEN c_custkey % 10 = 1 THEN c_custkey - 1 ELSE c_custkey END AS VARCHAR)
           AS customer_unique_id,
         CAST(n_nationkey AS VARCHAR) AS customer_zip_code_prefix,
         c_mktsegment AS customer_city,
         n_name AS customer_state
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
),
m_reviews AS (
  SELECT CAST(event_id AS VARCHAR) AS review_id,
         CAST(user_id * 100 + event_id % 100 AS VARCHAR) AS order_id,
         CASE WHEN event_type IN ('view', 'purchase', 'click')
              THEN CAST(1 + (event_id * 7) % 5 AS INTEGER) END AS review_score,
         event_type AS review_comment_title,
         props AS review_comment_message,
         ts AS review_creation_date,
         ts AS review_answer_timestamp
  FROM events
)"""

PAYMENT_SUMMARY = """
ps_totals AS (
  SELECT order_id, SUM(payment_value) AS total_payment_value,
         MAX(payment_installments) AS max_payment_installments
  FROM m_payments GROUP BY order_id
),
ps_main AS (
  SELECT order_id, payment_type AS main_payment_type FROM (
    SELECT order_id, payment_type,
           row_number() OVER (PARTITION BY order_id ORDER BY payment_value DESC NULLS LAST,
                              payment_sequential ASC NULLS LAST, payment_type ASC NULLS LAST) AS rn
    FROM m_payments) WHERE rn = 1
),
ps AS (
  SELECT t.order_id, t.total_payment_value, t.max_payment_installments, m.main_payment_type
  FROM ps_totals t LEFT JOIN ps_main m ON t.order_id = m.order_id
)"""

ORDER_WIDE_SELECT = """
  SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp,
         o.order_approved_at, o.order_delivered_carrier_date,
         o.order_delivered_customer_date, o.order_estimated_delivery_date,
         c.customer_unique_id, c.customer_zip_code_prefix, c.customer_city, c.customer_state,
         ps.total_payment_value, ps.max_payment_installments, ps.main_payment_type,
         CAST(date_diff('day', CAST(o.order_purchase_timestamp AS DATE),
                        CAST(o.order_delivered_customer_date AS DATE)) AS INTEGER) AS delivery_days,
         CAST(date_diff('day', CAST(o.order_purchase_timestamp AS DATE),
                        CAST(o.order_estimated_delivery_date AS DATE)) AS INTEGER) AS estimated_days,
         IF(o.order_delivered_customer_date IS NULL, NULL,
            CAST(COALESCE(date_diff('day', CAST(o.order_estimated_delivery_date AS DATE),
                          CAST(o.order_delivered_customer_date AS DATE)) > 0, false) AS INTEGER))
           AS is_late_delivery,
         CAST(o.order_purchase_timestamp AS DATE) AS order_purchase_date,
         CASE WHEN o.order_id IS NOT NULL AND o.order_purchase_timestamp IS NOT NULL
              THEN 1 ELSE 0 END AS is_valid
  FROM m_orders o
  LEFT JOIN m_customers c ON o.customer_id = c.customer_id
  LEFT JOIN ps ON o.order_id = ps.order_id"""

ORDER_WIDE = f"""
ow AS ({ORDER_WIDE_SELECT}
  WHERE o.order_id IS NOT NULL AND o.order_purchase_timestamp IS NOT NULL
)"""

ORDER_WIDE_ALL = f"""
ow_all AS ({ORDER_WIDE_SELECT}
)"""

ITEM_WIDE = """
iw AS (
  SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, i.price, i.freight_value,
         p.product_category_name, p.product_weight_g
  FROM m_order_items i LEFT JOIN m_products p ON i.product_id = p.product_id
)"""

# A customer's days are numbered in order of date; day 1 is the day on which
# the customer is new.  Orders, customers and money are counted apart and meet
# by day.
DAILY = f"""
customer_days AS (
  SELECT order_purchase_date AS stat_date, customer_unique_id,
         row_number() OVER (PARTITION BY customer_unique_id ORDER BY order_purchase_date) AS day_no
  FROM (SELECT DISTINCT order_purchase_date, customer_unique_id FROM ow
        WHERE order_purchase_date IS NOT NULL AND customer_unique_id IS NOT NULL)
),
customers_by_day AS (
  SELECT stat_date, count(*) AS total_customers, count(*) FILTER (day_no = 1) AS new_customers
  FROM customer_days GROUP BY stat_date
),
rows_by_day AS (
  SELECT order_purchase_date AS stat_date, len(list_distinct(list(order_id))) AS total_orders,
         count(*) FILTER (order_status = 'delivered') AS delivered_orders,
         count(*) FILTER (order_status = 'canceled') AS canceled_orders,
         sum(total_payment_value) AS gmv
  FROM ow WHERE order_purchase_date IS NOT NULL GROUP BY ALL
),
daily AS (
  SELECT r.*, COALESCE(c.total_customers, 0) AS total_customers, COALESCE(c.new_customers, 0) AS new_customers
  FROM rows_by_day r LEFT JOIN customers_by_day c USING (stat_date)
),
daily_out AS (
  SELECT stat_date, CAST(total_orders AS BIGINT) AS total_orders, delivered_orders, canceled_orders, gmv,
         {half_up(cents('gmv'), 'total_orders * 100', 2)} AS avg_order_value,
         total_customers, new_customers
  FROM daily
)"""

CATEGORY = f"""
cat AS (
  SELECT strftime(ow.order_purchase_date, '%Y-%m') AS stat_month,
         iw.product_category_name,
         COUNT(DISTINCT ow.order_id) AS total_orders,
         SUM(iw.price) AS total_revenue,
         {half_up(cents('SUM(iw.price)'), 'COUNT(iw.price) * 100', 2)} AS avg_item_price
  FROM ow JOIN iw ON ow.order_id = iw.order_id
  WHERE ow.is_valid = 1 AND iw.product_category_name IS NOT NULL
  GROUP BY stat_month, iw.product_category_name
)"""


# An order's mean score in units of 1 / lcm(1..36), a whole number while an
# order has at most 36 scored reviews: nothing is rounded before the end.
_UNITS = 144403552893600
REVIEW_SCORES = f"""
order_scores AS (
  SELECT order_id, sum(review_score) * ({_UNITS} // count(review_score)) AS units
  FROM m_reviews WHERE review_score IS NOT NULL GROUP BY order_id
),
scored_orders AS (
  SELECT strftime(ow.order_purchase_date, '%Y-%m') AS stat_month, k.product_category_name, s.units
  FROM (SELECT DISTINCT order_id, product_category_name FROM iw WHERE product_category_name IS NOT NULL) k
  JOIN ow USING (order_id) JOIN order_scores s USING (order_id)
)"""
_MEAN_SCORE = half_up("units", f"{_UNITS} * reviewed_orders::HUGEINT", 2)

# Shares from a window total; every category is ranked, the best are taken.
TOP = f"""
category_totals AS (
  SELECT product_category_name, sum(total_revenue) AS revenue, CAST(sum(total_orders) AS BIGINT) AS total_orders
  FROM cat GROUP BY ALL
),
ranked AS (
  SELECT product_category_name, revenue, total_orders,
         {half_up(cents('revenue') + ' * 100', cents('sum(revenue) OVER ()'), 2)} AS revenue_pct,
         CAST(row_number() OVER (ORDER BY revenue DESC NULLS LAST, product_category_name) AS INTEGER) AS rank_no
  FROM category_totals
)"""
_TOP_COLUMNS = (
    "rank_no, product_category_name, CAST(revenue AS DOUBLE) AS total_revenue, total_orders, revenue_pct"
)


def _sql(ctes: list[str], select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


_OW = [SOURCES, PAYMENT_SUMMARY, ORDER_WIDE]
_OW_IW = _OW + [ITEM_WIDE]

_ODS_COLUMNS = {
    "orders": "*",
    "order_items": "order_id, order_item_id, product_id, seller_id, shipping_limit_date, "
    "CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value",
    "payments": "order_id, payment_sequential, payment_type, payment_installments, "
    "CAST(payment_value AS DOUBLE) AS payment_value",
    "products": "*",
    "customers": "*",
    "reviews": "*",
}

_OW_OUT = (
    "SELECT * REPLACE (CAST(total_payment_value AS DOUBLE) AS total_payment_value) FROM {t}"
)


def _kpi(name: str, value_sql: str, ctes: list[str], from_sql: str) -> str:
    return _sql(
        ctes,
        f"SELECT '{name}' AS metric_name, COALESCE(CAST(({value_sql}) AS DOUBLE), 0.0) "
        f"AS metric_value FROM {from_sql}",
    )


_DAILY_CTES = _OW + [DAILY]
_DELIVERY = (
    "SUM(CASE WHEN delivery_days > 0 AND delivery_days < 100 THEN delivery_days END)",
    "COUNT(CASE WHEN delivery_days > 0 AND delivery_days < 100 THEN 1 END)",
)


def _repurchase(name: str, min_orders: int) -> str:
    """Share of the customer groups (the unknown customer is one) that reach
    ``min_orders``: groups are counted by their number of orders first."""
    return _sql(
        _OW
        + [
            """group_sizes AS (
  SELECT n_orders, count(*) AS n_groups
  FROM (SELECT DISTINCT customer_unique_id,
               len(list_distinct(list(order_id) OVER (PARTITION BY customer_unique_id))) AS n_orders FROM ow)
  GROUP BY n_orders
)"""
        ],
        f"SELECT '{name}' AS metric_name, COALESCE({half_up(f'100 * COALESCE(sum(n_groups) FILTER (n_orders >= {min_orders}), 0)', 'sum(n_groups)', 2)}, 0.0) "
        "AS metric_value FROM group_sizes",
    )


_LAST_30_DAYS = (
    "AND order_purchase_date > (SELECT MAX(order_purchase_date) FROM ow WHERE is_valid = 1) "
    "- INTERVAL 30 DAY "
    "AND order_purchase_date <= (SELECT MAX(order_purchase_date) FROM ow WHERE is_valid = 1)"
)

KPI_VALUES = f"""
kpi_values AS (
  SELECT 'Total Orders' AS metric_name, CAST(COUNT(DISTINCT order_id) AS DOUBLE) AS metric_value
  FROM m_orders
  UNION ALL
  SELECT 'Total GMV', COALESCE(CAST(SUM(gmv) AS DOUBLE), 0.0) FROM daily_out WHERE stat_date IS NOT NULL
  UNION ALL
  SELECT 'Average Order Value',
         COALESCE({half_up(f"SUM({cents('gmv')})", 'SUM(total_orders) * 100', 2)}, 0.0)
  FROM daily_out WHERE total_orders > 0
  UNION ALL
  SELECT 'Order Completion Rate',
         COALESCE({half_up('SUM(delivered_orders) * 100', 'SUM(total_orders)', 2)}, 0.0)
  FROM daily_out WHERE total_orders > 0
  UNION ALL
  SELECT 'Average Delivery Days', COALESCE({half_up(_DELIVERY[0], _DELIVERY[1], 1)}, 0.0)
  FROM ow WHERE is_valid = 1
  UNION ALL
  SELECT 'Late Delivery Rate',
         COALESCE({half_up('SUM(CASE WHEN is_late_delivery = 1 THEN 1 ELSE 0 END) * 100', 'COUNT(is_late_delivery)', 2)}, 0.0)
  FROM ow WHERE is_valid = 1
  UNION ALL
  SELECT 'Total Customers', CAST(COUNT(DISTINCT customer_unique_id) AS DOUBLE)
  FROM ow WHERE is_valid = 1
  UNION ALL
  SELECT 'Payment Conversion Rate',
         COALESCE({half_up("SUM(CASE WHEN order_status NOT IN ('canceled', 'unavailable') THEN 1 ELSE 0 END) * 100", 'COUNT(*)', 2)}, 0.0)
  FROM ow WHERE is_valid = 1
  UNION ALL
  SELECT 'Repurchase Rate',
         COALESCE({half_up('SUM(CASE WHEN n >= 2 THEN 1 ELSE 0 END) * 100', 'COUNT(*)', 2)}, 0.0)
  FROM (SELECT customer_unique_id, COUNT(DISTINCT order_id) AS n FROM ow WHERE is_valid = 1
        GROUP BY customer_unique_id)
  UNION ALL
  SELECT '30-day Repurchase Rate',
         COALESCE({half_up('SUM(CASE WHEN n >= 2 THEN 1 ELSE 0 END) * 100', 'COUNT(*)', 2)}, 0.0)
  FROM (SELECT customer_unique_id, COUNT(DISTINCT order_id) AS n FROM ow WHERE is_valid = 1
        {_LAST_30_DAYS} GROUP BY customer_unique_id)
  UNION ALL
  SELECT 'Positive Review Rate',
         COALESCE({half_up('SUM(CASE WHEN review_score >= 4 THEN 1 ELSE 0 END) * 100', 'COUNT(review_score)', 2)}, 0.0)
  FROM m_reviews
)"""


def _catalog_values() -> str:
    from martlake.operators.kpis import CATALOG

    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    rows = ",\n  ".join("(" + ", ".join(q(v) for v in row) + ")" for row in CATALOG)
    return (
        "catalog(metric_name, metric_unit, metric_desc, calc_logic, stat_period) AS "
        f"(VALUES\n  {rows})"
    )


def _kpi_summary_sql() -> str:
    return _sql(
        _DAILY_CTES + [KPI_VALUES, _catalog_values()],
        "SELECT COALESCE(c.metric_name, v.metric_name) AS metric_name, v.metric_value, "
        "c.metric_unit, c.metric_desc, c.calc_logic, c.stat_period "
        "FROM catalog c FULL OUTER JOIN kpi_values v ON c.metric_name = v.metric_name",
    )


def _kpi_from_values(name: str) -> str:
    return _sql(
        _DAILY_CTES + [KPI_VALUES],
        f"SELECT metric_name, metric_value FROM kpi_values WHERE metric_name = '{name}'",
    )


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    for t, cols in _ODS_COLUMNS.items():
        q[f"ods_{t}"] = _sql([SOURCES], f"SELECT {cols} FROM m_{t}")
    q["payment_summary"] = _sql(
        [SOURCES, PAYMENT_SUMMARY],
        "SELECT order_id, CAST(total_payment_value AS DOUBLE) AS total_payment_value, "
        "max_payment_installments, main_payment_type FROM ps",
    )
    q["order_wide"] = _sql(_OW, _OW_OUT.format(t="ow"))
    q["order_wide_invalid_kept"] = _sql(
        [SOURCES, PAYMENT_SUMMARY, ORDER_WIDE_ALL], _OW_OUT.format(t="ow_all")
    )
    q["order_item_wide"] = _sql(
        [SOURCES, ITEM_WIDE],
        "SELECT * REPLACE (CAST(price AS DOUBLE) AS price, "
        "CAST(freight_value AS DOUBLE) AS freight_value) FROM iw",
    )
    q["order_item_totals"] = _sql(
        [SOURCES],
        """SELECT o.order_id, CAST(SUM(i.freight_value) AS DOUBLE) AS total_freight_value,
       CAST(SUM(i.price) AS DOUBLE) AS total_item_price, COUNT(i.order_id) AS item_count
FROM m_orders o LEFT JOIN m_order_items i ON o.order_id = i.order_id
WHERE o.order_id IS NOT NULL
GROUP BY o.order_id""",
    )
    q["order_wide_by_day_layout"] = _sql(
        _OW, _OW_OUT.format(t="ow") + " WHERE order_purchase_date IS NOT NULL"
    )
    q["first_order_per_customer"] = _sql(
        _OW,
        "SELECT customer_unique_id, MIN(order_purchase_date) AS first_order_date "
        "FROM ow WHERE is_valid = 1 GROUP BY customer_unique_id",
    )
    q["daily_order_stats"] = _sql(
        _DAILY_CTES, "SELECT * REPLACE (CAST(gmv AS DOUBLE) AS gmv) FROM daily_out"
    )
    q["daily_order_stats_sql"] = q["daily_order_stats"]
    q["category_stats"] = _sql(
        _OW_IW + [CATEGORY],
        "SELECT * REPLACE (CAST(total_revenue AS DOUBLE) AS total_revenue) FROM cat",
    )
    q["category_review_scores"] = _sql(
        _OW_IW + [REVIEW_SCORES],
        f"""SELECT stat_month, product_category_name, reviewed_orders, {_MEAN_SCORE} AS avg_review_score FROM (
  SELECT stat_month, product_category_name, count(*) AS reviewed_orders, sum(units) AS units
  FROM scored_orders GROUP BY ALL)""",
    )
    q["category_stats_with_reviews"] = _sql(
        _OW_IW + [CATEGORY, REVIEW_SCORES],
        f"""SELECT c.* REPLACE (CAST(c.total_revenue AS DOUBLE) AS total_revenue), s.avg_review_score
FROM cat c LEFT JOIN (
  SELECT stat_month, product_category_name, {_MEAN_SCORE} AS avg_review_score FROM (
    SELECT stat_month, product_category_name, count(*) AS reviewed_orders, sum(units) AS units
    FROM scored_orders GROUP BY ALL)) s USING (stat_month, product_category_name)""",
    )
    q["top_categories"] = _sql(_OW_IW + [CATEGORY, TOP], f"SELECT {_TOP_COLUMNS} FROM ranked WHERE rank_no <= 10")
    q["top_categories_with_reviews"] = _sql(
        _OW_IW + [CATEGORY, TOP, REVIEW_SCORES],
        f"""SELECT {_TOP_COLUMNS}, avg_review_score FROM ranked LEFT JOIN (
  SELECT product_category_name, {_MEAN_SCORE} AS avg_review_score FROM (
    SELECT product_category_name, count(*) AS reviewed_orders, sum(units) AS units
    FROM scored_orders GROUP BY ALL)) USING (product_category_name)
WHERE rank_no <= 10""",
    )
    q["gmv_trend"] = _sql(
        _DAILY_CTES,
        f"""SELECT stat_date, CAST(gmv AS DOUBLE) AS gmv, total_orders AS order_count,
       total_customers AS customer_count, avg_order_value,
       {half_up(f"({cents('gmv')} - {cents('LAG(gmv) OVER (ORDER BY stat_date)')}) * 100", cents('LAG(gmv) OVER (ORDER BY stat_date)'), 2)} AS gmv_growth_pct
FROM daily_out""",
    )
    for key, name in (
        ("kpi_total_gmv", "Total GMV"),
        ("kpi_avg_order_value", "Average Order Value"),
        ("kpi_completion_rate", "Order Completion Rate"),
        ("kpi_avg_delivery_days", "Average Delivery Days"),
        ("kpi_late_delivery_rate", "Late Delivery Rate"),
        ("kpi_total_customers", "Total Customers"),
        ("kpi_payment_conversion_rate", "Payment Conversion Rate"),
        ("kpi_repurchase_rate", "Repurchase Rate"),
        ("kpi_repurchase_rate_30d", "30-day Repurchase Rate"),
        ("kpi_positive_review_rate", "Positive Review Rate"),
        ("kpi_total_orders", "Total Orders"),
    ):
        q[key] = _kpi_from_values(name)
    for table in ("daily_order_stats", "category_stats", "gmv_trend"):
        q[f"{table}_report"] = q[table]
    q["order_wide_with_items"] = _sql(
        _OW,
        """SELECT ow.* REPLACE (CAST(total_payment_value AS DOUBLE) AS total_payment_value),
       CAST(f AS DOUBLE) AS total_freight_value, CAST(p AS DOUBLE) AS total_item_price, COALESCE(n, 0) AS item_count
FROM ow LEFT JOIN (SELECT order_id, sum(freight_value) f, sum(price) p, count(*) n FROM m_order_items GROUP BY ALL)
USING (order_id)""",
    )
    q["kpi_repurchase_rate_min10"] = _repurchase("Repurchase Rate", 10)
    q["kpi_summary"] = _kpi_summary_sql()
    q["warehouse_kpis"] = _kpi_summary_sql()
    q["ods_reviews_by_blocks"] = _sql(
        [SOURCES],
        "SELECT * REPLACE (review_comment_message || chr(10) || 'said \"twice\",' || chr(10) || review_id "
        "AS review_comment_message) FROM m_reviews",
    )
    q["quarantine_orders"] = _sql(
        [SOURCES],
        """SELECT order_id,
       CASE WHEN early IS NULL OR early <> 1 THEN order_purchase_timestamp END AS order_purchase_timestamp,
       concat_ws(',', CASE WHEN early = 1 THEN 'order_purchase_timestamp' END,
                      CASE WHEN vague = 2 THEN 'order_estimated_delivery_date' END) AS failed
FROM (SELECT *, CAST(order_id AS BIGINT) % 13 AS early, CAST(order_id AS BIGINT) % 17 AS vague FROM m_orders)""",
    )
    q["daily_order_stats_refreshed"] = q["daily_order_stats"]
    periods = ("strftime(order_purchase_date, '%Y-%m')", "strftime(order_purchase_date, '%Y')", "'all'")
    q["customer_counts_from_bitmaps"] = _sql(
        _OW,
        " UNION ALL ".join(
            f"SELECT {p} AS period, count(DISTINCT customer_unique_id) AS total_customers FROM ow "
            "WHERE customer_unique_id IS NOT NULL AND order_purchase_date IS NOT NULL GROUP BY 1"
            for p in periods
        ),
    )
    q["customer_totals_upsert"] = _sql(
        _OW,
        """SELECT customer_unique_id, count(DISTINCT order_id) AS total_orders,
       CAST(sum(total_payment_value) AS DOUBLE) AS gmv, min(order_purchase_date) AS first_order_date
FROM ow WHERE customer_unique_id IS NOT NULL GROUP BY ALL""",
    )
    q["kpi_repurchase_rate_30d_by_day_layout"] = q["kpi_repurchase_rate_30d"]
    for key in ("order_wide_with_items", "category_stats", "category_review_scores"):
        q[f"colocated_{key}"] = q[key]
    q["kpi_summary_by_parts"] = _kpi_summary_sql()
    q["daily_from_customer_days"] = q["daily_order_stats"]
    return q
