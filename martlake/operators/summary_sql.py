"""The daily statistics written as Spark SQL.

Same result as ``summary.daily_order_stats``; offered for users who keep
their logic in SQL.  The plan goes through the same optimiser, so the shape
of the SQL matters: the new-customer count is a per-customer first-date
aggregate counted per day, not a join of every order to its customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

DAILY_SQL = """
WITH valid AS (
  SELECT * FROM {order_wide}
  WHERE is_valid = 1 AND order_purchase_date IS NOT NULL
),
per_day AS (
  SELECT order_purchase_date                                   AS stat_date,
         COUNT(DISTINCT order_id)                              AS total_orders,
         COUNT_IF(order_status = 'delivered')                  AS delivered_orders,
         COUNT_IF(order_status = 'canceled')                   AS canceled_orders,
         SUM(total_payment_value)                              AS gmv,
         COUNT(DISTINCT customer_unique_id)                    AS total_customers
  FROM valid
  GROUP BY order_purchase_date
),
first_day AS (
  SELECT MIN(order_purchase_date) AS stat_date
  FROM valid
  WHERE customer_unique_id IS NOT NULL
  GROUP BY customer_unique_id
),
new_per_day AS (
  SELECT stat_date, COUNT(*) AS new_customers FROM first_day GROUP BY stat_date
)
SELECT p.stat_date, p.total_orders, p.delivered_orders, p.canceled_orders, p.gmv,
       CAST(ROUND(p.gmv / p.total_orders, 2) AS DOUBLE)       AS avg_order_value,
       p.total_customers,
       COALESCE(n.new_customers, 0)                           AS new_customers
FROM per_day p LEFT JOIN new_per_day n ON p.stat_date = n.stat_date
"""


def daily_order_stats_sql(order_wide: DataFrame) -> DataFrame:
    """The daily SQL over ``order_wide``, which is passed as a parameter; no
    view of the caller is touched.

    ``ROUND(gmv / total_orders, 2)`` rounds once, exactly: for
    ``decimal(22,2) / bigint`` Spark keeps the quotient to 18 places, while a
    non-tie quotient lies at least 1 / (200 * orders) from a rounding tie.
    The DataFrame form uses integer half-up rounding instead.
    """
    return order_wide.sparkSession.sql(DAILY_SQL, order_wide=order_wide)
