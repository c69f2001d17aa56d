"""One row per customer and purchase day, with all that the daily table and the
business KPIs add up.

``order_wide`` is read once.  The table is small (a customer, the unknown one
included, has at most a row per day), additive by day and by customer, and feeds
the daily statistics, every order KPI and the incremental refresh.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from martlake.functions.numbers import cents, ratio_half_up

DELIVERED, CANCELED = "delivered", "canceled"
NOT_CONVERTED_STATUSES = ("canceled", "unavailable")
DELIVERY_DAYS_RANGE = (0, 100)  # exclusive bounds for the delivery-time mean

#: Columns that add up over orders.
SUMS = (
    "n_rows", "delivered", "canceled", "converted", "money", "delivery_days", "delivery_known", "late", "late_known",
)


def _row_sums() -> dict[str, Column]:
    lo, hi = DELIVERY_DAYS_RANGE
    days, status, late = F.col("delivery_days"), F.col("order_status"), F.col("is_late_delivery")
    in_range = (days > lo) & (days < hi)
    return {
        "n_rows": F.count(F.lit(1)),
        "delivered": F.count_if(status == DELIVERED),
        "canceled": F.count_if(status == CANCELED),
        "converted": F.count_if(~status.isin(*NOT_CONVERTED_STATUSES)),
        "money": F.sum("total_payment_value"),
        "delivery_days": F.sum(F.when(in_range, days)),
        "delivery_known": F.count_if(in_range),
        "late": F.count_if(late == 1),
        "late_known": F.count(late),
    }


def customer_days(order_wide: DataFrame) -> DataFrame:
    """Per (customer_unique_id, stat_date) of the valid orders: ``SUMS`` over rows and

    * ``day_orders``: order ids, each counted once a day, for the first of the
      customers it has on that day;
    * ``last_orders``: the customer's order ids whose last day this is, so that a
      sum over days counts each order of a customer once.

    Rows of one order, day and customer are combined before any shuffle; what is
    left of an order id, also of one that is repeated without end, is a row per day
    and customer.
    """
    key = ["order_id", "customer_unique_id", F.col("order_purchase_date").alias("stat_date")]
    per_order = order_wide.filter(F.col("is_valid") == 1).groupBy(*key).agg(
        *(c.alias(n) for n, c in _row_sums().items())
    )
    # both windows read rows that lie together by order id
    per_order = per_order.repartition("order_id")
    last = F.max("stat_date").over(Window.partitionBy("order_id", "customer_unique_id"))
    place = F.row_number().over(
        Window.partitionBy("order_id", "stat_date").orderBy(F.col("customer_unique_id").asc_nulls_last())
    )
    marked = per_order.select("*", F.col("stat_date").eqNullSafe(last).alias("is_last"), (place == 1).alias("is_first"))
    return marked.groupBy("customer_unique_id", "stat_date").agg(
        F.count_if("is_first").alias("day_orders"),
        F.count_if("is_last").alias("last_orders"),
        *(F.sum(c).alias(c) for c in SUMS),
    )


def daily_from_customer_days(days: DataFrame, first_days: DataFrame | None = None) -> DataFrame:
    """The daily statistics (as ``summary.daily_order_stats``).

    A customer is new on its first day: found in ``days`` itself, or, when these are
    only some of all days, in ``first_days`` (customer_unique_id, first_date)."""
    known = F.col("customer_unique_id").isNotNull()
    if first_days is None:
        first = F.min("stat_date").over(Window.partitionBy("customer_unique_id"))
        marked = days.filter(F.col("stat_date").isNotNull()).withColumn("first_date", first)
    else:
        marked = days.filter(F.col("stat_date").isNotNull()).join(first_days, "customer_unique_id", "left")
    out = marked.groupBy("stat_date").agg(
        F.sum("day_orders").alias("total_orders"),
        F.sum("delivered").alias("delivered_orders"),
        F.sum("canceled").alias("canceled_orders"),
        F.sum("money").cast(DecimalType(32, 2)).alias("gmv"),
        F.count("customer_unique_id").alias("total_customers"),
        F.count_if(known & (F.col("stat_date") == F.col("first_date"))).alias("new_customers"),
    )
    value = ratio_half_up(cents("gmv"), F.col("total_orders") * 100, 2)
    return out.select(
        "stat_date", "total_orders", "delivered_orders", "canceled_orders", "gmv",
        value.alias("avg_order_value"), "total_customers", "new_customers",
    )


def first_days(days: DataFrame) -> DataFrame:
    """(customer_unique_id, first_date) of the known customers."""
    return (
        days.filter(F.col("customer_unique_id").isNotNull() & F.col("stat_date").isNotNull())
        .groupBy("customer_unique_id").agg(F.min("stat_date").alias("first_date"))
    )
