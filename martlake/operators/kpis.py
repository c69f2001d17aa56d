"""Business KPIs, the metric catalogue, and the KPI summary table.

Each KPI is a one-row aggregate; KPIs that read the same table are computed
in one ``agg`` and unpivoted to ``(metric_name, metric_value)`` rows.  A KPI
whose value is NULL (no rows, zero denominator) reports 0.0.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from martlake.functions.numbers import cents, ratio_half_up
from martlake.sources.files import partition_values, read_layer

# Metric names (fixed values).
TOTAL_ORDERS = "Total Orders"
TOTAL_GMV = "Total GMV"
TOTAL_CUSTOMERS = "Total Customers"
AVG_ORDER_VALUE = "Average Order Value"
AVG_DELIVERY_DAYS = "Average Delivery Days"
COMPLETION_RATE = "Order Completion Rate"
REPURCHASE_RATE = "Repurchase Rate"
REPURCHASE_RATE_30D = "30-day Repurchase Rate"
LATE_DELIVERY_RATE = "Late Delivery Rate"
POSITIVE_REVIEW_RATE = "Positive Review Rate"
PAYMENT_CONVERSION_RATE = "Payment Conversion Rate"

NOT_CONVERTED_STATUSES = ("canceled", "unavailable")
DELIVERY_DAYS_RANGE = (0, 100)  # exclusive bounds for the delivery-time mean
POSITIVE_SCORE = 4

# The metric catalogue: name, unit, description, calculation, period.  Names,
# units and periods are fixed values; the texts describe this code.
CATALOG: list[tuple[str, str, str, str, str]] = [
    (TOTAL_ORDERS, "Count", "Distinct orders in the source data",
     "COUNT(DISTINCT order_id) over source orders", "Lifetime"),
    (TOTAL_GMV, "BRL", "Sum of order payment totals",
     "SUM(total_payment_value) over valid orders", "Lifetime"),
    (TOTAL_CUSTOMERS, "User", "Distinct customers with at least one order",
     "COUNT(DISTINCT customer_unique_id) over valid orders", "Lifetime"),
    (AVG_ORDER_VALUE, "BRL", "GMV per order",
     "SUM(gmv) / SUM(total_orders) over days", "Lifetime"),
    (AVG_DELIVERY_DAYS, "Days", "Mean days from purchase to delivery",
     "AVG(delivery_days) for 0 < delivery_days < 100", "Delivered Orders"),
    (COMPLETION_RATE, "%", "Share of orders with status delivered",
     "SUM(delivered_orders) / SUM(total_orders) * 100", "Lifetime"),
    (REPURCHASE_RATE, "%", "Share of customers with two or more orders",
     "COUNT(customers with >= 2 orders) / COUNT(customers) * 100", "Lifetime"),
    (REPURCHASE_RATE_30D, "%", "Share of last-30-day customers with two or more orders in them",
     "COUNT(customers with >= 2 orders in window) / COUNT(active customers) * 100",
     "Last 30 Days"),
    (LATE_DELIVERY_RATE, "%", "Share of delivered orders that arrived after the estimate",
     "SUM(is_late_delivery = 1) / COUNT(is_late_delivery) * 100", "Delivered Orders"),
    (POSITIVE_REVIEW_RATE, "%", "Share of scored reviews with score 4 or 5",
     "COUNT(review_score >= 4) / COUNT(review_score) * 100", "Lifetime"),
    (PAYMENT_CONVERSION_RATE, "%", "Share of orders not canceled or unavailable",
     "COUNT(status NOT IN (canceled, unavailable)) / COUNT(*) * 100", "Lifetime"),
]

CATALOG_SCHEMA = StructType(
    [
        StructField("metric_name", StringType(), False),
        StructField("metric_unit", StringType(), True),
        StructField("metric_desc", StringType(), True),
        StructField("calc_logic", StringType(), True),
        StructField("stat_period", StringType(), True),
    ]
)


def _as_metrics(one_row: DataFrame) -> DataFrame:
    """Unpivot a one-row frame of named values to (metric_name, metric_value)."""
    return one_row.unpivot(
        ids=[],
        values=one_row.columns,
        variableColumnName="metric_name",
        valueColumnName="metric_value",
    ).select(
        "metric_name",
        F.coalesce(F.col("metric_value").cast("double"), F.lit(0.0)).alias("metric_value"),
    )


def daily_kpis(daily: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Total GMV, average order value and completion rate from the daily table:
    one aggregate, of the metrics asked for (default: all)."""
    has = F.col("total_orders") > 0
    orders = F.sum(F.when(has, F.col("total_orders")))
    metrics = {
        TOTAL_GMV: F.sum(F.when(F.col("stat_date").isNotNull(), F.col("gmv"))).cast("double"),
        AVG_ORDER_VALUE: ratio_half_up(F.sum(F.when(has, cents("gmv"))), orders * 100, 2),
        COMPLETION_RATE: ratio_half_up(F.sum(F.when(has, F.col("delivered_orders"))) * 100, orders, 2),
    }
    return _as_metrics(daily.agg(*(metrics[n].alias(n) for n in names or metrics)))


def order_kpis(order_wide: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Delivery time, late rate, distinct customers, payment conversion, over
    valid orders: one scan, of the metrics asked for (default: all).  Orders
    kept although invalid count in none of them, delivery time included."""
    lo, hi = DELIVERY_DAYS_RANGE
    dd = F.col("delivery_days")
    in_range = (dd > lo) & (dd < hi)
    late = F.col("is_late_delivery")
    status = F.col("order_status")
    metrics = {
        AVG_DELIVERY_DAYS: ratio_half_up(F.sum(F.when(in_range, dd)), F.count(F.when(in_range, dd)), 1),
        LATE_DELIVERY_RATE: ratio_half_up(F.count_if(late == 1) * 100, F.count(late), 2),
        TOTAL_CUSTOMERS: F.count_distinct("customer_unique_id"),
        PAYMENT_CONVERSION_RATE: ratio_half_up(
            F.count_if(~status.isin(*NOT_CONVERTED_STATUSES)) * 100, F.count(F.lit(1)), 2
        ),
    }
    valid = order_wide.filter(F.col("is_valid") == 1)
    return _as_metrics(valid.agg(*(metrics[n].alias(n) for n in names or metrics)))


def avg_delivery_days(order_wide: DataFrame) -> DataFrame:
    return order_kpis(order_wide, [AVG_DELIVERY_DAYS])


def _repurchase(per_customer: DataFrame, min_orders: int, name: str) -> DataFrame:
    one = per_customer.agg(
        ratio_half_up(
            F.count_if(F.col("n_orders") >= min_orders) * 100, F.count(F.lit(1)), 2
        ).alias(name)
    )
    return _as_metrics(one)


def repurchase_rate(order_wide: DataFrame, min_orders: int = 2, *, unknown: bool = True) -> DataFrame:
    """Customers with >= ``min_orders`` distinct orders / customers, lifetime.

    Grouped by ``customer_unique_id`` with SQL GROUP BY rules: orders without
    a known customer form one group that counts as one customer, unless
    ``unknown`` is false, which leaves them out.
    """
    rows = order_wide.filter(F.col("is_valid") == 1)
    if not unknown:
        rows = rows.filter(F.col("customer_unique_id").isNotNull())
    per_customer = rows.groupBy("customer_unique_id").agg(F.count_distinct("order_id").alias("n_orders"))
    return _repurchase(per_customer, min_orders, REPURCHASE_RATE)


def repurchase_rate_30d(
    order_wide: DataFrame,
    *,
    days: int = 30,
    as_of: _dt.date | None = None,
    min_orders: int = 2,
) -> DataFrame:
    """Customers with >= 2 orders in the ``days`` days ending ``as_of`` (default:
    the last purchase date) / customers with any order in them.

    Customers are grouped as in ``repurchase_rate`` (the unknown customer is
    one group).  A given ``as_of`` is a literal that reaches the scan; the
    default is a scalar subquery of the same plan, so building the frame runs
    no job.
    """
    valid = order_wide.filter(F.col("is_valid") == 1)
    d = F.col("order_purchase_date")
    last = F.lit(as_of) if as_of is not None else valid.agg(F.max(d)).scalar()
    window = valid.filter((d > F.date_sub(last, days)) & (d <= last))
    per_customer = window.groupBy("customer_unique_id").agg(F.count_distinct("order_id").alias("n_orders"))
    return _repurchase(per_customer, min_orders, REPURCHASE_RATE_30D)


def repurchase_rate_30d_of_layout(
    spark: SparkSession, path: str, day_column: str, *, days: int = 30, min_orders: int = 2
) -> DataFrame:
    """:func:`repurchase_rate_30d` over an order table of valid orders laid out in
    folders by day.

    The last day is read off the names of the folders, before any file is opened, so
    that its window is a literal range and the scan lists only the folders in it."""
    values = [v for v in partition_values(spark, path, day_column) if v is not None]
    orders = read_layer(spark, path).withColumnRenamed(day_column, "order_purchase_date")
    if not values:
        return repurchase_rate_30d(orders, days=days, min_orders=min_orders)
    as_of = max(_dt.date.fromisoformat(v) for v in values)
    return repurchase_rate_30d(orders, days=days, as_of=as_of, min_orders=min_orders)


def positive_review_rate(reviews: DataFrame) -> DataFrame:
    score = F.col("review_score")
    one = reviews.agg(
        ratio_half_up(F.count_if(score >= POSITIVE_SCORE) * 100, F.count(score), 2).alias(
            POSITIVE_REVIEW_RATE
        )
    )
    return _as_metrics(one)


def total_orders(orders: DataFrame) -> DataFrame:
    return _as_metrics(orders.agg(F.count_distinct("order_id").alias(TOTAL_ORDERS)))


def kpi_values(
    orders: DataFrame,
    order_wide: DataFrame,
    daily: DataFrame,
    reviews: DataFrame,
    *,
    as_of: _dt.date | None = None,
) -> DataFrame:
    """All KPI values as (metric_name, metric_value), one row per metric."""
    parts = [
        total_orders(orders),
        daily_kpis(daily),
        order_kpis(order_wide),
        repurchase_rate(order_wide),
        repurchase_rate_30d(order_wide, as_of=as_of),
        positive_review_rate(reviews),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def kpi_values_fused(
    orders: DataFrame, days: DataFrame, reviews: DataFrame, *, window_days: int = 30, min_orders: int = 2
) -> DataFrame:
    """All KPI values (as :func:`kpi_values`) from the table of
    ``customer_days.customer_days``, which has read ``order_wide`` once.

    All order KPIs are one aggregate in two levels: per customer (sums, orders, and
    orders in the last days), then over customers.  The last purchase date is a
    scalar subquery of the same small table; pass a written one.
    """
    day = F.col("stat_date")
    last = days.agg(F.max(day)).scalar()
    recent = F.when(day > F.date_sub(last, window_days), F.col("last_orders"))
    dated = day.isNotNull()
    per_customer = days.groupBy("customer_unique_id").agg(
        F.sum("last_orders").alias("orders"),
        F.sum(recent).alias("recent"),
        F.sum(F.when(dated, F.col("day_orders"))).alias("day_orders"),
        F.sum(F.when(dated, F.col("delivered"))).alias("delivered"),
        F.sum(F.when(dated, F.col("money"))).alias("money"),
        *(F.sum(c).alias(c) for c in ("n_rows", "converted", "delivery_days", "delivery_known", "late", "late_known")),
    )
    active = F.col("recent") > 0
    total = lambda c: F.sum(c)
    one = per_customer.agg(
        total("money").cast("double").alias(TOTAL_GMV),
        ratio_half_up(cents(total("money")), total("day_orders") * 100, 2).alias(AVG_ORDER_VALUE),
        ratio_half_up(total("delivered") * 100, total("day_orders"), 2).alias(COMPLETION_RATE),
        ratio_half_up(total("delivery_days"), total("delivery_known"), 1).alias(AVG_DELIVERY_DAYS),
        ratio_half_up(total("late") * 100, total("late_known"), 2).alias(LATE_DELIVERY_RATE),
        F.count("customer_unique_id").alias(TOTAL_CUSTOMERS),
        ratio_half_up(total("converted") * 100, total("n_rows"), 2).alias(PAYMENT_CONVERSION_RATE),
        ratio_half_up(F.count_if(F.col("orders") >= min_orders) * 100, F.count(F.lit(1)), 2).alias(REPURCHASE_RATE),
        ratio_half_up(F.count_if(F.col("recent") >= min_orders) * 100, F.count_if(active), 2).alias(REPURCHASE_RATE_30D),
    )
    one = one.select(*(F.col(f"`{c}`").cast("double").alias(c) for c in one.columns))
    return total_orders(orders).unionByName(_as_metrics(one)).unionByName(positive_review_rate(reviews))


def metric_catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CATALOG, CATALOG_SCHEMA)


def refresh_metrics(catalog: DataFrame, values: DataFrame) -> DataFrame:
    """Catalogue rows with their current values.

    A full outer join on the name: a computed value whose name is missing
    from the catalogue still appears (with empty descriptions) instead of
    being dropped, and a catalogue entry without a value keeps NULL.
    """
    return catalog.join(values, "metric_name", "full_outer").select(
        "metric_name",
        "metric_value",
        "metric_unit",
        "metric_desc",
        "calc_logic",
        "stat_period",
    )
