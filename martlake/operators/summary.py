"""Summary layer: per-day order statistics and per-month category statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from martlake.functions.dates import month_key
from martlake.operators.detail import review_summary
from martlake.functions.numbers import cents, fraction_sum_half_up, ratio_half_up


def _valid_rows(order_wide: DataFrame) -> DataFrame:
    return order_wide.filter(
        (F.col("is_valid") == 1) & F.col("order_purchase_date").isNotNull()
    )


def first_order_per_customer(order_wide: DataFrame) -> DataFrame:
    """First purchase date per ``customer_unique_id`` (the NULL id is a group)."""
    return (
        order_wide.filter(F.col("is_valid") == 1)
        .groupBy("customer_unique_id")
        .agg(F.min("order_purchase_date").alias("first_order_date"))
    )


def daily_order_stats(order_wide: DataFrame) -> DataFrame:
    """Per purchase day: orders, delivered, canceled, GMV, order value,
    distinct customers, new customers.  Money columns stay decimal.

    One pass: rows are collapsed to one per (day, order id), so a repeated id
    is one order; then to one per (customer, day).  That table is small (a hot
    customer, or the unknown one, has at most a row per day) and gives each
    customer's first day; its rows per day are the day's customers, those on
    their first day the new ones.  An order id seen with several customers on
    a day counts for the first of them.  All sums are partial before a shuffle.
    """
    status = F.col("order_status")
    per_order = _valid_rows(order_wide).groupBy(
        F.col("order_purchase_date").alias("stat_date"), "order_id"
    ).agg(
        F.collect_set("customer_unique_id").alias("customers"),
        F.count_if(status == "delivered").alias("delivered"),
        F.count_if(status == "canceled").alias("canceled"),
        F.sum("total_payment_value").alias("money"),
    )
    by_customer = per_order.select(
        "stat_date", "delivered", "canceled", "money", F.posexplode_outer("customers").alias("at", "customer")
    )
    first = F.coalesce("at", F.lit(0)) == 0
    per_customer = by_customer.groupBy("customer", "stat_date").agg(
        F.count_if(first).alias("orders"),
        *(F.sum(F.when(first, F.col(c))).alias(c) for c in ("delivered", "canceled", "money")),
    )
    first_day = F.min("stat_date").over(Window.partitionBy("customer"))
    known = F.col("customer").isNotNull()
    days = per_customer.withColumn("new", known & (F.col("stat_date") == first_day)).groupBy("stat_date").agg(
        F.sum("orders").alias("total_orders"),
        F.sum("delivered").alias("delivered_orders"),
        F.sum("canceled").alias("canceled_orders"),
        F.sum("money").cast(DecimalType(32, 2)).alias("gmv"),
        F.count("customer").alias("total_customers"),
        F.count_if("new").alias("new_customers"),
    )
    value = ratio_half_up(cents("gmv"), F.col("total_orders") * 100, 2)
    return days.select(
        "stat_date", "total_orders", "delivered_orders", "canceled_orders", "gmv",
        value.alias("avg_order_value"), "total_customers", "new_customers",
    )


def _order_months(order_wide: DataFrame) -> DataFrame:
    return order_wide.filter(F.col("is_valid") == 1).select(
        "order_id", month_key("order_purchase_date").alias("stat_month")
    )


def _order_categories(order_item_wide: DataFrame) -> DataFrame:
    # Items pre-aggregated to one row per (order, category) before the join
    # with orders: a hot order collapses map-side and the join input shrinks.
    return (
        order_item_wide.filter(F.col("product_category_name").isNotNull())
        .groupBy("order_id", "product_category_name")
        .agg(
            F.sum("price").alias("price_sum"),
            F.count("price").alias("price_count"),
        )
    )


_MONTH_CATEGORY = ["stat_month", "product_category_name"]


def category_stats(
    order_wide: DataFrame, order_item_wide: DataFrame, reviews: DataFrame | None = None
) -> DataFrame:
    """Per month and category: distinct orders, revenue, mean item price, and,
    given ``reviews``, the mean review score (NULL without a scored order).

    Both sides have one row per order (and month or category) before the join, with
    the number of rows of a repeated order id, so orders are counted without a
    distinct aggregate, which would hold all joined rows of a task twice."""
    months = _order_months(order_wide).groupBy("order_id", "stat_month").agg(F.count(F.lit(1)).alias("copies"))
    joined = months.join(_order_categories(order_item_wide), "order_id")
    agg = joined.groupBy(*_MONTH_CATEGORY).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum(F.col("price_sum") * F.col("copies").cast(DecimalType(12, 0))).cast(DecimalType(32, 2)).alias("total_revenue"),
        F.sum(F.col("price_count") * F.col("copies")).alias("price_count"),
    )
    out = agg.select(
        *_MONTH_CATEGORY,
        "total_orders",
        "total_revenue",
        ratio_half_up(cents("total_revenue"), F.col("price_count") * 100, 2).alias("avg_item_price"),
    )
    if reviews is None:
        return out
    scores = category_review_scores(order_wide, order_item_wide, reviews).drop("reviewed_orders")
    return out.join(scores, _MONTH_CATEGORY, "left")


def category_review_scores(
    order_wide: DataFrame, order_item_wide: DataFrame, reviews: DataFrame, *, by_month: bool = True
) -> DataFrame:
    """Per category, and month unless ``by_month`` is false: mean review score
    over the distinct reviewed orders that bought the category (each order
    weighs once, whatever its number of items or reviews; unreviewed orders
    are left out).  The mean of means is added up in fractions by review count
    and rounded once, exactly for any review counts."""
    by = _MONTH_CATEGORY if by_month else _MONTH_CATEGORY[1:]
    per_order = review_summary(reviews)
    order_cats = (
        order_item_wide.filter(F.col("product_category_name").isNotNull())
        .select("order_id", "product_category_name")
        .join(per_order.select("order_id"), "order_id", "left_semi")
        .distinct()
    )
    joined = _order_months(order_wide).join(per_order, "order_id").join(order_cats, "order_id")
    by_count = joined.groupBy(*by, F.col("review_count").alias("c")).agg(
        F.sum("review_score_sum").alias("s"), F.count(F.lit(1)).alias("n")
    )
    agg = by_count.groupBy(*by).agg(
        F.sum("n").alias("reviewed_orders"), F.collect_list(F.struct("c", "s")).alias("parts")
    )
    return agg.select(
        *by,
        "reviewed_orders",
        fraction_sum_half_up(F.col("parts"), F.col("reviewed_orders"), 2).alias("avg_review_score"),
    )
