"""Order tables that lie together by ``order_id``, and the joins over them.

Each layer has one row per order (or per order and category), made by an aggregate
that combines before its shuffle, so that no order id is hot; written once, bucketed
by ``order_id``, it is joined any number of times without a shuffle on that key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.functions.numbers import cents, fraction_sum_half_up, ratio_half_up
from martlake.functions.dates import month_key
from martlake.operators.detail import order_item_totals, review_summary
from martlake.sinks.buckets import write_bucketed

KEY = "order_id"


@dataclass(frozen=True)
class OrderLayers:
    """``orders`` (one row per valid order), ``item_totals``, ``categories`` (order
    and category: price sum and count) and ``reviews`` (score sum and count)."""

    orders: DataFrame
    item_totals: DataFrame
    categories: DataFrame
    reviews: DataFrame


def order_categories(order_item_wide: DataFrame) -> DataFrame:
    """Per order and category (none is left out): price sum and number of prices."""
    return (
        order_item_wide.filter(F.col("product_category_name").isNotNull())
        .groupBy(KEY, "product_category_name")
        .agg(F.sum("price").alias("price_sum"), F.count("price").alias("price_count"))
    )


def write_order_layers(
    order_wide: DataFrame, items: DataFrame, order_item_wide: DataFrame, reviews: DataFrame, buckets: int
) -> OrderLayers:
    return OrderLayers(
        write_bucketed(order_wide.filter(F.col("is_valid") == 1), "order_wide", KEY, buckets),
        write_bucketed(order_item_totals(items), "order_item_totals", KEY, buckets),
        write_bucketed(order_categories(order_item_wide), "order_categories", KEY, buckets),
        write_bucketed(review_summary(reviews), "order_reviews", KEY, buckets),
    )


def order_wide_with_items(layers: OrderLayers) -> DataFrame:
    """Orders with freight total, item price total and item count (0 without items)."""
    return layers.orders.join(layers.item_totals, KEY, "left").withColumn(
        "item_count", F.coalesce("item_count", F.lit(0).cast("long"))
    )


def _months(layers: OrderLayers) -> DataFrame:
    return layers.orders.select(KEY, month_key("order_purchase_date").alias("stat_month"))


def category_stats(layers: OrderLayers) -> DataFrame:
    """Per month and category: distinct orders, revenue, mean item price.  Orders
    are told apart where they lie; only month totals are shuffled."""
    by = ["stat_month", "product_category_name"]
    per_order = _months(layers).join(layers.categories, KEY).groupBy(KEY, *by).agg(
        F.sum("price_sum").alias("price_sum"), F.sum("price_count").alias("price_count")
    )
    out = per_order.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("price_sum").alias("total_revenue"),
        F.sum("price_count").alias("price_count"),
    )
    mean = ratio_half_up(cents("total_revenue"), F.col("price_count") * 100, 2)
    return out.select(*by, "total_orders", "total_revenue", mean.alias("avg_item_price"))


def category_review_scores(layers: OrderLayers) -> DataFrame:
    """Per month and category: reviewed orders, and the mean of their mean scores
    (see ``summary.category_review_scores``)."""
    by = ["stat_month", "product_category_name"]
    joined = _months(layers).join(layers.reviews, KEY).join(layers.categories.select(KEY, by[1]), KEY)
    by_count = joined.groupBy(*by, F.col("review_count").alias("c")).agg(
        F.sum("review_score_sum").alias("s"), F.count(F.lit(1)).alias("n")
    )
    out = by_count.groupBy(*by).agg(
        F.sum("n").alias("reviewed_orders"), F.collect_list(F.struct("c", "s")).alias("parts")
    )
    mean = fraction_sum_half_up(F.col("parts"), F.col("reviewed_orders"), 2)
    return out.select(*by, "reviewed_orders", mean.alias("avg_review_score"))
