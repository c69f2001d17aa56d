"""Serving tables: top categories with revenue share, daily GMV trend."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlake.functions.numbers import cents, ratio_half_up
from martlake.operators.ordered import with_previous


def top_categories(category_stats: DataFrame, k: int = 10, scores: DataFrame | None = None) -> DataFrame:
    """The ``k`` categories with the most revenue, their rank and share (%).

    The grand total is a one-row aggregate of the category totals, so
    broadcasting it is bounded.  The top-k is taken before any ranking
    (``TakeOrderedAndProject``: each task keeps its best k), so the ranking
    window only ever sees k rows.  Ties go to the category name.  ``scores``
    (one row per category, see ``category_review_scores`` with ``by_month``
    false) adds ``avg_review_score``.
    """
    totals = category_stats.groupBy("product_category_name").agg(
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("total_orders").alias("total_orders"),
    )
    grand = totals.agg(F.sum("total_revenue").alias("_grand_total"))
    order = [F.col("total_revenue").desc_nulls_last(), F.col("product_category_name").asc()]
    top = totals.orderBy(*order).limit(k)
    ranked = top.crossJoin(F.broadcast(grand)).select(
        F.row_number().over(Window.orderBy(*order)).alias("rank_no"),
        "product_category_name",
        "total_revenue",
        "total_orders",
        ratio_half_up(cents("total_revenue") * 100, cents("_grand_total"), 2).alias(
            "revenue_pct"
        ),
    )
    if scores is None:
        return ranked
    return ranked.join(scores.select("product_category_name", "avg_review_score"), "product_category_name", "left")


def gmv_trend(daily: DataFrame) -> DataFrame:
    """Daily GMV with counts, order value and growth (%) over the previous
    present day (days without orders are not filled in).  ``daily`` is read
    twice (rows, per-year tails): pass a written table."""
    base = daily.select(
        "stat_date",
        "gmv",
        F.col("total_orders").alias("order_count"),
        F.col("total_customers").alias("customer_count"),
        "avg_order_value",
    )
    with_prev = with_previous(base, "stat_date", "gmv", F.year("stat_date"), "_prev_gmv")
    prev_c = cents("_prev_gmv")
    return with_prev.select(
        "stat_date",
        "gmv",
        "order_count",
        "customer_count",
        "avg_order_value",
        ratio_half_up((cents("gmv") - prev_c) * 100, prev_c, 2).alias("gmv_growth_pct"),
    )


# Presentation order of each serving table.  Applied when a table is read
# for display, never before a write (a global sort is a range shuffle).
REPORT_ORDER = {
    "daily_order_stats": [("stat_date", "asc")],
    "category_stats": [("stat_month", "asc"), ("total_revenue", "desc")],
    "top_categories": [("rank_no", "asc")],
    "gmv_trend": [("stat_date", "desc")],
}


def in_report_order(df: DataFrame, table: str) -> DataFrame:
    cols = [
        F.col(c).asc() if how == "asc" else F.col(c).desc() for c, how in REPORT_ORDER[table]
    ]
    return df.orderBy(*cols)
