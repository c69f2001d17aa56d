"""DataFrame -> DataFrame builders for every warehouse layer."""

from martlake.operators.detail import (
    order_item_totals,
    order_item_wide,
    order_wide,
    orders_with_item_totals,
    payment_summary,
    review_summary,
)
from martlake.operators.kpis import kpi_values, metric_catalog, refresh_metrics
from martlake.operators.serving import gmv_trend, top_categories
from martlake.operators.summary import (
    category_review_scores,
    category_stats,
    daily_order_stats,
    first_order_per_customer,
)

__all__ = [
    "category_review_scores",
    "category_stats",
    "daily_order_stats",
    "first_order_per_customer",
    "gmv_trend",
    "kpi_values",
    "metric_catalog",
    "order_item_totals",
    "order_item_wide",
    "order_wide",
    "orders_with_item_totals",
    "payment_summary",
    "refresh_metrics",
    "review_summary",
    "top_categories",
]
