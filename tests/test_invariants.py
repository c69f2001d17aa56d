"""Cross-table invariants at sf0.01 (whole tables)."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlake.operators import detail, serving, summary
from martlake.sources.fixtures import fixture_tables
from tests.conftest import SF01


def test_layer_invariants(spark):
    t = fixture_tables(spark, SF01)
    ow = detail.order_wide(t.orders, t.customers, t.payments)
    n_orders = t.orders.filter("order_id IS NOT NULL AND order_purchase_timestamp IS NOT NULL").count()
    assert n_orders < t.orders.count()  # dirty orders exist
    assert detail.order_wide(t.orders, t.customers, t.payments, keep_invalid=True).count() == t.orders.count()
    assert t.customers.count() == spark.read.parquet(f"{SF01}/customer.parquet").count()
    assert t.reviews.count() == spark.read.parquet(f"{SF01}/events.parquet").count()
    assert ow.count() == n_orders  # no fan-out from customers or payments
    daily = summary.daily_order_stats(ow)
    sums = daily.agg(F.sum("total_orders"), F.sum("new_customers")).first()
    assert sums[0] == n_orders
    assert sums[1] == ow.select("customer_unique_id").dropna().distinct().count()
    cats = summary.category_stats(ow, detail.order_item_wide(t.order_items, t.products))
    top = serving.top_categories(cats, 25).agg(F.sum("revenue_pct")).first()[0]
    assert 99.9 <= top <= 100.1  # all 25 categories -> shares add up to ~100
    assert detail.order_item_wide(t.order_items, t.products).count() == t.order_items.count()
