"""Detail layer: one row per order, one row per order item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.functions.dates import day_span, purchase_date
from martlake.operators.joins import lookup_left


def payment_summary(payments: DataFrame) -> DataFrame:
    """Per order: total paid, most installments, and the main payment type.

    The main type belongs to the largest payment; ties go to the lowest
    ``payment_sequential``, then the smallest type name (NULLs last in each).
    One ``groupBy`` does all three, and every aggregate is partial, so a hot
    order is combined map-side before the shuffle.
    """
    v, s, t = F.col("payment_value"), F.col("payment_sequential"), F.col("payment_type")
    rank_key = F.struct(v.isNull(), -v, s.isNull(), s, t.isNull(), t)
    return payments.groupBy("order_id").agg(
        F.sum(v).alias("total_payment_value"),
        F.max("payment_installments").alias("max_payment_installments"),
        F.min_by(t, rank_key).alias("main_payment_type"),
    )


def order_item_totals(items: DataFrame) -> DataFrame:
    """Per order: freight total, item price total, item count."""
    return items.groupBy("order_id").agg(
        F.sum("freight_value").alias("total_freight_value"),
        F.sum("price").alias("total_item_price"),
        F.count(F.lit(1)).alias("item_count"),
    )


def orders_with_item_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders LEFT JOIN item totals; orders without items get count 0."""
    totals = order_item_totals(items)
    return (
        orders.select("order_id")
        .filter(F.col("order_id").isNotNull())
        .join(totals, "order_id", "left")
        .withColumn("item_count", F.coalesce("item_count", F.lit(0).cast("long")))
    )


def _is_valid(orders: DataFrame):
    return F.col("order_id").isNotNull() & F.col("order_purchase_timestamp").isNotNull()


def order_wide(
    orders: DataFrame,
    customers: DataFrame,
    payments: DataFrame,
    *,
    keep_invalid: bool = False,
    items: DataFrame | None = None,
    load_date=None,
) -> DataFrame:
    """One row per order with customer, payment summary and delivery columns.

    Rows missing ``order_id`` or the purchase time are dropped (default) or,
    with ``keep_invalid=True``, kept with ``is_valid = 0``.  The quality filter
    runs before the joins so dirty rows are never shuffled.  ``items`` adds
    the order's freight total, item price total and item count (0 without
    items); ``load_date`` (a Column) adds ``etl_date``.
    """
    valid = _is_valid(orders)
    base = orders.withColumn("is_valid", F.when(valid, 1).otherwise(0))
    if not keep_invalid:
        base = base.filter(valid)
    cust = customers.select(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    )
    wide = lookup_left(base, cust, "customer_id", ["order_id", "order_purchase_timestamp"])
    per_order = [payment_summary(payments)] + ([order_item_totals(items)] if items is not None else [])
    for totals in per_order:
        if keep_invalid:
            wide = lookup_left(wide, totals, "order_id", ["customer_id", "order_purchase_timestamp"])
        else:  # no NULL order id is left
            wide = wide.join(totals, "order_id", "left")
    delivered, estimated = (
        F.col("order_delivered_customer_date"),
        F.col("order_estimated_delivery_date"),
    )
    # unknown until delivered; without an estimate nothing is late
    after = F.coalesce(day_span(delivered, estimated) > 0, F.lit(False))
    late = F.when(delivered.isNotNull(), after.cast("int"))
    order_cols = [c for c in orders.columns if c not in ("order_id", "customer_id")]
    totals_columns = [] if items is None else [
        "total_freight_value", "total_item_price", F.coalesce("item_count", F.lit(0).cast("long")).alias("item_count"),
    ]
    out = wide.select(
        "order_id",
        "customer_id",
        *order_cols,
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
        "total_payment_value",
        "max_payment_installments",
        "main_payment_type",
        day_span(delivered, "order_purchase_timestamp").alias("delivery_days"),
        day_span(estimated, "order_purchase_timestamp").alias("estimated_days"),
        late.cast("int").alias("is_late_delivery"),
        purchase_date("order_purchase_timestamp").alias("order_purchase_date"),
        F.col("is_valid").cast("int").alias("is_valid"),
        *totals_columns,
    )
    if load_date is not None:
        out = out.withColumn("etl_date", load_date)
    return out


def order_item_wide(items: DataFrame, products: DataFrame, *, load_time=None) -> DataFrame:
    """One row per order item with its product's category and weight.

    Items without a product are spread by order, seller and price: a summary then
    reads no ``order_item_id``, which costs a sort per order where it is computed."""
    prod = products.select("product_id", "product_category_name", "product_weight_g")
    out = lookup_left(items, prod, "product_id", ["order_id", "seller_id", "price"]).select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "price",
        "freight_value",
        "product_category_name",
        "product_weight_g",
    )
    if load_time is not None:
        out = out.withColumn("etl_timestamp", load_time)
    return out


def review_summary(reviews: DataFrame) -> DataFrame:
    """Per order: number of scored reviews and the sum of their scores."""
    return (
        reviews.filter(F.col("review_score").isNotNull() & F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(
            F.count(F.lit(1)).alias("review_count"),
            F.sum("review_score").alias("review_score_sum"),
        )
    )
