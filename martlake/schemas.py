"""Explicit schemas of the six marketplace source tables.

Money is ``decimal(12,2)`` so sums and ratios stay exact; timestamps are
zone-less in the sources and are kept as ``timestamp_ntz``; the zip prefix
is text (it can have leading zeros).
"""

from __future__ import annotations

from pyspark.sql.types import (
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

MONEY = DecimalType(12, 2)
# Raw text is "yyyy-MM-dd HH:mm:ss"; an optional fraction is accepted on read.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
TIMESTAMP_WRITE_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _schema(*cols: tuple[str, object]) -> StructType:
    return StructType([StructField(name, typ, True) for name, typ in cols])


S, I, TS = StringType(), IntegerType(), TimestampNTZType()

ORDERS = _schema(
    ("order_id", S),
    ("customer_id", S),
    ("order_status", S),
    ("order_purchase_timestamp", TS),
    ("order_approved_at", TS),
    ("order_delivered_carrier_date", TS),
    ("order_delivered_customer_date", TS),
    ("order_estimated_delivery_date", TS),
)
ORDER_ITEMS = _schema(
    ("order_id", S),
    ("order_item_id", I),
    ("product_id", S),
    ("seller_id", S),
    ("shipping_limit_date", TS),
    ("price", MONEY),
    ("freight_value", MONEY),
)
PAYMENTS = _schema(
    ("order_id", S),
    ("payment_sequential", I),
    ("payment_type", S),
    ("payment_installments", I),
    ("payment_value", MONEY),
)
PRODUCTS = _schema(
    ("product_id", S),
    ("product_category_name", S),
    ("product_name_length", I),
    ("product_description_length", I),
    ("product_photos_qty", I),
    ("product_weight_g", I),
    ("product_length_cm", I),
    ("product_height_cm", I),
    ("product_width_cm", I),
)
CUSTOMERS = _schema(
    ("customer_id", S),
    ("customer_unique_id", S),
    ("customer_zip_code_prefix", S),
    ("customer_city", S),
    ("customer_state", S),
)
REVIEWS = _schema(
    ("review_id", S),
    ("order_id", S),
    ("review_score", I),
    ("review_comment_title", S),
    ("review_comment_message", S),
    ("review_creation_date", TS),
    ("review_answer_timestamp", TS),
)

SOURCE_SCHEMAS: dict[str, StructType] = {
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "payments": PAYMENTS,
    "products": PRODUCTS,
    "customers": CUSTOMERS,
    "reviews": REVIEWS,
}

# Raw file names of the public marketplace data set (fixed values).
SOURCE_FILES: dict[str, str] = {
    "orders": "olist_orders_dataset.csv",
    "order_items": "olist_order_items_dataset.csv",
    "payments": "olist_order_payments_dataset.csv",
    "products": "olist_products_dataset.csv",
    "customers": "olist_customers_dataset.csv",
    "reviews": "olist_order_reviews_dataset.csv",
}

# Only reviews carry free text that may hold quoted line breaks.  multiLine
# parsing makes a CSV file unsplittable, so it is switched on for that table only.
MULTILINE_TABLES = frozenset({"reviews"})
