"""Map the driver's TPC-H-style test tables onto the six marketplace tables.

The test data has no marketplace CSVs, so every query starts from these
derived frames.  All rules are plain column expressions over whole tables
(see FIXTURES.md section 4); nothing is sampled or capped.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlake.functions.numbers import to_money

# Fixed values of the mapping.
ORDER_STATUS_FOR_F = "delivered"
ORDER_STATUS_FOR_O = "shipped"
ORDER_STATUS_P_URGENT = "canceled"  # P with priority 1-URGENT
ORDER_STATUS_P_LOW = "unavailable"  # P with priority 5-LOW
ORDER_STATUS_P_OTHER = "processing"
PAYMENT_TYPE_BY_RETURNFLAG = {"A": "credit_card", "N": "boleto", "R": "voucher"}
SCORED_EVENT_TYPES = ("view", "purchase", "click")  # events of other types are reviews without a score
# Orders whose customer is unknown: even keys have no customer id, odd ones an
# id that no customer has.
ORPHAN_MOD, ORPHAN_REM = 50, 7
# Dirty orders: without purchase time, without order id.
NO_TIME_MOD, NO_TIME_REM = 97, 5
NO_ID_MOD, NO_ID_REM = 211, 3
CUSTOMER_MERGE_MOD, CUSTOMER_MERGE_REM = 10, 1  # two customer ids, one person


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _plus_days(ts: Column, days: Column) -> Column:
    return F.timestamp_add("DAY", days, ts)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    st, pr, d = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderdate")
    status = (
        F.when(st == "F", ORDER_STATUS_FOR_F)
        .when(st == "O", ORDER_STATUS_FOR_O)
        .when((st == "P") & (pr == "1-URGENT"), ORDER_STATUS_P_URGENT)
        .when((st == "P") & (pr == "5-LOW"), ORDER_STATUS_P_LOW)
        .when(st == "P", ORDER_STATUS_P_OTHER)
    )
    shipped = st.isin("F", "O")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    customer = F.when(cust % ORPHAN_MOD != ORPHAN_REM, cust.cast("string")).when(
        key % 2 != 0, F.concat(F.lit("x"), cust.cast("string"))
    )
    return o.select(
        F.when(key % NO_ID_MOD != NO_ID_REM, key.cast("string")).alias("order_id"),
        customer.alias("customer_id"),
        status.alias("order_status"),
        F.when(key % NO_TIME_MOD != NO_TIME_REM, d).alias("order_purchase_timestamp"),
        F.when(shipped, _plus_days(d, F.lit(1))).alias("order_approved_at"),
        F.when(shipped, _plus_days(d, F.lit(2))).alias("order_delivered_carrier_date"),
        F.when(st == "F", _plus_days(d, (F.col("o_orderkey") * 37) % 130)).alias(
            "order_delivered_customer_date"
        ),
        _plus_days(d, F.substring(pr, 1, 1).cast("int") * 10 + 20).alias(
            "order_estimated_delivery_date"
        ),
    )


def _numbered_lines(spark: SparkSession, sf_dir: str, by: str = "order_id") -> DataFrame:
    # Per-order line ordinal.  The test tables have a dozen or so lines per
    # order at most, so the per-order window stays small; real sources
    # carry order_item_id / payment_sequential themselves.  The window is
    # keyed on the text order_id, so the shuffle it needs also serves the
    # later per-order aggregates and joins (which key on order_id).  Where none
    # follows, ``by`` names the number it is the text of: narrower to shuffle.
    w = Window.partitionBy(by).orderBy(
        F.col("l_linenumber").asc_nulls_last(),
        F.col("l_partkey").asc_nulls_last(),
        F.col("l_suppkey").asc_nulls_last(),
        F.col("l_extendedprice").asc_nulls_last(),
    )
    return (
        _table(spark, sf_dir, "lineitem")
        .withColumn("order_id", F.col("l_orderkey").cast("string"))
        .withColumn("line_no", F.row_number().over(w))
    )


def lines_for_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ``order_items`` and ``payments`` read, to be written once for both."""
    return _numbered_lines(spark, sf_dir, "l_orderkey").select(
        "l_orderkey", "line_no", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_returnflag"
    )


def _lines(spark: SparkSession, sf_dir: str, written: DataFrame | None) -> DataFrame:
    if written is None:
        return _numbered_lines(spark, sf_dir)
    return written.withColumn("order_id", F.col("l_orderkey").cast("string"))


def order_items(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    return _lines(spark, sf_dir, lines).select(
        "order_id",
        F.col("line_no").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        to_money("l_extendedprice").alias("price"),
        to_money("l_quantity").alias("freight_value"),
    )


def payments(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    flag = F.col("l_returnflag")
    ptype = None
    for k, v in PAYMENT_TYPE_BY_RETURNFLAG.items():
        ptype = F.when(flag == k, v) if ptype is None else ptype.when(flag == k, v)
    return _lines(spark, sf_dir, lines).select(
        "order_id",
        F.col("line_no").alias("payment_sequential"),
        ptype.alias("payment_type"),
        F.col("l_quantity").cast("int").alias("payment_installments"),
        to_money("l_extendedprice").alias("payment_value"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    no_int = F.lit(None).cast("int")
    return _table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.when(F.col("p_type") == "PROMO", F.lit(None).cast("string"))
        .otherwise(F.col("p_brand"))
        .alias("product_category_name"),
        no_int.alias("product_name_length"),
        no_int.alias("product_description_length"),
        no_int.alias("product_photos_qty"),
        F.col("p_size").alias("product_weight_g"),
        no_int.alias("product_length_cm"),
        no_int.alias("product_height_cm"),
        no_int.alias("product_width_cm"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "customer")
    n = _table(spark, sf_dir, "nation")
    key = F.col("c_custkey")
    unique = F.when(key % CUSTOMER_MERGE_MOD == CUSTOMER_MERGE_REM, key - 1).otherwise(key)
    return (
        c.join(n, c["c_nationkey"] == n["n_nationkey"], "left")
        .select(
            key.cast("string").alias("customer_id"),
            unique.cast("string").alias("customer_unique_id"),
            F.col("n_nationkey").cast("string").alias("customer_zip_code_prefix"),
            F.col("c_mktsegment").alias("customer_city"),
            F.col("n_name").alias("customer_state"),
        )
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events")
    eid = F.col("event_id")
    scored = F.col("event_type").isin(*SCORED_EVENT_TYPES)
    return e.select(
        eid.cast("string").alias("review_id"),
        (F.col("user_id") * 100 + eid % 100).cast("string").alias("order_id"),
        F.when(scored, (eid * 7 % 5 + 1).cast("int")).alias("review_score"),
        F.col("event_type").alias("review_comment_title"),
        F.col("props").alias("review_comment_message"),
        F.col("ts").alias("review_creation_date"),
        F.col("ts").alias("review_answer_timestamp"),
    )


BUILDERS = {
    "orders": orders,
    "order_items": order_items,
    "payments": payments,
    "products": products,
    "customers": customers,
    "reviews": reviews,
}


@dataclass
class FixtureTables:
    """Lazily built source frames for one test-data folder."""

    spark: SparkSession
    sf_dir: str
    _cache: dict[str, DataFrame] = field(default_factory=dict)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in BUILDERS:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = BUILDERS[name](self.spark, self.sf_dir)
        return self._cache[name]


def fixture_tables(spark: SparkSession, sf_dir: str) -> FixtureTables:
    return FixtureTables(spark, sf_dir)
