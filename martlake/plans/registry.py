"""Registered queries: each takes (spark, test-data folder) and returns a
DataFrame over the whole derived tables.  Money and ratios are returned as
double; load-time columns are left out (they change on every run)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.functions.numbers import decimals_to_double
from martlake.operators import colocated, detail, distinct_counts, kpis, refresh, serving, summary
from martlake.operators.customer_days import customer_days, daily_from_customer_days
from martlake.operators.summary_sql import daily_order_stats_sql
from martlake.plans.warehouse import DETAIL_PARTITION, build_warehouse, write_source_csv
from martlake.schemas import SOURCE_FILES, SOURCE_SCHEMAS
from martlake.session import new_scratch_dir, write_scratch_table
from martlake.sinks.files import write_layer
from martlake.sinks.keyed import read_keyed, upsert_keyed, write_keyed
from martlake.sources.files import ingest, read_layer
from martlake.sources.fixtures import BUILDERS, fixture_tables, lines_for_raw
from martlake.sources.quarantine import quarantine
from martlake.sources.records import read_records_csv

Query = Callable[[SparkSession, str], DataFrame]


def _out(df: DataFrame) -> DataFrame:
    return decimals_to_double(df)


def _ow(spark, d, **kw):
    t = fixture_tables(spark, d)
    return detail.order_wide(t.orders, t.customers, t.payments, **kw)


def _iw(spark, d):
    t = fixture_tables(spark, d)
    return detail.order_item_wide(t.order_items, t.products)


def _daily(spark, d):
    return summary.daily_order_stats(_ow(spark, d))


def _cats(spark, d):
    return summary.category_stats(_ow(spark, d), _iw(spark, d))


def _ods(table: str) -> Query:
    """Source table written as raw CSV to the shared scratch folder, then
    ingested with the explicit schema (the CSV source path end to end)."""

    def q(spark: SparkSession, d: str) -> DataFrame:
        raw = f"{new_scratch_dir(spark, 'raw')}/{SOURCE_FILES[table]}"
        write_source_csv(BUILDERS[table](spark, d), raw)
        return _out(ingest(spark, table, raw, with_load_time=False))

    return q


def _order_wide_by_day_layout(spark: SparkSession, d: str) -> DataFrame:
    path = new_scratch_dir(spark, "order_wide")
    write_layer(
        _ow(spark, d), path, partition_by=DETAIL_PARTITION
    )
    back = read_layer(spark, path)
    return _out(back.filter(F.col(DETAIL_PARTITION).isNotNull()))


def _kpi(fn: Callable[[SparkSession, str, list[str]], DataFrame], name: str) -> Query:
    def q(spark: SparkSession, d: str) -> DataFrame:
        return fn(spark, d, [name])

    return q


def _daily_kpis(spark, d, names):
    return kpis.daily_kpis(_daily(spark, d), names)


def _order_kpis(spark, d, names):
    return kpis.order_kpis(_ow(spark, d), names)


def _cats_reviewed(spark, d):
    return summary.category_stats(_ow(spark, d), _iw(spark, d), fixture_tables(spark, d).reviews)


def _top_reviewed(spark, d):
    scores = summary.category_review_scores(
        _ow(spark, d), _iw(spark, d), fixture_tables(spark, d).reviews, by_month=False
    )
    return serving.top_categories(_cats(spark, d), scores=scores)


def _trend(spark, d):
    # read twice (rows, per-year tails), so it is written once, as the job does
    return serving.gmv_trend(write_scratch_table(_daily(spark, d), "daily"))


def _kpi_summary(spark: SparkSession, d: str) -> DataFrame:
    # order_wide is read once; the small table that it becomes feeds all KPIs
    t = fixture_tables(spark, d)
    days = write_scratch_table(customer_days(_ow(spark, d)), "customer_days")
    return kpis.refresh_metrics(kpis.metric_catalog(spark), kpis.kpi_values_fused(t.orders, days, t.reviews))


def _kpi_summary_by_parts(spark: SparkSession, d: str) -> DataFrame:
    # one aggregate per KPI family, for any ``as_of`` (see kpis.kpi_values)
    t = fixture_tables(spark, d)
    ow = write_scratch_table(_ow(spark, d), "order_wide")
    daily = write_scratch_table(summary.daily_order_stats(ow), "daily")
    values = kpis.kpi_values(t.orders, ow, daily, t.reviews)
    return kpis.refresh_metrics(kpis.metric_catalog(spark), values)


def _dirty_orders_csv(spark: SparkSession, d: str) -> str:
    """Raw orders as text, some of them with dates that do not parse."""
    key = F.col("order_id").try_cast("long")
    text = BUILDERS["orders"](spark, d).select(
        *(F.col(c).cast("string").alias(c) for c in SOURCE_SCHEMAS["orders"].fieldNames())
    )
    text = text.withColumn(
        "order_purchase_timestamp", F.when(key % 13 == 1, "soon").otherwise(F.col("order_purchase_timestamp"))
    ).withColumn(
        "order_estimated_delivery_date", F.when(key % 17 == 2, "n/a, ask").otherwise(F.col("order_estimated_delivery_date"))
    )
    raw = f"{new_scratch_dir(spark, 'raw')}/{SOURCE_FILES['orders']}"
    text.write.option("header", True).option("escape", '"').csv(raw)
    return raw


def _reviews_read_by_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Raw reviews with quoted line breaks in their messages, read by blocks."""
    text = F.concat(F.col("review_comment_message"), F.lit('\nsaid "twice",\n'), F.col("review_id"))
    raw = f"{new_scratch_dir(spark, 'raw')}/{SOURCE_FILES['reviews']}"
    write_source_csv(BUILDERS["reviews"](spark, d).withColumn("review_comment_message", text), raw)
    return read_records_csv(spark, "reviews", raw)


def _quarantine_orders(spark: SparkSession, d: str) -> DataFrame:
    out = new_scratch_dir(spark, "quarantine")
    accepted, rejected = quarantine(spark, "orders", _dirty_orders_csv(spark, d), out)
    return accepted.select("order_id", "order_purchase_timestamp", F.lit("").alias("failed")).unionByName(
        rejected.select("order_id", "order_purchase_timestamp", F.array_join("failed", ",").alias("failed"))
    )


def _two_batches(spark: SparkSession, d: str) -> refresh.DayStore:
    """A store filled with most orders, then refreshed with the rest, whose days
    are spread over all the others' (late orders)."""
    store = refresh.DayStore(spark, new_scratch_dir(spark, "day-store"), folders=refresh.MONTHS)
    ow = write_scratch_table(_ow(spark, d), "order_wide")
    late = F.pmod(F.xxhash64("order_id"), F.lit(20)) == 0
    refresh.build(store, ow.filter(~late))
    refresh.refresh(store, ow.filter(late), "late")
    return store


def _keyed_totals(spark: SparkSession, d: str) -> DataFrame:
    """Orders, GMV and first day per known customer: a keyed table, updated with a
    second batch that adds to it."""
    days = write_scratch_table(customer_days(_ow(spark, d)), "customer_days")
    late = F.pmod(F.xxhash64("stat_date"), F.lit(7)) == 0

    def totals(part: DataFrame) -> DataFrame:
        return part.filter(F.col("customer_unique_id").isNotNull()).groupBy("customer_unique_id").agg(
            F.sum("last_orders").alias("total_orders"),
            F.sum("money").alias("gmv"),
            F.min("stat_date").alias("first_order_date"),
        )

    key, path = ["customer_unique_id"], new_scratch_dir(spark, "keyed")
    write_keyed(totals(days.filter(~late)), path, key, 16)
    added = {
        "total_orders": F.coalesce("old.total_orders", F.lit(0)) + F.col("new.total_orders"),
        "gmv": F.when(F.col("old.gmv").isNull(), F.col("new.gmv")).otherwise(
            F.col("old.gmv") + F.coalesce("new.gmv", F.lit(0))
        ),
        "first_order_date": F.least("old.first_order_date", "new.first_order_date"),
    }
    upsert_keyed(spark, path, totals(days.filter(late)), key, 16, added)
    return read_keyed(spark, path)


def _repurchase_30d_by_day_layout(spark: SparkSession, d: str) -> DataFrame:
    path = new_scratch_dir(spark, "order_wide")
    write_layer(_ow(spark, d), path, partition_by=DETAIL_PARTITION)
    return kpis.repurchase_rate_30d_of_layout(spark, path, DETAIL_PARTITION)


def _layers(spark: SparkSession, d: str) -> colocated.OrderLayers:
    t = fixture_tables(spark, d)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return colocated.write_order_layers(_ow(spark, d), t.order_items, _iw(spark, d), t.reviews, buckets)


def _daily_from_customer_days(spark: SparkSession, d: str) -> DataFrame:
    return _out(daily_from_customer_days(customer_days(_ow(spark, d))))


def _warehouse_kpis(spark: SparkSession, d: str) -> DataFrame:
    """The full layered job from raw CSV; returns its KPI summary table."""
    root = new_scratch_dir(spark, "warehouse")
    # items and payments come from the same numbered lines: one shuffle for both
    numbered = f"{root}/lines"
    write_layer(lines_for_raw(spark, d), numbered)
    lines = read_layer(spark, numbered)
    for table, file_name in SOURCE_FILES.items():
        given = {"lines": lines} if table in ("order_items", "payments") else {}
        write_source_csv(BUILDERS[table](spark, d, **given), f"{root}/raw/{file_name}", compression="gzip")
    paths = build_warehouse(spark, f"{root}/raw", f"{root}/out")
    return read_layer(spark, paths["kpi_summary"])


QUERIES: dict[str, Query] = {
    **{f"ods_{t}": _ods(t) for t in SOURCE_FILES},
    "payment_summary": lambda s, d: _out(
        detail.payment_summary(fixture_tables(s, d).payments)
    ),
    "order_wide": lambda s, d: _out(_ow(s, d)),
    "order_wide_invalid_kept": lambda s, d: _out(_ow(s, d, keep_invalid=True)),
    "order_item_wide": lambda s, d: _out(_iw(s, d)),
    "order_item_totals": lambda s, d: _out(
        detail.orders_with_item_totals(
            fixture_tables(s, d).orders, fixture_tables(s, d).order_items
        )
    ),
    "order_wide_by_day_layout": _order_wide_by_day_layout,
    "first_order_per_customer": lambda s, d: summary.first_order_per_customer(_ow(s, d)),
    "daily_order_stats": lambda s, d: _out(_daily(s, d)),
    "daily_order_stats_sql": lambda s, d: _out(daily_order_stats_sql(_ow(s, d))),
    "category_stats": lambda s, d: _out(_cats(s, d)),
    "category_review_scores": lambda s, d: _out(
        summary.category_review_scores(_ow(s, d), _iw(s, d), fixture_tables(s, d).reviews)
    ),
    "category_stats_with_reviews": lambda s, d: _out(_cats_reviewed(s, d)),
    "top_categories": lambda s, d: _out(serving.top_categories(_cats(s, d))),
    "top_categories_with_reviews": lambda s, d: _out(_top_reviewed(s, d)),
    "gmv_trend": lambda s, d: _out(_trend(s, d)),
    "daily_order_stats_report": lambda s, d: serving.in_report_order(
        _out(_daily(s, d)), "daily_order_stats"
    ),
    "category_stats_report": lambda s, d: serving.in_report_order(_out(_cats(s, d)), "category_stats"),
    "gmv_trend_report": lambda s, d: serving.in_report_order(_out(_trend(s, d)), "gmv_trend"),
    "order_wide_with_items": lambda s, d: _out(_ow(s, d, items=fixture_tables(s, d).order_items)),
    "kpi_total_gmv": _kpi(_daily_kpis, kpis.TOTAL_GMV),
    "kpi_avg_order_value": _kpi(_daily_kpis, kpis.AVG_ORDER_VALUE),
    "kpi_completion_rate": _kpi(_daily_kpis, kpis.COMPLETION_RATE),
    "kpi_avg_delivery_days": _kpi(_order_kpis, kpis.AVG_DELIVERY_DAYS),
    "kpi_late_delivery_rate": _kpi(_order_kpis, kpis.LATE_DELIVERY_RATE),
    "kpi_total_customers": _kpi(_order_kpis, kpis.TOTAL_CUSTOMERS),
    "kpi_payment_conversion_rate": _kpi(_order_kpis, kpis.PAYMENT_CONVERSION_RATE),
    "kpi_repurchase_rate": lambda s, d: kpis.repurchase_rate(_ow(s, d)),
    "kpi_repurchase_rate_min10": lambda s, d: kpis.repurchase_rate(_ow(s, d), min_orders=10),
    "kpi_repurchase_rate_30d": lambda s, d: kpis.repurchase_rate_30d(_ow(s, d)),
    "kpi_positive_review_rate": lambda s, d: kpis.positive_review_rate(
        fixture_tables(s, d).reviews
    ),
    "kpi_total_orders": lambda s, d: kpis.total_orders(fixture_tables(s, d).orders),
    "kpi_summary": _kpi_summary,
    "ods_reviews_by_blocks": _reviews_read_by_blocks,
    "quarantine_orders": _quarantine_orders,
    "daily_order_stats_refreshed": lambda s, d: _out(_two_batches(s, d).read("daily").drop(refresh.FOLDER)),
    "customer_counts_from_bitmaps": lambda s, d: distinct_counts.customer_counts(_two_batches(s, d).read("bitmaps")),
    "customer_totals_upsert": lambda s, d: _out(_keyed_totals(s, d)),
    "kpi_repurchase_rate_30d_by_day_layout": _repurchase_30d_by_day_layout,
    "colocated_order_wide_with_items": lambda s, d: _out(colocated.order_wide_with_items(_layers(s, d))),
    "colocated_category_stats": lambda s, d: _out(colocated.category_stats(_layers(s, d))),
    "colocated_category_review_scores": lambda s, d: _out(colocated.category_review_scores(_layers(s, d))),
    "kpi_summary_by_parts": _kpi_summary_by_parts,
    "daily_from_customer_days": _daily_from_customer_days,
    "warehouse_kpis": _warehouse_kpis,
}
