"""Plan-shape checks: the physical plan is the one designed for scale."""

from __future__ import annotations

import re

from martlake.operators import detail, kpis, serving, summary
from martlake.operators.joins import lookup_left
from martlake.session import write_scratch_table
from martlake.sources.fixtures import fixture_tables
from tests.conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _adaptive_final(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return _plan(df)


def test_payment_summary_is_one_aggregate_shuffle(spark):
    t = fixture_tables(spark, SF001)
    p = _plan(detail.payment_summary(t.payments))
    # the window that numbers the test lines and the per-order aggregate share
    # one hash exchange on order_id
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 1, p
    assert "min_by" in p


def test_quality_filter_reaches_scan(spark):
    t = fixture_tables(spark, SF001)
    orders = write_scratch_table(t.orders, "orders")
    p = _plan(detail.order_wide(orders, t.customers, t.payments))
    assert "PushedFilters: [IsNotNull(order_id), IsNotNull(order_purchase_timestamp)]" in p


def test_scan_reads_only_needed_columns(spark):
    t = fixture_tables(spark, SF001)
    ow = detail.order_wide(t.orders, t.customers, t.payments)
    p = _plan(summary.first_order_per_customer(ow))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in p
    # the payment join is removed: its columns are not needed
    assert "lineitem" not in p


def test_top_k_window_sees_only_k_rows(spark):
    t = fixture_tables(spark, SF001)
    ow = detail.order_wide(t.orders, t.customers, t.payments)
    cats = summary.category_stats(ow, detail.order_item_wide(t.order_items, t.products))
    p = _plan(serving.top_categories(cats, 10))
    window_at = p.index("Window [")
    assert "TakeOrderedAndProject(limit=10" in p[window_at:], p


def test_daily_trend_has_no_global_window_over_days(spark):
    t = fixture_tables(spark, SF001)
    daily = summary.daily_order_stats(detail.order_wide(t.orders, t.customers, t.payments))
    p = _plan(serving.gmv_trend(daily))
    # the day-level window is partitioned by year; only the per-year table
    # (one row per year) is ordered globally
    assert "Window [row_number()" in p and "lag(gmv" in p
    assert "windowspecdefinition(_bucket" in p


def test_as_of_scalar_scans_only_orders(spark):
    from pyspark.sql import functions as F

    t = fixture_tables(spark, SF001)
    ow = detail.order_wide(t.orders, t.customers, t.payments)
    p = _plan(ow.filter(F.col("is_valid") == 1).agg(F.max("order_purchase_date")))
    # max() ignores duplicates, so Catalyst drops both left joins
    assert "Join" not in p and "lineitem" not in p and "customer.parquet" not in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in p


def test_daily_stats_is_one_pass(spark):
    t = fixture_tables(spark, SF001)
    ow = write_scratch_table(detail.order_wide(t.orders, t.customers, t.payments), "order_wide")
    p = _plan(summary.daily_order_stats(ow))
    assert p.count("Scan parquet") == 1 and "Join" not in p and "Expand" not in p, p
    p = _plan(kpis.daily_kpis(summary.daily_order_stats(ow)))
    assert p.count("Scan parquet") == 1 and "Join" not in p, p


def test_only_requested_metrics_are_computed(spark):
    t = fixture_tables(spark, SF001)
    ow = detail.order_wide(t.orders, t.customers, t.payments)
    assert "distinct" in _plan(kpis.order_kpis(ow))
    p = _plan(kpis.order_kpis(ow, [kpis.AVG_DELIVERY_DAYS]))
    assert "distinct" not in p and "order_status" not in p and "is_late" not in p


def test_as_of_is_part_of_the_plan(spark):
    t = fixture_tables(spark, SF001)
    ow = detail.order_wide(t.orders, t.customers, t.payments)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("as-of", "building runs no job")
    try:
        df = kpis.repurchase_rate_30d(ow)
        assert not tracker.getJobIdsForGroup("as-of")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "Subquery" in _plan(df)


def test_null_keys_spread_over_reducers(spark):
    """With AQE off: the replaced key is the exchange's key, and 10,000 NULL
    rows are even over all reducers."""
    from pyspark.sql import functions as F

    fact = spark.range(10_000).select(F.col("id").alias("row"), F.lit(None).cast("string").alias("k"))
    fact = fact.union(spark.range(100).selectExpr("id", "cast(id as string)"))
    dim = spark.range(100).selectExpr("cast(id as string) k", "id v").union(
        spark.range(1).selectExpr("concat('null-', xxhash64(5L)) k", "-1L v")
    )
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = lookup_left(fact, dim, "k", ["row"])
        assert "Exchange hashpartitioning(_lookup_key" in _plan(out)
        nulls = out.filter("k is null").groupBy(F.spark_partition_id().alias("p")).count().collect()
        matched, total = out.filter("v is not null").count(), out.count()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(nulls) == 8 and max(r["count"] for r in nulls) < 1.2 * min(r["count"] for r in nulls)
    assert (matched, total) == (100, 10_100)  # the look-alike key of the dimension matches nothing


def test_category_stats_holds_each_order_once(spark):
    """No sort per order for an item number that is not read, no distinct aggregate."""
    t = fixture_tables(spark, SF001)
    ow = detail.order_wide(t.orders, t.customers, t.payments)
    p = _plan(summary.category_stats(ow, detail.order_item_wide(t.order_items, t.products)))
    assert "Window" not in p and "distinct" not in p and "partial_count(order_id" not in p, p


def test_category_stats_of_repeated_orders(spark):
    """A repeated order id counts once, its items as often as it is repeated."""
    ow = spark.createDataFrame(
        [("a", "2020-01-02", 1), ("a", "2020-01-03", 1), ("a", "2020-02-01", 1), ("b", None, 1), (None, "2020-01-01", 1)],
        "order_id string, d string, is_valid int",
    ).selectExpr("order_id", "cast(d as date) order_purchase_date", "is_valid")
    iw = spark.createDataFrame(
        [("a", "x", 1.5), ("a", "x", 2.0), ("a", "y", None), ("b", "x", 4.0), (None, "x", 8.0), ("a", None, 16.0)],
        "order_id string, product_category_name string, p double",
    ).selectExpr("order_id", "product_category_name", "cast(p as decimal(12,2)) price")
    out = summary.category_stats(ow, iw)
    assert out.schema["total_revenue"].dataType.simpleString() == "decimal(32,2)"
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert [(m, c, n, None if v is None else float(v), a) for m, c, n, v, a in got] == [
        ("2020-01", "x", 1, 7.0, 1.75), ("2020-01", "y", 1, None, None),
        ("2020-02", "x", 1, 3.5, 1.75), ("2020-02", "y", 1, None, None), (None, "x", 1, 4.0, 4.0),
    ]
