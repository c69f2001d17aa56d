"""A third of all orders from one customer, plus NULL customer keys.

With broadcast disabled the customer lookup is a shuffle join; AQE must split
the hot key's partition (the fact side of a left join is splittable) and the
results must stay whole.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from martlake import schemas
from martlake.operators import detail, summary


def test_hot_customer_is_split_and_results_whole(spark):
    n = 30_000
    orders = spark.range(n).select(
        F.col("id").cast("string").alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 7 == 1, F.lit(None).cast("string"))
        .otherwise((F.col("id") % 1000).cast("string"))
        .alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        F.timestamp_add("DAY", F.col("id") % 30, F.lit(dt.datetime(2020, 1, 1))).alias(
            "order_purchase_timestamp"
        ),
        *[F.lit(None).cast("timestamp_ntz").alias(c) for c in schemas.ORDERS.fieldNames()[4:]],
    )
    customers = spark.range(1000).select(
        F.col("id").cast("string").alias("customer_id"),
        F.col("id").cast("string").alias("customer_unique_id"),
        F.lit("0").alias("customer_zip_code_prefix"),
        F.lit("c").alias("customer_city"),
        F.lit("s").alias("customer_state"),
    ).unionByName(
        spark.createDataFrame([("hot", "HOT", "0", "c", "s")], schemas.CUSTOMERS)
    )
    payments = spark.createDataFrame([], schemas.PAYMENTS)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        ow = detail.order_wide(orders, customers, payments).select(
            "order_id", "customer_unique_id"
        )
        collected = ow.collect()  # runs this frame's own (adaptive) plan
        plan = ow._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    counts: dict = {}
    for r in collected:
        counts[r[1]] = counts.get(r[1], 0) + 1
    assert sum(counts.values()) == n
    assert counts["HOT"] == n // 3
    assert "isSkewJoin=true" in plan or "skew=true" in plan, plan
    # daily stats over the same skewed data stay exact
    daily = summary.daily_order_stats(detail.order_wide(orders, customers, payments))
    assert daily.agg(F.sum("total_orders")).first()[0] == n
