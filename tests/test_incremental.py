"""Customer days, keyed tables, bitmaps and the incremental refresh."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martlake.functions.numbers import decimals_to_double
from martlake.operators import customer_days as cd
from martlake.operators import distinct_counts, kpis, refresh, summary
from martlake.operators.detail import order_wide
from martlake.session import new_scratch_dir, write_scratch_table
from martlake.sinks.keyed import BUCKET, read_keyed, upsert_keyed, write_keyed
from martlake.sources.fixtures import fixture_tables
from tests.conftest import SF001

ORDERS = (
    "order_id string, customer_unique_id string, order_purchase_date date, order_status string, "
    "total_payment_value decimal(12,2), delivery_days int, is_late_delivery int, is_valid int"
)
D = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n)


def _orders(spark, rows):
    return spark.createDataFrame(
        [(o, c, None if n is None else D(n), s, None if m is None else Decimal(m), dd, late, v) for o, c, n, s, m, dd, late, v in rows],
        ORDERS,
    )


#: Repeated ids, one over two days and two customers, unknown customers, invalid rows.
ROWS = [
    ("a", "u", 0, "delivered", "1.50", 3, 0, 1), ("b", "u", 0, "delivered", "2.00", 120, 1, 1),
    ("b", "u", 5, "canceled", "4.00", None, None, 1), ("c", None, 5, "shipped", None, None, None, 1),
    ("c", "w", 5, "shipped", "7.00", None, None, 1), ("d", None, 40, "unavailable", "1.00", 0, 0, 1),
    ("e", "w", 41, None, "3.00", 9, 1, 1), ("f", "z", 42, "delivered", "9.00", 2, 0, 0), ("a", "u", 0, "delivered", "1.50", 3, 0, 1),
]


def _rows(df):
    return sorted(map(tuple, decimals_to_double(df.select(*sorted(df.columns))).collect()), key=repr)


def test_daily_table_and_fused_kpis_with_repeated_ids(spark):
    ow = _orders(spark, ROWS)
    days = write_scratch_table(cd.customer_days(ow), "days")
    assert _rows(cd.daily_from_customer_days(days)) == _rows(summary.daily_order_stats(ow))
    source = ow.select("order_id")
    reviews = spark.createDataFrame([(5,), (3,), (None,)], "review_score int")
    daily = summary.daily_order_stats(ow)
    assert _rows(kpis.kpi_values_fused(source, days, reviews)) == _rows(kpis.kpi_values(source, ow, daily, reviews))


def test_fused_kpis_of_empty_tables(spark):
    ow = _orders(spark, []).limit(0)
    days = cd.customer_days(ow)
    reviews = spark.createDataFrame([], "review_score int")
    got = {r["metric_name"]: r["metric_value"] for r in kpis.kpi_values_fused(ow, days, reviews).collect()}
    assert len(got) == 11 and set(got.values()) == {0.0}


def test_fused_kpis_read_the_orders_once(spark):
    t = fixture_tables(spark, SF001)
    ow = write_scratch_table(order_wide(t.orders, t.customers, t.payments), "ow")
    plan = cd.customer_days(ow)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1
    days = write_scratch_table(cd.customer_days(ow), "days")
    fused = kpis.kpi_values_fused(t.orders, days, t.reviews)
    text = fused._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in text  # payments are not read again


def _stamps(path):
    out = {}
    for folder, _, names in os.walk(path.removeprefix("file:")):
        for n in names:
            if n.endswith(".parquet"):
                f = os.path.join(folder, n)
                out[f] = os.stat(f).st_mtime_ns
    return out


def _folder_of(file):
    return os.path.basename(os.path.dirname(file))


def test_refresh_equals_full_build_and_leaves_other_days(spark):
    rows = [(f"o{i}", None if i % 11 == 0 else f"u{i % 40}", (i * 7) % 60, "delivered", "1.25", 4, 0, 1) for i in range(400)]
    # u3 orders first on day 1, by a late order; u99 is new in the batch
    late = [("x1", "u3", 1, "shipped", "2.00", None, None, 1), ("x2", "u99", 58, "canceled", "3.00", None, None, 1),
            ("x3", None, 61, "shipped", None, None, None, 1), ("x4", "u3", 1, "shipped", "2.00", None, None, 0)]
    first = _orders(spark, [r for r in rows if not (r[1] == "u3" and r[2] < 9)])
    store = refresh.DayStore(spark, new_scratch_dir(spark, "store"), buckets=8)
    refresh.build(store, first)
    before = _stamps(store.root)
    old_first = store.first_days().filter("customer_unique_id = 'u3'").first()["first_date"]
    touched, others = refresh.refresh(store, _orders(spark, late), "late")
    folder = lambda d: f"p{d.isoformat()}"
    assert touched == [folder(D(n)) for n in (1, 58, 61)] and others == [folder(old_first)]
    daily = store.read("daily").drop("part")
    full = first.union(_orders(spark, late))
    assert _rows(daily) == _rows(summary.daily_order_stats(full))
    after = _stamps(store.root)
    kept = {f for f in before if after.get(f) == before[f]}
    for name, days in (("daily", touched + others), ("customer_days", touched), ("bitmaps", touched)):
        gone = {_folder_of(f) for f in before if f"/{name}/" in f and f not in kept}
        assert gone <= {f"part={d}" for d in days}, name
    gone = {_folder_of(f) for f in before if "/first_days/" in f and f not in kept}
    assert 1 <= len(gone) <= 2  # the folders of u3 and u99
    assert all(f in kept for f in before if "/orders/" in f)

    # the same batch once more, as after a failure: nothing changes
    assert refresh.refresh(store, _orders(spark, late), "late") == (touched, others)
    assert _rows(store.read("daily").drop("part")) == _rows(summary.daily_order_stats(full))
    assert refresh.refresh(store, first.limit(0), "none") == ([], [])

    # counts of any range from the bitmaps alone
    want = full.filter("is_valid = 1").filter(F.col("order_purchase_date").between(D(3), D(33)))
    n = want.select(F.count_distinct("customer_unique_id")).first()[0]
    some = store.read("bitmaps").filter(F.col("stat_date").between(D(3), D(33)))
    assert distinct_counts.customers_in(some, F.lit("range")).first()["total_customers"] == n
    numbers = sorted(r["number"] for r in store.numbers().collect())
    assert numbers == list(range(1, len(numbers) + 1))


def test_refresh_that_breaks_off_is_finished_by_the_next_attempt(spark, monkeypatch):
    rows = [(f"o{i}", f"u{i % 5}", 10 + i % 20, "delivered", "1.00", 1, 0, 1) for i in range(60)]
    late = [("x", "u1", 2, "delivered", "1.00", 1, 0, 1)]
    store = refresh.DayStore(spark, new_scratch_dir(spark, "store"), buckets=4)
    refresh.build(store, _orders(spark, rows))

    def broken(*_args):
        raise RuntimeError("lost")

    monkeypatch.setattr(refresh, "daily_from_customer_days", broken)
    with pytest.raises(RuntimeError):
        refresh.refresh(store, _orders(spark, late), "late")
    monkeypatch.undo()
    assert refresh.refresh(store, _orders(spark, late), "late") == (["p2020-01-03"], ["p2020-01-12"])
    assert _rows(store.read("daily").drop("part")) == _rows(summary.daily_order_stats(_orders(spark, rows + late)))


def test_upsert_rewrites_only_touched_folders(spark):
    path = new_scratch_dir(spark, "keyed")
    base = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"), F.lit(None).cast("string").alias("w"))
    write_keyed(base, path, ["k"], 16)
    before = _stamps(path)
    updates = spark.createDataFrame([("7", 70, "x"), ("new", 1, None), (None, 5, "n")], "k string, v long, w string")
    changes = upsert_keyed(spark, path, updates, ["k"], 16, {"v": F.coalesce("old.v", F.lit(0)) + F.col("new.v")})
    assert sorted(((r["k"], r["was"] and r["was"]["v"], r["now"]["v"]) for r in changes.collect()), key=repr) == sorted(
        [("7", 7, 77), ("new", None, 1), (None, None, 5)], key=repr
    )
    rows = {r["k"]: (r["v"], r["w"]) for r in read_keyed(spark, path).collect()}
    assert len(rows) == 1002 and rows["7"] == (77, "x") and rows["new"] == (1, None) and rows["8"] == (8, None)
    after = _stamps(path)
    gone = {_folder_of(f) for f in before if after.get(f) != before[f]}
    assert 1 <= len(gone) <= 3 and all(g.startswith(f"{BUCKET}=") for g in gone)
    # updates alone, of a key that is there: its value
    upsert_keyed(spark, path, updates.filter("k = '7'"), ["k"], 16)
    assert {r["k"]: r["v"] for r in read_keyed(spark, path).collect()}["7"] == 70
    assert upsert_keyed(spark, path, updates.limit(0), ["k"], 16).count() == 0
    assert read_keyed(spark, path).count() == 1002


def test_numbers_go_on_after_the_known_ones(spark):
    ids = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "customer_unique_id string")
    known = distinct_counts.numbered(ids)
    more = distinct_counts.numbered(ids.union(spark.createDataFrame([("c",), ("d",)], ids.schema)), known)
    assert sorted(r["number"] for r in known.collect()) == [1, 2]
    assert sorted((r["customer_unique_id"], r["number"]) for r in more.collect()) in ([("c", 3), ("d", 4)], [("c", 4), ("d", 3)])
