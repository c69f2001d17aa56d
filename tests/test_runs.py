"""Restartable runs, publishing, co-located layers and pruning by folder names."""

from __future__ import annotations

import datetime as dt
import re

import pytest

from martlake.operators import colocated, kpis
from martlake.plans import warehouse
from martlake.plans.registry import QUERIES
from martlake.plans.runs import Run, latest, read_published
from martlake.plans.warehouse import build_warehouse, write_source_csv
from martlake.schemas import SOURCE_FILES
from martlake.session import new_scratch_dir
from martlake.sinks.buckets import drop_bucketed, write_bucketed
from martlake.sinks.files import write_layer
from martlake.sources.files import partition_values
from martlake.sources.fixtures import BUILDERS, fixture_tables
from tests.conftest import SF001


def _raw(spark, root):
    for table, name in SOURCE_FILES.items():
        write_source_csv(BUILDERS[table](spark, SF001), f"{root}/raw/{name}")
    return f"{root}/raw"


def test_a_broken_run_goes_on_and_readers_see_whole_runs(spark, monkeypatch):
    root = new_scratch_dir(spark, "runs")
    raw, out = _raw(spark, root), f"{root}/out"
    with pytest.raises(LookupError):
        read_published(spark, out, "kpi_summary")

    written = []
    real = Run.layer

    def stops(limit):
        def layer(self, name, write):
            if len(self.written) >= limit:
                raise RuntimeError("stopped")
            df = real(self, name, write)
            written.extend(n for n in self.written if n not in written)
            return df

        return layer

    for _ in range(3):  # four layers an attempt, then it breaks off
        monkeypatch.setattr(Run, "layer", stops(4))
        with pytest.raises(RuntimeError):
            build_warehouse(spark, raw, out)
        assert latest(spark, out) is None
    monkeypatch.setattr(Run, "layer", real)
    runs = []
    publish = Run.publish
    monkeypatch.setattr(Run, "publish", lambda self: (runs.append(self), publish(self))[1])
    paths = build_warehouse(spark, raw, out)
    assert len(runs[0].skipped) == 12 and set(runs[0].skipped) == set(written) and len(runs[0].written) == 3
    first = latest(spark, out)
    assert first["number"] == 1 and first["layers"] == paths
    want = sorted(map(tuple, QUERIES["kpi_summary"](spark, SF001).collect()))
    assert sorted(map(tuple, read_published(spark, out, "kpi_summary").collect())) == want

    # the same input: nothing is written, the publication stays
    build_warehouse(spark, raw, out)
    assert runs[1].written == [] and latest(spark, out) == first

    # other input: another run; readers see the old one until it is whole
    write_source_csv(BUILDERS["orders"](spark, SF001).filter("order_status = 'delivered'"), f"{raw}/{SOURCE_FILES['orders']}")
    monkeypatch.setattr(Run, "layer", stops(14))
    with pytest.raises(RuntimeError):
        build_warehouse(spark, raw, out)
    assert latest(spark, out) == first
    assert sorted(map(tuple, read_published(spark, out, "kpi_summary").collect())) == want
    monkeypatch.setattr(Run, "layer", real)
    build_warehouse(spark, raw, out, as_of=dt.date(1998, 1, 1))  # another parameter: its own run as well
    last = latest(spark, out)
    assert last["number"] == 2 and last["run"] != first["run"]
    rates = {r["metric_name"]: r["metric_value"] for r in read_published(spark, out, "kpi_summary").collect()}
    assert rates["Order Completion Rate"] == 100.0


def test_publications_never_overwrite_each_other(spark):
    out = new_scratch_dir(spark, "published")
    run = Run(spark, out, [])
    spark.range(1).write.parquet(run.folder("x"))
    assert run.layer("x", None).count() == 1 and run.skipped == ["x"]
    assert run.publish() == 1 == run.publish()
    assert not run.files.write_new(f"{out}/published/{1:010d}.json", "{}")
    other = Run(spark, out, [], {"p": 1})
    other.layer("x", lambda path: spark.range(2).write.parquet(path))
    assert other.publish() == 2 and read_published(spark, out, "x").count() == 2


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, old)


def test_order_layers_join_without_an_exchange(spark, no_broadcast):
    t = fixture_tables(spark, SF001)
    from martlake.operators.detail import order_item_wide, order_wide

    ow = order_wide(t.orders, t.customers, t.payments)
    layers = colocated.write_order_layers(ow, t.order_items, order_item_wide(t.order_items, t.products), t.reviews, 4)
    assert "Exchange" not in _plan(colocated.order_wide_with_items(layers))
    for df in (colocated.category_stats(layers), colocated.category_review_scores(layers)):
        plan = _plan(df)
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning(order_id" not in plan
        assert "Exchange hashpartitioning(stat_month" in plan


def test_bucketed_tables_leave_out_null_keys_and_can_be_dropped(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", 3), (None, 4)], "k string, v int")
    table = write_bucketed(df, "small", "k", 3)
    assert sorted(r["v"] for r in table.collect()) == [1, 3]
    name = [r.name for r in spark.catalog.listTables() if r.name.startswith("small_")][0]
    drop_bucketed(spark, name)
    assert not spark.catalog.tableExists(name)


def test_last_days_read_only_their_folders(spark):
    path = new_scratch_dir(spark, "layout")
    t = fixture_tables(spark, SF001)
    from martlake.operators.detail import order_wide

    write_layer(order_wide(t.orders, t.customers, t.payments), path, partition_by="order_purchase_date")
    days = sorted(v for v in partition_values(spark, path, "order_purchase_date"))
    assert len(days) > 500
    rate = kpis.repurchase_rate_30d_of_layout(spark, path, "order_purchase_date")
    last = dt.date.fromisoformat(days[-1])
    inside = {d for d in days if last - dt.timedelta(days=30) < dt.date.fromisoformat(d) <= last}
    from_day = last - dt.timedelta(days=30)
    plan = _plan(rate)  # literal bounds, so folders are chosen when the scan is planned
    assert re.search(rf"PartitionFilters: \[[^\]]*order_purchase_date#\d+ > {from_day}", plan), plan
    assert 1 <= len(inside) <= 31
    assert [tuple(r) for r in rate.collect()] == [tuple(r) for r in QUERIES["kpi_repurchase_rate_30d"](spark, SF001).collect()]
    empty = new_scratch_dir(spark, "layout")
    write_layer(order_wide(t.orders, t.customers, t.payments).limit(0), empty, partition_by="order_purchase_date")
    assert warehouse.DETAIL_PARTITION == "order_purchase_date"
    spark.createDataFrame([("x y", 1), (None, 2), ("a/b=c", 3)], "p string, v int").write.partitionBy("p").parquet(empty + "-p")
    assert sorted(partition_values(spark, empty + "-p", "p"), key=str) == [None, "a/b=c", "x y"]
