"""The whole batch job: raw CSV -> source -> detail -> summary -> serving/KPI.

Every layer is written as Parquet and the next layer reads the written copy.
That cuts lineage (a lost executor only re-runs work since the last written
layer), lets later layers prune columns and date partitions, and lets the
detail tables feed several summaries without being recomputed.  The run can be
started again after a failure, and publishes all its layers at once.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martlake.operators import detail, kpis, serving, summary
from martlake.operators.customer_days import customer_days, daily_from_customer_days
from martlake.plans.runs import Run
from martlake.schemas import SOURCE_FILES, TIMESTAMP_WRITE_FORMAT
from martlake.sinks.files import write_layer
from martlake.sources.files import ingest

DETAIL_PARTITION = "order_purchase_date"
#: Summary and serving tables, handed to the caller's ``publish``.
PUBLISHED = (
    "daily_order_stats", "category_stats", "category_review_scores", "top_categories", "gmv_trend", "kpi_summary",
)


#: Rows of a compressed raw file, which one task reads.
ROWS_PER_FILE = 1_000_000


def write_source_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Write a table in the raw CSV form ``read_source_csv`` accepts.  With a
    ``compression`` (``gzip``) files hold at most ``ROWS_PER_FILE`` rows, since such
    a file cannot be split; ``read_records_csv`` reads plain files only."""
    writer = df.write.mode("overwrite")
    if compression is not None:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", ROWS_PER_FILE)
    (
        writer
        .option("header", True)
        .option("escape", '"')
        .option("timestampNTZFormat", TIMESTAMP_WRITE_FORMAT)
        .csv(path)
    )


def build_warehouse(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    *,
    as_of: _dt.date | None = None,
    top_k: int = 10,
    publish: Callable[[str, str], None] | None = None,
) -> dict[str, str]:
    """Run every layer; returns the path of each written table.

    Layers lie in a folder of the run (see ``plans.runs``): a run that broke off
    goes on behind its last finished layer when it is started again with the same
    input, and the layers of earlier runs stay as they are.  When all layers are
    finished, readers (``runs.read_published``) are switched to them at once.
    ``publish`` is called then with the name and path of each summary and serving
    table."""
    load_time = F.current_timestamp()
    raw = raw_dir.rstrip("/")
    inputs = [f"{raw}/{file_name}" for file_name in SOURCE_FILES.values()]
    run = Run(spark, out_dir, inputs, {"as_of": as_of, "top_k": top_k})

    src: dict[str, DataFrame] = {}
    for table, file_name in SOURCE_FILES.items():
        counted = Observation(f"ingest_{table}")
        read = run.layer(f"ods_{table}", lambda path, t=table, f=file_name, c=counted: ingest(
            spark, t, f"{raw}/{f}", path, load_time=load_time, observation=c
        ))
        src[table] = read.drop("etl_timestamp")

    def table(name: str, df: Callable[[], DataFrame], **how) -> DataFrame:
        return run.layer(name, lambda path: write_layer(df(), path, **how))

    ow = table("order_wide", lambda: detail.order_wide(
        src["orders"], src["customers"], src["payments"], items=src["order_items"], load_date=F.current_date(),
    ), partition_by=DETAIL_PARTITION)
    iw = table("order_item_wide", lambda: detail.order_item_wide(
        src["order_items"], src["products"], load_time=load_time
    ))
    days = table("customer_days", lambda: customer_days(ow))
    daily = table("daily_order_stats", lambda: daily_from_customer_days(days))
    cats = table("category_stats", lambda: summary.category_stats(ow, iw))
    table("category_review_scores", lambda: summary.category_review_scores(ow, iw, src["reviews"]))
    table("top_categories", lambda: serving.top_categories(cats, top_k))
    table("gmv_trend", lambda: serving.gmv_trend(daily))

    def values() -> DataFrame:
        if as_of is None:
            return kpis.kpi_values_fused(src["orders"], days, src["reviews"])
        return kpis.kpi_values(src["orders"], ow, daily, src["reviews"], as_of=as_of)

    table("kpi_summary", lambda: kpis.refresh_metrics(kpis.metric_catalog(spark), values()))
    run.publish()
    if publish is not None:
        for name in PUBLISHED:
            publish(name, run.layers[name])
    return dict(run.layers)
