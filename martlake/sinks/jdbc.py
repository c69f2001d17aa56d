"""JDBC sink for serving tables.

Executors write their partitions directly over JDBC (no driver-side copy).
``overwrite`` with ``truncate`` keeps the target table's DDL (keys, types);
``append`` adds rows.  Credentials are passed in, never stored in code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def jdbc_write_options(
    url: str,
    table: str,
    *,
    properties: dict[str, str] | None = None,
    batchsize: int = 1000,
    truncate: bool = True,
    num_partitions: int | None = None,
) -> dict[str, str]:
    opts = {
        "url": url,
        "dbtable": table,
        "batchsize": str(batchsize),
        "truncate": "true" if truncate else "false",
    }
    if num_partitions:
        # caps concurrent connections; Spark coalesces to this many writers
        opts["numPartitions"] = str(num_partitions)
    opts.update(properties or {})
    return opts


def publish_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    *,
    mode: str = "overwrite",
    properties: dict[str, str] | None = None,
    batchsize: int = 1000,
    truncate: bool = True,
    num_partitions: int | None = None,
) -> None:
    opts = jdbc_write_options(
        url,
        table,
        properties=properties,
        batchsize=batchsize,
        truncate=truncate,
        num_partitions=num_partitions,
    )
    df.write.format("jdbc").options(**opts).mode(mode).save()


def publish_layer(spark, parquet_path: str, url: str, table: str, **kwargs) -> None:
    """Publish a written Parquet layer to a SQL table (executors write; the
    rows never pass through the driver)."""
    publish_jdbc(spark.read.parquet(parquet_path), url, table, **kwargs)
