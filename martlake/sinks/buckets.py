"""Tables bucketed by a key: joins and aggregates on it need no shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.session import drop_scratch, new_scratch_dir


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Write ``df`` as a table of ``buckets`` files, sorted and bucketed by ``key``;
    returns the table.

    Two tables with equal bucket numbers lie together by key, and a join or a
    ``groupBy`` that begins with the key reads them without an exchange.  Rows are
    dealt to tasks by the same hash first, so each bucket is one file.  Rows
    without a key are left out: they match nothing, and would all lie in one
    bucket.  Give a table with few rows a key (aggregate a fact table by it
    first): a bucket is read by one task.  ``name`` is a prefix, the table's own
    name is unique; its folder is ``path`` or a new one in the shared scratch folder.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    (
        df.filter(F.col(key).isNotNull()).repartition(buckets, key).write
        .option("path", path or new_scratch_dir(spark, name))
        .bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    )
    return spark.table(table).alias(table)


def drop_bucketed(spark: SparkSession, table: str) -> None:
    """Forget a table of :func:`write_bucketed`; its files go too if they lie in
    the shared scratch folder."""
    details = spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Location'").first()
    spark.sql(f"DROP TABLE {table}")
    if details is not None:
        try:
            drop_scratch(spark, details["data_type"])
        except ValueError:  # a folder of the caller's
            return
