"""Keyed tables that are updated by rewriting only the folders an update touches.

A table lies in ``buckets`` folders (column ``BUCKET``) by a hash of its key.  An
update reads the folders of its own keys, merges, writes the result beside the
table, and then replaces just those folders.  A hot key does not exist here: a table
has one row per key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.session import drop_scratch, new_scratch_dir

BUCKET = "key_bucket"


def key_bucket(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def write_keyed(df: DataFrame, path: str, key: Sequence[str], buckets: int) -> None:
    """Write a new keyed table (one row per key) of ``buckets`` folders."""
    df = df.withColumn(BUCKET, key_bucket(key, buckets))
    df.repartition(buckets, BUCKET).write.partitionBy(BUCKET).parquet(path)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET)


def upsert_keyed(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    key: Sequence[str],
    buckets: int,
    merge: dict[str, Column] | None = None,
    before_replace: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """Insert or update the rows of ``updates`` (one row per key, the table's
    columns); returns the touched rows as they were before (null for new keys) and
    are now: the key, ``was`` and ``now`` as structs.  The returned table is a written
    one; drop it with ``session.drop_scratch`` or leave it.

    ``merge`` gives columns of the new row from ``old.<column>`` (null for a new
    key) and ``new.<column>``; others take the update's value.  Folders of keys that
    do not occur in ``updates`` are neither read nor written.  The merged rows are
    complete before the first folder is replaced; ``before_replace`` is called with
    the returned table in between (to keep what only the old rows tell).
    """
    columns = [c for c in updates.columns if c not in key]
    staged = new_scratch_dir(spark, "updates")
    updates.withColumn(BUCKET, key_bucket(key, buckets)).repartition(BUCKET).write.parquet(staged)
    staged_rows = spark.read.parquet(staged)
    # at most one number per folder of the table
    touched = [r[0] for r in staged_rows.select(BUCKET).distinct().collect()]
    table = spark.read.parquet(path)
    old = table.filter(F.col(BUCKET).isin(touched)).alias("old")
    new = staged_rows.alias("new")
    same = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in key] + [F.col(f"old.{BUCKET}") == F.col(f"new.{BUCKET}")]
    on = same[0]
    for c in same[1:]:
        on = on & c
    given = F.col(f"new.{BUCKET}").isNotNull()
    merge = merge or {}
    value = {
        c: F.when(given, merge.get(c, F.col(f"new.{c}"))).otherwise(F.col(f"old.{c}")).cast(table.schema[c].dataType)
        for c in columns
    }
    joined = new.join(old, on, "full_outer").select(
        *(F.coalesce(f"new.{k}", f"old.{k}").alias(k) for k in key),
        F.when(F.col(f"old.{BUCKET}").isNotNull(), F.struct(*(F.col(f"old.{c}").alias(c) for c in columns))).alias("was"),
        F.struct(*(value[c].alias(c) for c in columns)).alias("now"),
        given.alias("given"),
        F.coalesce(f"new.{BUCKET}", f"old.{BUCKET}").alias(BUCKET),
    )
    merged = new_scratch_dir(spark, "merged")
    joined.write.parquet(merged)
    rows = spark.read.parquet(merged)
    changes = rows.filter("given").select(*key, "was", "now")
    if before_replace is not None:
        before_replace(changes)
    (
        rows.select(*key, *(F.col(f"now.{c}").alias(c) for c in columns), BUCKET).repartition(BUCKET)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    )
    drop_scratch(spark, staged)
    return changes
