"""Reading the given tables and cutting lineage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.session import drop_scratch, new_scratch_dir, write_scratch_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


#: Spark deletes the shuffle files of a query when it ends.
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffles of queries that begin inside go when the query ends.  Else they
    stay until the driver happens to collect its garbage, and pile up under the
    tables that are written next.  A session that sets this itself is left alone;
    otherwise the setting is taken back."""
    if spark.conf.get(CLEANUP_KEY, None) is not None:
        yield
        return
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP_KEY)


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared folder and read again: work after it does
    not repeat it, and a lost executor costs only the work after it."""
    with shuffles_dropped(df.sparkSession):
        return write_scratch_table(df, tag)


def stored(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """As :func:`written`, with the folder, for tables that are dropped again
    as soon as the next one is written (see :func:`dropped`)."""
    folder = new_scratch_dir(df.sparkSession, tag)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder), folder


def dropped(spark: SparkSession, *folders: str) -> None:
    for folder in folders:
        drop_scratch(spark, folder)


def free_names(taken: list[str], *wanted: str) -> list[str]:
    """Column names like the wanted ones that are not taken (Spark's names do not
    tell upper from lower case)."""
    used, out = {c.lower() for c in taken}, []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def row_key(id_column: str = "doc_id", text_column: str = "text"):
    """Identifies a row by id and content, so that repeated rows, or two texts
    under one id, never multiply in a join back to the documents."""
    return F.xxhash64(F.col(id_column), F.coalesce(F.col(text_column), F.lit("")))


__all__ = [
    "documents", "dropped", "free_names", "new_scratch_dir", "row_key", "shuffles_dropped", "stored", "table", "written"
]
