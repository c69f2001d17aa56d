"""Session-level helpers: the shared scratch folder and the settings we run with.

Library functions never create a session or change its settings; callers
(tests, ``bench.py``, the cluster's spark-defaults) do that.  (The corpus
operators set one, while they write a scratch table: ``llm/tables.py``.)
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Settings the plans are designed for.  AQE re-plans joins from runtime sizes
# (a side is broadcast only after its shuffle output is measured), splits
# skewed join partitions, and coalesces small shuffle partitions.
RECOMMENDED_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    The session's ``spark.checkpoint.dir`` (on a cluster a shared file
    system), else the folder the caller gave to ``setCheckpointDir``.  With
    neither, a clear error: a machine-local folder would not be seen by other
    executors.  The caller's settings are never changed.
    """
    root = (
        spark.conf.get(CHECKPOINT_KEY, None)
        or spark.sparkContext.getConf().get(CHECKPOINT_KEY, None)
        or spark.sparkContext.getCheckpointDir()
    )
    if not root:
        raise RuntimeError(
            f"set {CHECKPOINT_KEY} (or call setCheckpointDir) to a folder that the driver "
            "and all executors share; intermediate tables are written there"
        )
    return root.rstrip("/")


def new_scratch_dir(spark: SparkSession, tag: str) -> str:
    """A fresh, unique path under the shared scratch root (not created yet)."""
    return f"{scratch_root(spark)}/martlake/{tag}-{uuid.uuid4().hex}"


def write_scratch_table(df, tag: str):
    """Write ``df`` as Parquet under the shared scratch root and return the
    written copy.

    Used where one intermediate feeds several branches of a plan: Spark would
    otherwise recompute it per branch.  The written copy also cuts lineage, so
    a lost executor re-runs only the work after it.
    """
    path = new_scratch_dir(df.sparkSession, tag)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def drop_scratch(spark: SparkSession, path: str) -> bool:
    """Delete a folder made by :func:`new_scratch_dir`; False if it is not
    there.  Refuses paths outside the shared scratch root."""
    if not path.startswith(f"{scratch_root(spark)}/martlake/"):
        raise ValueError(f"not a scratch folder of this session: {path}")
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(jpath, True))
