"""Previous-row values over an ordered table without a single-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_previous(
    df: DataFrame, order_col: str, value_col: str, bucket: Column, out_col: str
) -> DataFrame:
    """Add ``out_col`` = ``value_col`` of the row just before in ``order_col``
    order (like ``LAG(value) OVER (ORDER BY order_col)``; the first row gets NULL).

    A plain ``LAG`` over the whole table moves every row into one task.  Here
    the window is partitioned by a coarse ``bucket`` that rises with
    ``order_col`` (for a date: its year), so each task sees one bucket.  The
    first row of a bucket takes the last value of the previous non-empty
    bucket, found on a one-row-per-bucket table.  ``order_col`` must be unique.
    """
    b = df.withColumn("_bucket", bucket)
    w = Window.partitionBy("_bucket").orderBy(order_col)
    b = b.withColumn("_rn", F.row_number().over(w)).withColumn(
        "_prev_in_bucket", F.lag(value_col).over(w)
    )
    tails = b.groupBy("_bucket").agg(F.max_by(value_col, order_col).alias("_tail"))
    # One row per bucket (e.g. per year), so this window is tiny.
    carry = tails.select(
        "_bucket", F.lag("_tail").over(Window.orderBy("_bucket")).alias("_carry")
    )
    return (
        b.join(carry, "_bucket", "left")
        .withColumn(
            out_col,
            F.when(F.col("_rn") == 1, F.col("_carry")).otherwise(F.col("_prev_in_bucket")),
        )
        .drop("_bucket", "_rn", "_prev_in_bucket", "_carry")
    )
