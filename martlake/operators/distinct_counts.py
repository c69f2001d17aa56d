"""Distinct customers of any range of days, exactly, from daily bitmaps.

Customers get dense numbers; a day's customers are bitmaps over them, one row per
day and block of 32,768 numbers.  Bitmaps of days merge by OR, so that the count of a
month, a year or all time needs neither the orders nor the customers themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlake.session import write_scratch_table

CUSTOMER, NUMBER = "customer_unique_id", "number"


def numbered(ids: DataFrame, known: DataFrame | None = None, id_column: str = CUSTOMER) -> DataFrame:
    """(id, number) of the distinct ids that ``known`` lacks: dense numbers from 1,
    or after the last known one.

    Every task numbers its own rows; the tasks' counts (a row each) give where its
    numbers begin."""
    new = ids.select(id_column).filter(F.col(id_column).isNotNull()).distinct()
    last = F.lit(0).cast("long")
    if known is not None:
        new = new.join(known, id_column, "left_anti")
        last = F.coalesce(known.agg(F.max(NUMBER)).scalar(), F.lit(0).cast("long"))
    rows = write_scratch_table(new.withColumn("part", F.spark_partition_id()), "new-ids")
    counts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    # a row per task of the write
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("part", (F.coalesce(before, F.lit(0)) + last).alias("start"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(id_column))
    return rows.withColumn("place", place).join(F.broadcast(starts), "part").select(
        id_column, (F.col("start") + F.col("place")).alias(NUMBER)
    )


def daily_bitmaps(days: DataFrame, numbers: DataFrame) -> DataFrame:
    """(stat_date, block, bits): the known customers of each day; ``days`` has one
    row per customer and day."""
    rows = days.filter(F.col("stat_date").isNotNull()).select("stat_date", CUSTOMER).join(numbers, CUSTOMER)
    return rows.groupBy("stat_date", F.bitmap_bucket_number(NUMBER).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(NUMBER)).alias("bits")
    )


def customers_in(bitmaps: DataFrame, period: Column) -> DataFrame:
    """(period, total_customers): distinct customers of the days of each period."""
    merged = bitmaps.groupBy(period.alias("period"), "block").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy("period").agg(F.sum(F.bitmap_count("bits")).alias("total_customers"))


def customer_counts(bitmaps: DataFrame) -> DataFrame:
    """Distinct customers per month, per year, and of all time (``all``)."""
    day = F.col("stat_date")
    periods = F.array(F.date_format(day, "yyyy-MM"), F.date_format(day, "yyyy"), F.lit("all"))
    each = bitmaps.select("block", "bits", F.explode(periods).alias("p"))
    return customers_in(each, F.col("p"))
