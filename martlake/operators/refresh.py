"""Incremental refresh of the daily statistics.

A store holds the order detail by day, the table of customers and days, the first
day of every customer (by customer), customer numbers, daily bitmaps and the daily
statistics.  A batch of orders changes

* its days: their customers, bitmaps and statistics are computed again;
* the first day of its customers, where an order came late: the day on which such a
  customer counted as new so far is touched as well.

Other days are neither computed nor written: folders of days (or of months, where days
are small) are replaced one by one, and of the table by customer only the folders of the
batch's customers.  What a
batch adds lies in folders of its own, so a refresh that broke off is simply run again
with the same batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.operators.customer_days import SUMS, customer_days, daily_from_customer_days
from martlake.operators.distinct_counts import CUSTOMER, daily_bitmaps, numbered
from martlake.session import write_scratch_table
from martlake.sinks.files import write_layer
from martlake.sinks.keyed import read_keyed, upsert_keyed, write_keyed

DAY, FOLDER = "stat_date", "part"
#: Patterns of folder names: a folder a day, or a month.
DAYS, MONTHS = "'p'yyyy-MM-dd", "'p'yyyy-MM"


@dataclass(frozen=True)
class DayStore:
    """The folders of a store under ``root``.  ``buckets`` is the number of folders
    of tables by customer, ``folders`` the pattern of those by day; neither changes in
    a store's life."""

    spark: SparkSession
    root: str
    buckets: int = 16
    folders: str = DAYS

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def first_days(self) -> DataFrame:
        return read_keyed(self.spark, self.path("first_days"))

    def numbers(self) -> DataFrame:
        return self.read("numbers").drop("batch")


def _valid(order_wide: DataFrame) -> DataFrame:
    rows = order_wide.filter((F.col("is_valid") == 1) & F.col("order_purchase_date").isNotNull())
    return rows.withColumnRenamed("order_purchase_date", DAY)


def _days_of(orders: DataFrame) -> DataFrame:
    days = customer_days(orders.drop(FOLDER).withColumnRenamed(DAY, "order_purchase_date"))
    return days.select(CUSTOMER, DAY, "day_orders", *SUMS)


def _firsts(days: DataFrame) -> DataFrame:
    return days.filter(F.col(CUSTOMER).isNotNull()).groupBy(CUSTOMER).agg(F.min(DAY).alias("first_date"))


def _write(store: DayStore, path: str, df: DataFrame) -> None:
    """Replace the folders of the days in ``df``."""
    df = df.withColumn(FOLDER, F.date_format(DAY, store.folders))
    write_layer(df, path, partition_by=FOLDER, dynamic_overwrite=True)


def build(store: DayStore, order_wide: DataFrame, batch: str = "first") -> None:
    """Fill an empty store with a first batch, which has a valid order."""
    _write(store, f"{store.path('orders')}/batch={batch}", _valid(order_wide))
    _write(store, store.path("customer_days"), _days_of(store.read("orders")))
    days = store.read("customer_days")
    write_keyed(_firsts(days), store.path("first_days"), [CUSTOMER], store.buckets)
    numbered(days).write.mode("overwrite").parquet(f"{store.path('numbers')}/batch={batch}")
    _write(store, store.path("bitmaps"), daily_bitmaps(days, store.numbers()))
    _write(store, store.path("daily"), daily_from_customer_days(days, store.first_days()))


def refresh(store: DayStore, order_wide: DataFrame, batch: str) -> tuple[list[str], list[str]]:
    """Add a batch of orders that the store does not have yet; ``batch`` names it.
    Returns the folders of the batch's days, and the other folders, with days whose
    new customers changed.

    Lists of folders are bounded by the calendar."""
    spark = store.spark
    mine = write_scratch_table(_valid(order_wide).withColumn(FOLDER, F.date_format(DAY, store.folders)), "batch")
    touched = sorted(r[0] for r in mine.select(FOLDER).distinct().collect())
    if not touched:
        return [], []
    _write(store, f"{store.path('orders')}/batch={batch}", mine)
    in_folders = F.col(FOLDER).isin(touched)
    _write(store, store.path("customer_days"), _days_of(store.read("orders").filter(in_folders)))
    days = store.read("customer_days")

    added = numbered(mine, store.read("numbers").filter(F.col("batch") != batch).drop("batch"))
    added.write.mode("overwrite").parquet(f"{store.path('numbers')}/batch={batch}")
    _write(store, store.path("bitmaps"), daily_bitmaps(days.filter(in_folders), store.numbers()))

    moves = f"{store.path('moves')}/batch={batch}"

    def keep(changes: DataFrame) -> None:  # kept before it is lost, also if this is a second attempt
        moved = changes.filter("was.first_date <> now.first_date").select(
            F.date_format("was.first_date", store.folders).alias(FOLDER)
        )
        moved.distinct().write.mode("append").parquet(moves)

    earlier = {"first_date": F.least("old.first_date", "new.first_date")}
    upsert_keyed(spark, store.path("first_days"), _firsts(mine), [CUSTOMER], store.buckets, earlier, keep)
    others = sorted({r[0] for r in spark.read.parquet(moves).distinct().collect()} - set(touched))

    again = days.filter(F.col(FOLDER).isin(touched + others)).drop(FOLDER)
    _write(store, store.path("daily"), daily_from_customer_days(again, store.first_days()))
    return touched, others
