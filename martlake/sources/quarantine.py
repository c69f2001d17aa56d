"""Raw CSV split into accepted rows and rejects, in one pass over the file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.schemas import SOURCE_SCHEMAS
from martlake.sources.files import COLUMN_ALIASES, CORRUPT, read_source_csv

#: In ``failed``: the row has too many or too few fields.
WHOLE_ROW = "_row"


def checked_rows(spark: SparkSession, table: str, path: str) -> DataFrame:
    """The typed columns of a raw table, and for rows with a field that does not parse
    ``failed`` (the names of those columns, or ``WHOLE_ROW``) and ``raw`` (the row's
    text); both are NULL in good rows.

    Only the text of bad rows is taken apart a second time, as plain text fields: a
    column failed if its text is there and its value is not."""
    typed = read_source_csv(spark, table, path, keep_corrupt=True)
    header = spark.read.option("header", True).option("escape", '"').csv(path).columns
    plain = [COLUMN_ALIASES.get(h.strip().lower(), h.strip().lower()) for h in header]
    fields = F.from_csv(CORRUPT, ", ".join(f"f{i} string" for i in range(len(header))), {"escape": '"'})
    names = [c for c in SOURCE_SCHEMAS[table].fieldNames()]
    failed = F.array_compact(F.array(*(
        F.when(F.col("_fields")[f"f{plain.index(c)}"].isNotNull() & F.col(c).isNull(), F.lit(c)) for c in names
    )))
    rows = typed.withColumn("_fields", F.when(F.col(CORRUPT).isNotNull(), fields))
    failed = F.when(F.size(failed) > 0, failed).otherwise(F.array(F.lit(WHOLE_ROW)))
    return rows.select(
        *names, F.when(F.col(CORRUPT).isNotNull(), failed).alias("failed"), F.col(CORRUPT).alias("raw")
    )


def quarantine(spark: SparkSession, table: str, csv_path: str, out_path: str) -> tuple[DataFrame, DataFrame]:
    """Write a raw table as accepted rows and rejects, in two folders of ``out_path``;
    returns both: the accepted rows typed, the rejects with what could be read of
    them, ``failed`` and ``raw``.  Every row of the file is in one of the two."""
    rows = checked_rows(spark, table, csv_path).withColumn("accepted", F.col("raw").isNull())
    rows.write.mode("overwrite").partitionBy("accepted").parquet(out_path)
    back = spark.read.schema(rows.schema).parquet(out_path)
    good = back.filter("accepted").drop("accepted", "failed", "raw")
    return good, back.filter("NOT accepted").drop("accepted")
