"""CSV source tables and Parquet layers."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from martlake.schemas import (
    MULTILINE_TABLES,
    SOURCE_FILES,
    SOURCE_SCHEMAS,
    TIMESTAMP_FORMAT,
)
from martlake.sinks.files import LAYER_CODEC


CORRUPT = "_corrupt_record"

#: Folder name that stands for NULL in a partitioned layer (fixed value).
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"

#: Spellings of column names that raw files are known to have (fixed values).
COLUMN_ALIASES = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
}


def header_schema(header: list[str], table: str) -> tuple[StructType, dict[str, str]]:
    """The read schema in the file's own column order, and the file's name of
    each wanted column.  Unknown columns are read as text and left out; a
    missing or doubled column is an error."""
    wanted = {f.name: f for f in SOURCE_SCHEMAS[table].fields}
    fields, found = [], {}
    for name in header:
        plain = name.strip().lower()
        target = COLUMN_ALIASES.get(plain, plain)
        if target in found:
            raise ValueError(f"{table}: column {target} stands twice in the header {header}")
        if target in wanted:
            found[target] = name
        fields.append(StructField(name, wanted[target].dataType if target in wanted else StringType(), True))
    if missing := [c for c in wanted if c not in found]:
        raise ValueError(f"{table}: the header {header} lacks {missing}")
    return StructType([*fields, StructField(CORRUPT, StringType(), True)]), found


def read_source_csv(
    spark: SparkSession,
    table: str,
    path: str,
    *,
    infer_schema: bool = False,
    keep_corrupt: bool = False,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Read one raw marketplace table, its columns by the header's names.

    Default is the explicit schema: ids and zip codes stay text, money is
    exact, and unparseable timestamps / numbers become NULL (PERMISSIVE)
    instead of failing the job; ``keep_corrupt`` adds the raw text of such rows
    as ``_corrupt_record``.  Every file's header has to equal the first one's.
    ``infer_schema=True`` reads the schema-less way (one extra pass).

    Reviews hold quoted line breaks, so one review file is one task: raw
    reviews of any size must come as many files.
    """
    reader = (
        spark.read.option("header", True)
        .option("mode", "PERMISSIVE")
        .option("escape", '"')
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .option("multiLine", table in MULTILINE_TABLES)
    )
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if infer_schema:
        return reader.option("inferSchema", True).csv(path)
    header = reader.csv(path).columns
    schema, found = header_schema(header, table)
    raw = reader.schema(schema).option("enforceSchema", False).option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    columns = [F.col(f"`{found[c]}`").alias(c) for c in SOURCE_SCHEMAS[table].fieldNames()]
    return raw.select(*columns, *([CORRUPT] if keep_corrupt else []))


def ingest(
    spark: SparkSession,
    table: str,
    csv_path: str,
    out_path: str | None = None,
    *,
    load_time: Column | None = None,
    with_load_time: bool = True,
    observation: Observation | None = None,
    infer_schema: bool = False,
) -> DataFrame:
    """Raw CSV -> typed table (+ ``etl_timestamp``), optionally written as Parquet.

    When ``out_path`` is given the table is written and the written copy is
    returned, so callers read Parquet rather than re-parsing the CSV.  An
    ``observation`` collects the counts ``rows`` and ``bad_rows`` (rows with a
    field that did not parse) during that write (no extra job).
    """
    count_bad = observation is not None and not infer_schema
    df = read_source_csv(spark, table, csv_path, infer_schema=infer_schema, keep_corrupt=count_bad)
    if with_load_time:
        df = df.withColumn(
            "etl_timestamp", load_time if load_time is not None else F.current_timestamp()
        )
    if observation is not None:
        counts = [F.count(F.lit(1)).alias("rows")]
        if count_bad:
            counts.append(F.count_if(F.col(CORRUPT).isNotNull()).alias("bad_rows"))
        df = df.observe(observation, *counts).drop(CORRUPT)
    if out_path is None:
        return df
    df.write.mode("overwrite").option("compression", LAYER_CODEC).parquet(out_path)
    return spark.read.parquet(out_path)


def ingest_all(
    spark: SparkSession, raw_dir: str, out_dir: str, *, load_time: Column | None = None
) -> dict[str, int]:
    """Ingest the six raw tables into ``out_dir/<table>``; returns row counts
    (observed while writing)."""
    counts: dict[str, int] = {}
    stamp = load_time if load_time is not None else F.current_timestamp()
    for table, file_name in SOURCE_FILES.items():
        obs = Observation(f"ingest_{table}")
        ingest(
            spark,
            table,
            f"{raw_dir.rstrip('/')}/{file_name}",
            f"{out_dir.rstrip('/')}/{table}",
            load_time=stamp,
            observation=obs,
        )
        counts[table] = int(obs.get["rows"])
    return counts


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """A written Parquet layer; Hive-style ``col=value`` folders become columns."""
    return spark.read.parquet(path)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str | None]:
    """The values of a layer's partition column, from the names of its ``col=value``
    folders (one listing, no file is opened); None for the folder of NULLs."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
    values = [unquote(n[len(column) + 1 :]) for n in names if n.startswith(f"{column}=")]
    return [None if v == NULL_FOLDER else v for v in values]
