"""CSV files whose records hold quoted line breaks, read by many tasks.

Lines of a file are read in blocks, as any text file.  Whether a block begins inside
quotes follows from the number of quotes before it: their parity is counted per block,
and a running sum over blocks (a row each) gives the parity at every block's start.
Each block then puts its lines together to records by itself; a record that goes over
blocks comes as pieces, which are joined by the block where it began.  The records go to
Spark's own CSV parser.

A quote inside quotes is written twice, so it does not change the parity.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlake.schemas import SOURCE_SCHEMAS, TIMESTAMP_FORMAT
from martlake.sources.files import CORRUPT, header_schema

_PIECES = "file string, start long, kind int, text string"
#: Kinds of pieces: a whole record, the end of one that began before, one that goes on.
_WHOLE, _HEAD, _TAIL, _MIDDLE, _HEADER = 0, 1, 2, 3, 4


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of blocks, one block after another, with the parity at the block's
    start -> pieces."""
    block, inside, held, first = None, False, [], False

    def piece(kind: int) -> tuple:
        return (*block, kind, "\n".join(held))

    for batch in batches:
        out = []
        for file, start, line, odd in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if (file, start) != block:
                if held:
                    out.append(piece(_MIDDLE if first else _TAIL))
                block, inside, held, first = (file, start), bool(odd), [], bool(odd)
                opening = start == 0
            line = line[:-1] if line.endswith("\r") else line
            held.append(line)
            if line.count('"') % 2:
                inside = not inside
            if not inside:
                kind = _HEAD if first else _HEADER if opening else _WHOLE
                if held != [""] or first:
                    out.append(piece(kind))
                    opening = False
                held, first = [], False
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int32(), pa.string()))],
                ["file", "start", "kind", "text"],
            )
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], t) for x, t in zip(piece(_MIDDLE if first else _TAIL), (pa.string(), pa.int64(), pa.int32(), pa.string()))],
            ["file", "start", "kind", "text"],
        )


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, is_header, text): the records of CSV files, line breaks inside quotes
    included; blank lines between records are left out."""
    lines = _lines(spark, path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    blocks = lines.groupBy("file", "start").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    # a row per block of the files: what one task reads
    parity = blocks.select("file", "start", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).cast("int").alias("odd"))
    known = lines.join(F.broadcast(parity), ["file", "start"]).select("file", "start", "value", "odd")
    pieces = known.mapInArrow(_assemble, _PIECES)
    kind = F.col("kind")
    whole = pieces.filter(kind.isin(_WHOLE, _HEADER)).select("file", (kind == _HEADER).alias("is_header"), "text")
    # a record's pieces: the last tail before, and all pieces up to the next head
    parts = pieces.filter(kind.isin(_HEAD, _TAIL, _MIDDLE))
    order = Window.partitionBy("file").orderBy("start", "kind")
    began = F.last(F.when(kind == _TAIL, F.col("start")), ignorenulls=True).over(order)
    joined = parts.withColumn("began", began).groupBy("file", "began").agg(
        F.sort_array(F.collect_list(F.struct("start", "text"))).alias("p"), F.min("start").alias("start")
    )
    joined = joined.select("file", (F.col("start") < 0).alias("is_header"), F.array_join("p.text", "\n").alias("text"))
    return whole.unionByName(joined)


def read_records_csv(spark: SparkSession, table: str, path: str, *, keep_corrupt: bool = False) -> DataFrame:
    """``read_source_csv`` for files of any size with quoted line breaks, read by as
    many tasks as they have blocks."""
    header = spark.read.option("header", True).option("escape", '"').option("multiLine", False).csv(path).columns
    schema, found = header_schema(header, table)
    options = {
        "escape": '"', "timestampNTZFormat": TIMESTAMP_FORMAT, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
    }
    plain = ", ".join(f"`{f.name}` string" for f in schema.fields if f.name != CORRUPT)
    rows = records(spark, path)
    names = F.from_csv("text", plain, {"escape": '"'})
    same = F.array(*(F.trim(names[f"`{h}`" if "." in h else h]) for h in header))
    wanted = F.array(*(F.lit(h.strip()) for h in header))
    checked = F.when(
        F.col("is_header"), F.when(same == wanted, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit(f"{table}: another header: "), "text")))
    ).otherwise(False)
    rows = rows.filter(~checked.cast("boolean"))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = rows.select(F.from_csv("text", ddl, options).alias("r"))
    columns = [F.col("r")[found[c]].alias(c) for c in SOURCE_SCHEMAS[table].fieldNames()]
    return parsed.select(*columns, *([F.col("r")[CORRUPT].alias(CORRUPT)] if keep_corrupt else []))
