"""Exact line deduplication across documents.

A line's key is the line with ``[\\x20\\x09-\\x0D]`` stripped at both ends and
A-Z lower-cased.  Keys of at least ``MIN_POINTS`` code points that occur in at
least ``MIN_DOCS`` documents lose all their lines, except in the largest
document id that holds them.

Method: 16-byte line hashes are range-partitioned on (hash, document,
position) and sorted in each partition, largest document first, so that a task
streams every key once, holding only the running key's counters.  A key inside
one partition is settled there.  A key that touches a partition's first or last
row may go on next door; its rows are passed on, and at most two summary rows
per partition settle all such keys, however hot.  The result is one compressed
keep bitmap per document, not text.

Null ids: rows without a document id take no part (no document to keep a
line for) and are not in the result.  Null and empty texts are one empty line.
Several rows under one id are one document for counting, and each row gets its
own bitmap.  Memory goes with the longest text; an empty table gives an empty result;
other columns pass through :func:`drop_lines` whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlake.llm.tables import dropped, free_names, row_key, stored, written
from martlake.llm.textbuf import SpanHash, TextBuf, as_bytes, chunks

MIN_POINTS, MIN_DOCS = 40, 5

_LINE = "h1 long, h2 long, doc_id long, row long, at int"
_STREAMED = "kind int, h1 long, h2 long, doc_id long, row long, at int, part int, docs long, low long"
_DROP, _OPEN, _SUMMARY = 0, 1, 2


def _line_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes and places of all lines long enough to count."""
    for batch, texts in chunks(batches):
        t = TextBuf(texts, lower=True)
        w_start, w_end, _ = t.words
        start, end, doc = t.lines
        first, last = np.searchsorted(w_start, start), np.searchsorted(w_start, end)
        place = np.arange(len(doc)) - np.searchsorted(doc, doc)
        at = np.flatnonzero(last > first)
        lo, hi = w_start[first[at]], w_end[last[at] - 1]
        long = t.points[hi] - t.points[lo] >= MIN_POINTS
        at, lo, hi = at[long], lo[long], hi[long]
        ids, rows = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(SpanHash(t.text, 2)(lo, hi).view(np.int64)),
                pa.array(SpanHash(t.text, 3)(lo, hi).view(np.int64)),
                pa.array(ids[doc[at]].astype(np.int64)),
                pa.array(rows[doc[at]].astype(np.int64)),
                pa.array(place[at].astype(np.int32)),
            ],
            ["h1", "h2", "doc_id", "row", "at"],
        )


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of one partition, as they come.

    Within a batch, keys that neither begin nor end it are settled together.
    The last key of a batch is carried on as (largest document, documents so
    far, smallest document) and, while it has under ``MIN_DOCS`` documents, its
    rows.  The largest document is known from a key's first row, so rows of a
    key that began here are settled as soon as it has enough documents; rows
    of the partition's first key, which may have begun next door, stay open.
    """
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    names = [x.split()[0] for x in _STREAMED.split(", ")]
    kinds = [np.int32, np.int64, np.int64, np.int64, np.int64, np.int32, np.int32, np.int64, np.int64]

    def made(kind, h1, h2, doc, row, at, docs=0, low=0):
        cols = np.broadcast_arrays(kind, h1, h2, doc, row, at, part, docs, low)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.atleast_1d(c).astype(k)) for c, k in zip(cols, kinds)], names
        )

    key, top, docs, low, first = None, 0, 0, 0, True
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def flush():
        """The carried key's rows, if they can go out now."""
        if held and (first or docs >= MIN_DOCS):
            doc, row, at = (np.concatenate(x) for x in zip(*held))
            held.clear()
            if not first:
                doc, row, at = doc[m := doc != top], row[m], at[m]
            if len(doc):
                yield made(_OPEN if first else _DROP, *key, doc, row, at)

    def close(last):
        if first or last:
            if held:  # too few documents here; more may be next door
                doc, row, at = (np.concatenate(x) for x in zip(*held))
                yield made(_OPEN, *key, doc, row, at)
            yield made(_SUMMARY, *key, top, 0, 0, docs, low)
        held.clear()

    for batch in batches:
        h1, h2, doc, row, at = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        if not len(h1):
            continue
        new_key = np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
        cuts = np.append(np.flatnonzero(new_key), len(h1))
        new_doc = new_key | np.concatenate(([True], doc[1:] != doc[:-1]))
        seen = np.concatenate(([0], np.cumsum(new_doc)))
        sizes = seen[cuts[1:]] - seen[cuts[:-1]]
        for run in (0, len(cuts) - 2) if len(cuts) > 2 else (0,):
            lo, hi = cuts[run], cuts[run + 1]
            if (h1[lo], h2[lo]) != key:
                if key is not None:
                    yield from close(False)
                    first = False
                key, top, docs, low = (h1[lo], h2[lo]), doc[lo], 0, None
            docs += int(sizes[run]) - int(low is not None and low == doc[lo])
            low = doc[hi - 1]
            held.append((doc[lo:hi], row[lo:hi], at[lo:hi]))
            yield from flush()
            if run == 0 and len(cuts) > 3:  # the runs between, whole in this batch
                which = np.repeat(np.arange(len(sizes)), np.diff(cuts))
                m = (sizes >= MIN_DOCS)[which] & (doc != doc[cuts[:-1]][which])
                m[: cuts[1]] = m[cuts[-2] :] = False
                if m.any():
                    yield made(_DROP, h1[m], h2[m], doc[m], row[m], at[m])
    if key is not None:
        yield from close(True)


def line_drops(docs: DataFrame) -> DataFrame:
    """(row, doc_id, at): the lines to drop, by document row and line number.
    ``docs`` has doc_id, row (see ``row_key``) and text."""
    keys, folder = stored(docs.select("doc_id", "row", "text").mapInArrow(_line_keys, _LINE), "line-keys")
    by = ("h1", "h2", F.desc("doc_id"), "at")
    ordered = keys.repartitionByRange(*by).sortWithinPartitions(*by)
    streamed = written(ordered.mapInArrow(_stream, _STREAMED), "line-stream")
    dropped(docs.sparkSession, folder)
    # A key's summaries, one per partition that it touches.  A document whose
    # rows were cut by a partition's edge was counted on both sides.
    before = F.lag("low").over(Window.partitionBy("h1", "h2").orderBy("part"))
    settled = (
        streamed.filter(F.col("kind") == _SUMMARY)
        .withColumn("docs", F.col("docs") - F.when(before == F.col("doc_id"), 1).otherwise(0))
        .groupBy("h1", "h2")
        .agg(F.max("doc_id").alias("top"), F.sum("docs").alias("n"))
        .filter(F.col("n") >= MIN_DOCS)
        .select("h1", "h2", "top")
    )
    # at most two such keys per range partition, whatever the data
    opened = streamed.filter(F.col("kind") == _OPEN).select("h1", "h2", "row", "doc_id", "at")
    late = opened.join(F.broadcast(settled), ["h1", "h2"]).filter(F.col("doc_id") != F.col("top"))
    sure = streamed.filter(F.col("kind") == _DROP)
    return sure.select("row", "doc_id", "at").unionByName(late.select("row", "doc_id", "at"))


def pack_keep(dropped: np.ndarray) -> bytes:
    """Compressed keep bits of the lines up to the last dropped one; bits that
    fill up the last byte, and all later lines, count as kept."""
    keep = np.ones(-(-(int(dropped.max()) + 1) // 8) * 8, bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep).tobytes())


def unpack_keep(packed: bytes | None, n_lines: int) -> np.ndarray:
    keep = np.ones(n_lines, bool)
    if packed:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8))[:n_lines]
        keep[: len(bits)] = bits.astype(bool)
    return keep


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = [pack_keep(np.asarray(x.as_py())) for x in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(packed, pa.binary())], ["row", "doc_id", "keep"]
        )


def keep_bitmaps(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(row, doc_id, keep): the compressed keep bitmap of every document row
    that loses a line; a document row without one keeps all its lines."""
    rows = docs.filter(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("doc_id"),
        row_key(id_column, text_column).alias("row"),
        F.col(text_column).alias("text"),
    )
    lines = line_drops(rows).groupBy("row", "doc_id").agg(F.collect_set("at").alias("at"))
    return lines.mapInArrow(_pack, "row long, doc_id long, keep binary")


def with_bitmaps(
    docs: DataFrame, keep: str = "keep", id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The documents and a column ``keep`` with their bitmap or null.  The
    texts are shuffled once and not sorted: the bitmaps are the hashed side."""
    row, doc = free_names([*docs.columns, keep], "row", "id")
    maps = keep_bitmaps(docs, id_column, text_column).select(
        F.col("row").alias(row), F.col("doc_id").alias(doc), F.col("keep").alias(keep)
    )
    on = (F.col(id_column).cast("long") == F.col(doc)) & (row_key(id_column, text_column) == F.col(row))
    return docs.join(maps.hint("shuffle_hash"), on, "left").drop(row, doc)


def kept_lines(raw: bytes, packed: bytes | None) -> tuple[bytes, int, int]:
    """The kept lines joined by newlines, the number of lines, and of dropped ones."""
    if not packed:
        return raw, raw.count(b"\n") + 1, 0
    lines = raw.split(b"\n")
    keep = unpack_keep(packed, len(lines))
    return b"\n".join(x for x, k in zip(lines, keep) if k), len(lines), int((~keep).sum())


def line_report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, kept_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, packed in zip(batch.column(1), batch.column(2)):
                kept, n, dropped = kept_lines(as_bytes(text.as_py()), packed.as_py())
                out.append((n, dropped, hashlib.sha256(kept).hexdigest()))
            n, dropped, sha = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(sha, pa.string())],
                ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), "text").filter(F.col("doc_id").isNotNull())
    joined = with_bitmaps(rows).select("doc_id", "text", "keep")
    return joined.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def drop_lines(docs: DataFrame) -> DataFrame:
    """The documents table with the repeated lines gone from ``text`` and
    ``n_chars``, if there is one, brought up to date; other columns, and rows without
    a document id, as they were."""
    (keep,) = free_names(docs.columns, "keep")
    joined = with_bitmaps(docs, keep).select(*docs.columns, keep)
    text_at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, packed = batch.columns, batch.column(batch.num_columns - 1)
            loses = np.flatnonzero(packed.is_valid().to_numpy(zero_copy_only=False))
            if len(loses):
                texts = columns[text_at].to_pylist()
                for i in loses:
                    texts[i] = kept_lines(as_bytes(texts[i]), packed[i].as_py())[0].decode("utf-8", "surrogatepass")
                columns[text_at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    out = joined.mapInArrow(run, joined.schema)
    if "n_chars" in docs.columns:
        now = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col(keep).isNull(), F.col("n_chars")).otherwise(now))
    return out.select(*docs.columns)
