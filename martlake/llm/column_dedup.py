"""Removal of repeated byte strings across documents, by a column-wise suffix
order over many aligned strings.

Every byte covered by a ``LENGTH``-byte string that also starts anywhere else
(same document included, overlaps count) is removed; strings are judged on the
input.

A full suffix order of the collection would take as many rounds as the longest
document has bytes, each a pass over all that was inserted before.  Only equal
strings of ``LENGTH`` bytes matter, so the collection is first reduced to short
aligned strings:

1. *Anchors.*  In each ``LENGTH``-byte window the ``GRAM``-byte string with the
   smallest hash (the leftmost of equal ones) is its anchor.  Equal windows have
   equal anchors at equal places, so all windows of an anchor lie in a segment
   of ``REACH`` bytes to both sides, and equal windows lie in segments with equal
   anchors.  Anchors that occur once are dropped after one shuffle of hashes.
2. *Equal segments* are inserted once, with a count: all windows of a segment
   found twice are repeated.
3. *Column-wise construction.*  The distinct segments of anchors that have
   several, aligned at the anchor, get one symbol each per round, from the
   right: a stable sort of the last round's order by the new symbols gives the
   order of all suffixes that start in this column (the round's symbols in the
   last order are its Burrows-Wheeler transform), and the common prefixes of
   neighbours grow by one over the least of the range between them, or fall to
   0.  A window is repeated if its common prefix with a neighbour reaches
   ``LENGTH``.  Rounds read columns and orders in sequence; a task holds the
   segments of whole anchors, some ``TOGETHER`` at a time.
4. All windows of an anchor contain it, so its repeated ones cover one run of
   bytes; runs are joined back to all occurrences and to the documents.

An anchor with more than ``HOT`` distinct segments is not put in one task: its
windows are grouped by hash over all tasks, with the same result.

Defined cases: null is the empty text; texts shorter than ``LENGTH`` lose
nothing; repeated rows are two documents; rows are told apart by id and text.  Memory
goes with the longest text; an empty table gives an empty result; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.tables import row_key, written
from martlake.llm.textbuf import CHUNK_BYTES, SpanHash, TextBuf, as_bytes, chunks, gram_hash, mix64

LENGTH, GRAM = 200, 32
REACH = LENGTH - GRAM
TOGETHER, HOT = 20_000, 200_000

_U = np.uint64
_NONE = 256  # no symbol: the document ends here

_ANCHOR = "row long, place long, key long, segment long, left int, right int"


def _least_places(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, from prefix and suffix minima
    of blocks of that width."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(_U).max, dtype=_U)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Document, place, key, segment hash, and bytes to the left and right of
    the anchor within its segment, of every anchor."""
    t = TextBuf(texts)
    total = len(t.buf)
    if total < LENGTH + 1:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    places, keys = [], []
    for first in range(0, total - LENGTH + 1, CHUNK_BYTES):  # windows that begin in one block
        gram = gram_hash(t.buf[first : first + CHUNK_BYTES + LENGTH - 1], GRAM, 5)
        # the place in the low bits finds the minimum's place, leftmost first
        at = np.arange(len(gram))
        least = _least_places((gram & _U(0xFFFFFFFF00000000)) | at.astype(_U), REACH + 1)
        begin = np.arange(first, first + len(least))
        inside = t.doc_of(begin) == t.doc_of(begin + LENGTH - 1)
        # a window that holds a closing newline belongs to no document
        inside &= begin + LENGTH <= t.doc_end[t.doc_of(begin)]
        found = np.unique((least[inside] & _U(0xFFFFFFFF)).astype(np.int64))
        places.append(found + first)
        keys.append(gram[found])
    place, once = np.unique(np.concatenate(places), return_index=True)
    key = np.concatenate(keys)[once]
    doc = t.doc_of(place)
    left = np.minimum(REACH, place - t.doc_start[doc])
    right = np.minimum(REACH, t.doc_end[doc] - place - GRAM)
    segment = SpanHash(t.buf, 6)(place - left, place + GRAM + right) ^ mix64((left * 1024 + right).astype(_U))
    return doc, place - t.doc_start[doc], key.view(np.int64), segment.view(np.int64), left, right


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in chunks(batches):
        doc, place, key, segment, left, right = anchors(texts)
        rows = batch.column(0).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[doc].astype(np.int64)), pa.array(place), pa.array(key), pa.array(segment),
             pa.array(left.astype(np.int32)), pa.array(right.astype(np.int32))],
            ["row", "place", "key", "segment", "left", "right"],
        )


def _several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, sorted by key, whose key occurs more than once."""
    last, was = None, False  # the last row, and whether the one before had its key
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch] if last is None else [last, batch]).combine_chunks()
        key = table.column("key").to_numpy()
        same = key[1:] == key[:-1]
        keep = np.concatenate(([was], same)) | np.append(same, False)
        last, was = table.slice(len(key) - 1).to_batches()[0], bool(same[-1]) if len(same) else was
        yield from table.slice(0, len(key) - 1).filter(pa.array(keep[:-1])).to_batches()
    if last is not None and was:
        yield last


def _range_least(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of values[lo..hi], both included, for many ranges."""
    out = values[hi].copy()
    wide = np.flatnonzero(hi > lo)
    if len(wide):
        lo, hi = lo[wide], hi[wide]
        levels = np.frexp(hi - lo + 1)[1] - 1
        table, step = [values], 1
        for _ in range(int(levels.max())):
            table.append(np.minimum(table[-1][:-step], table[-1][step:]))
            step *= 2
        got = np.empty(len(wide), dtype=values.dtype)
        for level in np.unique(levels):
            m = levels == level
            row = table[level]
            got[m] = np.minimum(row[lo[m]], row[hi[m] - (1 << level) + 1])
        out[wide] = got
    return out


def repeated_runs(segments: list[bytes], left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end, relative to the anchor, of the run that each
    segment's repeated windows cover; end 0 if none is repeated."""
    n, width = len(segments), 2 * REACH + GRAM
    columns = np.full((width, n), _NONE, dtype=np.uint16)
    for i, (raw, skip) in enumerate(zip(segments, (REACH - left).tolist())):
        columns[skip : skip + len(raw), i] = np.frombuffer(raw, np.uint8)
    order, common = np.arange(n), np.zeros(n, dtype=np.int32)
    begin, end = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for c in range(width - 1, -1, -1):
        symbols = columns[c][order]
        moved = np.argsort(symbols, kind="stable")
        now = symbols[moved]
        same = np.flatnonzero((now[1:] == now[:-1]) & (now[1:] != _NONE)) + 1
        grown = np.zeros(n, dtype=np.int32)
        grown[same] = 1 + _range_least(common, moved[same - 1] + 1, moved[same])
        order, common = order[moved], grown
        if c <= REACH:
            long = common >= LENGTH
            long[:-1] |= long[1:]
            hit = order[long]
            begin[hit] = c - REACH
            end[hit] = np.where(end[hit] == 0, c - REACH + LENGTH, end[hit])
    return begin, end


def _construct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments sorted by key and hash, taken together by whole keys."""
    held: list[tuple] = []

    def work(rows):
        left = np.array([r[2] for r in rows])
        begin, end = repeated_runs([r[3] for r in rows], left)
        m = np.flatnonzero(end)
        return pa.RecordBatch.from_arrays(
            [pa.array([rows[i][0] for i in m], pa.int64()), pa.array([rows[i][1] for i in m], pa.int64()),
             pa.array(begin[m]), pa.array(end[m])],
            ["key", "segment", "begin", "end"],
        )

    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if held and held[-1][:2] == row[:2]:
                continue
            if len(held) >= TOGETHER and held[-1][0] != row[0]:
                yield work(held)
                held = []
            held.append(row)
    if held:
        yield work(held)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of all windows of some segments."""
    for batch in batches:
        for key, segment, left, raw in zip(*(batch.column(i).to_pylist() for i in range(4))):
            buf = np.frombuffer(raw, np.uint8)
            start = np.arange(min(left, len(raw) - LENGTH) + 1)
            if not len(start):
                continue
            full = lambda x: pa.array(np.full(len(start), x))  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays(
                [full(key), full(segment), pa.array(start - left),
                 *(pa.array(SpanHash(buf, s)(start, start + LENGTH).view(np.int64)) for s in (7, 8))],
                ["key", "segment", "at", "h1", "h2"],
            )


def _segment_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, wanted in zip(batch.column(0), batch.column(1)):
            raw = as_bytes(text.as_py())
            for w in wanted.as_py():
                a = w["place"]
                out.append((w["key"], w["segment"], w["left"], raw[a - w["left"] : a + GRAM + w["right"]]))
                if len(out) >= TOGETHER:
                    yield _packed(out)
                    out = []
        yield _packed(out)


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    key, segment, left, raw = zip(*rows) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(key, pa.int64()), pa.array(segment, pa.int64()), pa.array(left, pa.int32()), pa.array(raw, pa.binary())],
        ["key", "segment", "left", "raw"],
    )


def removed_runs(docs: DataFrame) -> DataFrame:
    """(row, runs): for documents that lose bytes, the runs (begin, end), not
    yet merged.  ``docs`` has row (see ``row_key``) and text."""
    found = docs.select("row", "text").mapInArrow(_anchor_rows, _ANCHOR)
    found = written(
        found.repartition("key").sortWithinPartitions("key").mapInArrow(_several, _ANCHOR), "anchors"
    )
    where = F.struct("row", "place", "left", "right")
    segments = written(
        found.groupBy("key", "segment").agg(F.count(F.lit(1)).alias("n"), F.min(where).alias("one")), "segments"
    )
    full = segments.filter("n > 1").select(
        "key", "segment", (-F.col("one.left")).cast("long").alias("begin"),
        (F.col("one.right") + GRAM).cast("long").alias("end"),
    ).filter(F.col("end") - F.col("begin") >= LENGTH)
    mixed = segments.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    wanted = segments.join(mixed, "key").select("key", "segment", "one", "kinds")
    wanted = written(wanted, "mixed-segments")
    per_row = wanted.select("key", "segment", "one.*").groupBy(F.col("row").alias("at")).agg(
        F.collect_list(F.struct("key", "segment", "place", "left", "right")).alias("wanted")
    )
    texts = docs.join(per_row.hint("shuffle_hash"), docs["row"] == per_row["at"]).select("text", "wanted")
    raw = texts.mapInArrow(_segment_bytes, "key long, segment long, left int, raw binary")
    run_schema = "key long, segment long, begin long, end long"
    hot = written(mixed.filter(F.col("kinds") > HOT).select("key"), "hot-anchors")
    some_hot = not hot.isEmpty()
    if some_hot:
        raw = written(raw.dropDuplicates(["key", "segment"]), "segment-bytes")
    plain = raw.join(hot, "key", "left_anti") if some_hot else raw
    built = plain.repartition("key").sortWithinPartitions("key", "segment").mapInArrow(_construct, run_schema)
    runs = built.unionByName(full)
    if some_hot:
        windows = raw.join(hot, "key", "left_semi").mapInArrow(
            _windows, "key long, segment long, at long, h1 long, h2 long"
        )
        windows = written(windows, "hot-windows")
        twice = windows.groupBy("key", "at", "h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
        runs = runs.unionByName(
            windows.join(twice, ["key", "at", "h1", "h2"]).groupBy("key", "segment")
            .agg(F.min("at").alias("begin"), (F.max("at") + LENGTH).alias("end"))
        )
    runs = written(runs.groupBy("key", "segment").agg(F.min("begin").alias("begin"), F.max("end").alias("end")), "runs")
    placed = found.select("row", "place", "key", "segment").join(runs, ["key", "segment"]).select(
        "row", F.struct((F.col("place") + F.col("begin")).alias("begin"), (F.col("place") + F.col("end")).alias("end")).alias("run")
    )
    return placed.groupBy("row").agg(F.collect_set("run").alias("runs"))


def merged(runs: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs."""
    out: list[list[int]] = []
    for begin, end in sorted((r["begin"], r["end"]) for r in runs):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [tuple(x) for x in out]


def removal_report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows = docs.select("doc_id", "text", row_key().alias("row"))
    runs = removed_runs(rows).withColumnRenamed("row", "at")
    joined = rows.join(runs.hint("shuffle_hash"), rows["row"] == runs["at"], "left").select("doc_id", "text", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, found in zip(batch.column(1), batch.column(2)):
                raw = as_bytes(text.as_py())
                gone = merged(found.as_py() or [])
                digest, at = hashlib.sha256(), 0
                for begin, end in gone:
                    digest.update(raw[at:begin])
                    at = end
                digest.update(raw[at:])
                out.append((len(raw), sum(e - b for b, e in gone), len(gone), digest.hexdigest()))
            cols = list(zip(*out)) if out else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
