"""Quality rules from repetition: how much of a text lies in repeated word
runs and repeated lines.

Per document one pass of numpy over its word hashes: for each length in
``NGRAM_LIMITS`` the windows of that many words are hashed, later occurrences
of an equal window mark their words, and the code points of marked words are
summed.  Equal lines are found the same way.  No shuffle; a task holds one
slice of about 1 MB of text (or one longer document).

Null and empty texts have no words and no lines with a word: all counts 0,
``base_failed`` true.  Repeated rows and null ids each give a row; equal windows and
lines count within one text only; an empty table gives an empty result; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.textbuf import SpanHash, TextBuf, chunks, mix64, ngram_hash, whole

#: Words per window, and the largest share of a text's word characters that
#: may lie in later occurrences of such windows.
NGRAM_LIMITS: dict[int, float] = {5: 0.15, 7: 0.13, 10: 0.10}
#: Largest share of lines, and of word characters, in repeated lines.
LINE_LIMIT, LINE_CHAR_LIMIT = 0.30, 0.20

SYMBOLS = b"#*$%&|<>"

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, dup_line_chars long, "
    + ", ".join(f"dup_chars_{n} long" for n in NGRAM_LIMITS)
)


def _later(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per place: an equal key stands earlier; an equal key stands anywhere else."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    later, shared = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:][same]] = True
    shared[order[1:][same]] = True
    shared[order[:-1][same]] = True
    return later, shared


def _cover(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Places covered by windows of n places that start where ``starts`` is true."""
    steps = np.zeros(size + 1, dtype=np.int64)
    at = np.flatnonzero(starts)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + n, -1)
    return np.cumsum(steps[:-1]) > 0


def measure(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The columns of ``MEASURES`` for some texts."""
    t = TextBuf(texts)
    start, end, doc = t.words
    span = SpanHash(t.buf, 1)
    chars = t.points[end] - t.points[start]
    own = mix64(doc.astype(np.uint64) + np.uint64(1))
    hashes = span(start, end)
    out = {"n_words": t.count(doc), "word_chars": t.count(doc, chars)}
    marks = np.zeros(256, bool)
    marks[list(SYMBOLS)] = True
    out["n_symbols"] = t.count(t.doc_of(np.flatnonzero(marks[t.buf])))

    l_start, l_end, l_doc = t.lines
    first, last = np.searchsorted(start, l_start), np.searchsorted(start, l_end)
    worded = last > first
    before = np.concatenate(([0], np.cumsum(chars)))
    l_chars = before[last] - before[first]
    at = np.flatnonzero(worded)
    repeated, _ = _later(span(l_start[at], l_end[at]) ^ mix64(l_doc[at].astype(np.uint64) + np.uint64(1)))
    out["n_dup_lines"] = t.count(l_doc[at][repeated])
    out["n_lines"] = t.count(l_doc[at])
    out["dup_line_chars"] = t.count(l_doc[at][repeated], l_chars[at][repeated])

    for n in (3, *NGRAM_LIMITS):
        keys = ngram_hash(hashes, doc, n) ^ own[: max(0, len(own) - n + 1)]
        inside = np.flatnonzero(whole(doc, n))
        later, shared = _later(keys[inside])
        starts = np.zeros(len(doc), bool)
        starts[inside[shared if n == 3 else later]] = True
        covered = _cover(starts, n, len(doc))
        if n == 3:
            out["n_repeat_words"] = t.count(doc[covered])
        else:
            out[f"dup_chars_{n}"] = t.count(doc[covered], chars[covered])
    return out


def repetition_measures(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its id and the ``MEASURES``."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    names = [x.split()[0] for x in MEASURES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            got = measure(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(got[k]) for k in names)], ["id", *names]
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, {MEASURES}").withColumnRenamed("id", id_column)


def verdict(measures: DataFrame) -> DataFrame:
    """Adds ``base_failed`` and ``kept``.  The limits are exact comparisons of
    counts with a share of the text's own totals."""
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    failed = (F.col("n_dup_lines") > LINE_LIMIT * F.col("n_lines")) | (
        F.col("dup_line_chars") > LINE_CHAR_LIMIT * F.col("word_chars")
    )
    for n, share in NGRAM_LIMITS.items():
        failed = failed | (F.col(f"dup_chars_{n}") > share * F.col("word_chars"))
    return measures.withColumn("base_failed", base).withColumn("kept", ~base & ~failed)
