from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np

from martlake.llm import column_dedup
from martlake.llm.column_dedup import LENGTH, removal_report, repeated_runs
from tests.conftest import SF001, SF01
from tests.llm.helpers import ODD_TEXTS, make_docs, table_rows


def brute(rows):
    raws = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(hash(b[i : i + LENGTH]) for _, b in raws for i in range(len(b) - LENGTH + 1))
    out = []
    for d, b in raws:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - LENGTH + 1):
            if seen[hash(b[i : i + LENGTH])] > 1:
                gone[i : i + LENGTH] = True
        spans = int(np.sum(gone[:-1] & ~np.concatenate(([False], gone[:-2] if len(b) else gone[:0])))) if len(b) else 0
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(docs):
    return sorted(map(tuple, removal_report(docs).collect()), key=str)


def test_whole_tables(spark):
    for sf in (SF001, SF01):
        want = brute(table_rows("documents", sf))
        assert run(spark.read.parquet(f"{sf}/documents.parquet")) == want
        assert sum(r[2] > 0 for r in want) > 10


def cases():
    rng = random.Random(4)
    noise = lambda n: "".join(rng.choice("abcdefghij klmno\né") for _ in range(n))
    passages = [noise(n) for n in (150, 190, 199, 200, 201, 260, 500, 900)]
    texts = list(ODD_TEXTS)
    for _ in range(60):
        p = rng.choice(passages)
        a, b = rng.randrange(0, 40), rng.randrange(0, 40)
        texts.append(noise(rng.randrange(0, 300)) + p[a : len(p) - b] + noise(rng.randrange(0, 300)))
    texts += [passages[5], passages[5], "q" * 200, "r" * 201, "s" * 900, "ab" * 300, passages[7] * 3]
    texts += [noise(50) + passages[3] + passages[3] + noise(9), noise(100) + passages[3], passages[6][:300]]
    return texts


def test_passages_edges_and_repetition(spark):
    texts = cases()
    docs = make_docs(spark, texts).withColumnRenamed("lang", "row").withColumnRenamed("source", "key").repartition(5)
    want = brute(list(enumerate(texts)))
    assert run(docs) == want
    assert run(docs.limit(0)) == []


def test_hot_anchor_path_and_small_groups(spark, monkeypatch):
    texts = cases()
    monkeypatch.setattr(column_dedup, "HOT", 2)
    monkeypatch.setattr(column_dedup, "TOGETHER", 3)
    assert run(make_docs(spark, texts).repartition(3)) == brute(list(enumerate(texts)))


def test_repeated_rows_and_null_ids(spark):
    t = "".join(random.Random(2).choice("abcdefgh ") for _ in range(400))
    rows = [(1, t), (1, t), (None, "x" + t[:250]), (2, None), (2, t[:100])]
    assert run(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_construction_against_pairs():
    """The column-wise order finds what comparing all pairs finds."""
    rng = random.Random(8)
    reach, gram = column_dedup.REACH, column_dedup.GRAM
    for _ in range(20):
        base = bytes(rng.choice(b"abc") for _ in range(2 * reach + gram))
        segments, left = [], []
        for _ in range(rng.randrange(2, 30)):
            s = bytearray(base)
            for _ in range(rng.randrange(0, 3)):
                at = rng.randrange(len(s))
                if not reach <= at < reach + gram:
                    s[at] = rng.choice(b"xyz")
            cut, stop = rng.choice((0, 0, 30, reach)), rng.choice((0, 0, 50, reach))
            segments.append(bytes(s[cut : len(s) - stop]))
            left.append(reach - cut)
        begin, end = repeated_runs(segments, np.array(left))
        windows = [
            {c: s[c + lf : c + lf + LENGTH] for c in range(-lf, min(0, len(s) - lf - LENGTH) + 1)}
            for s, lf in zip(segments, left)
        ]
        for i, w in enumerate(windows):
            hits = [c for c, x in w.items() if any(x == o.get(c) for j, o in enumerate(windows) if j != i)]
            assert (begin[i], end[i]) == ((min(hits), max(hits) + LENGTH) if hits else (0, 0))
