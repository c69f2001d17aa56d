from __future__ import annotations

import os
import random
import time

import numpy as np
import pytest

from martlake import session
from martlake.llm import graph, parity_join, tables
from martlake.llm.parity_join import Join, similarity_components
from tests.conftest import SF001, SF01
from tests.llm.helpers import ODD_TEXTS, lower_az, make_docs, table_rows, words


def shingles(text, n):
    w = words(lower_az(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def brute(rows, join):
    """Every pair that shares an n-gram, by an inverted index; then union-find."""
    sets = [(d, shingles(t, join.n)) for d, t in rows]
    unique = {}
    for d, s in sets:
        if s:
            unique.setdefault(s, []).append(d)
    keys = sorted(unique, key=len)
    at, parent = {}, {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def union(a, b):
        a, b = sorted((root(a), root(b)))
        parent[b] = a

    for s in keys:
        for d in unique[s]:
            union(d, unique[s][0])
    for i, s in enumerate(keys):
        shared = {}
        # a linked partner shares one of any 1 - t of the grams, plus one
        part = list(s)[: len(s) * (join.den - join.num) // join.den + 1]
        for x in part:
            for j in at.get(x, ()):
                shared[j] = True
        for j in shared:
            o = keys[j]
            both = len(o & s)
            if join.den * both >= join.num * (len(s) + len(o) - both):
                union(unique[s][0], unique[o][0])
        for x in s:
            at.setdefault(x, []).append(i)
    return sorted((d, len(s), root(d)) for d, s in sets)


def run(docs, join):
    return sorted(map(tuple, similarity_components(docs, join).collect()))


def edited(rng, base, n):
    w = list(base)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"e{rng.random():.9f}"
    return " ".join(w)


@pytest.mark.parametrize("join,sf", [(Join(3, 90, 100), SF01), (Join(5, 80, 100), SF001)])
def test_whole_table(spark, join, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = brute(table_rows("documents", sf), join)
    assert run(docs, join) == want
    assert len({c for *_, c in want}) < len(want)


@pytest.mark.parametrize("join", [Join(3, 90, 100), Join(5, 80, 100)])
def test_planted_copies_of_all_sizes(spark, join, monkeypatch):
    """Chains and families of edited copies, around the threshold, with a
    passage common to many, against brute force; large buckets and second
    sketches are forced by small limits."""
    rng = random.Random(3)
    common = [f"c{i}" for i in range(30)]
    texts = list(ODD_TEXTS)
    for size in (1, 2, 4, 7, 10, 14, 20, 33, 60, 110, 250, 600):
        for _ in range(3):
            base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
            if size > 100:
                base[20:20] = common
            texts.append(" ".join(base))
            for k in range(5):
                texts.append(edited(rng, base, rng.randint(0, max(1, size // 20))))
            w = list(base)
            for _ in range(5):  # a chain that drifts away from its start
                w[rng.randrange(len(w))] = f"d{rng.random():.9f}"
                texts.append(" ".join(w))
    texts += [" ".join(common), " ".join(common).upper(), " ".join(common[:-1])]
    rng.shuffle(texts)
    want = brute(list(enumerate(texts)), join)
    docs = make_docs(spark, texts).withColumnRenamed("lang", "node").withColumnRenamed("source", "bits").repartition(4)
    if join.n == 5:
        monkeypatch.setattr(parity_join, "SPLIT", 3)
    assert run(docs, join) == want
    assert len({c for *_, c in want}) < len(want) - 50


def test_hot_group_of_near_copies(spark):
    """1,500 edited copies, each some edits away from one text but often too
    far from each other, beside copies of it."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    texts = [edited(rng, base, rng.choice((0, 1, 1, 2))) for _ in range(1500)]
    join = Join(3, 90, 100)
    assert run(make_docs(spark, texts).repartition(6), join) == brute(list(enumerate(texts)), join)


def test_repeated_rows_null_ids_empty_table(spark):
    rows = [(5, "a b c d"), (5, "a b c d"), (2, "A b  c D"), (None, "a b c d"), (9, "x"), (7, "x "), (1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(docs, Join(3, 90, 100)) == [(1, 0, 1), (2, 2, 2), (5, 2, 2), (5, 2, 2), (7, 1, 7), (9, 1, 7)]
    assert run(docs.limit(0), Join()) == []


def test_bands_keep_every_link():
    """Linked sizes are in the same or the next band, and blocks suffice."""
    for join in (Join(3, 90, 100), Join(5, 80, 100), Join(5, 95, 100), Join(1, 50, 100)):
        low, blocks, spare = join.bands()
        band = lambda x: np.searchsorted(low, x, side="right") - 1
        for a in range(1, 3000):
            b = a * join.den // join.num
            assert band(a) <= band(b) <= band(a) + 1
            assert blocks[band(b)] - spare[band(b)] >= join.most_different(a + b) + 1


def test_sketch_comparison_loses_no_link():
    """Pairs that link are never ruled out by sizes and folded sketches."""
    rng = random.Random(6)
    join = Join(3, 80, 100)
    texts = [edited(rng, [f"w{i}" for i in range(60)], rng.randint(0, 4)).encode() for _ in range(150)]
    d, g = parity_join.shingle_sets(texts, join.n)
    size, _ = parity_join.nodes(d, g, len(texts))
    bits = parity_join.folded(d, g, len(texts))
    sets = [set(g[d == i].tolist()) for i in range(len(texts))]
    passed = {(a, b) for i, j in parity_join.near_rows(size, bits, np.arange(len(texts)), join) for a, b in zip(i, j)}
    links = {(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets))
             if join.den * len(sets[a] & sets[b]) >= join.num * len(sets[a] | sets[b])}
    assert links and links <= passed < {(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets))}


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)]
    edges += [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(250)]
    rng.shuffle(edges)
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    label = {x: x for e in edges for x in e}
    for _ in range(len(label)):
        before = dict(label)
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
        if before == label:
            break
    assert got == {x: c for x, c in label.items() if any(x in e for e in edges if e[0] != e[1])}


def test_batch_border_inside_a_bucket_loses_no_other():
    import pyarrow as pa

    def batch(*rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["key", "node"])

    # key 1 and the part of key 2 before the border have the members of key 3
    batches = [batch((1, 10), (1, 20), (2, 30)), batch((2, 40), (3, 10), (3, 20), (3, 30))]
    got = [r for b in parity_join._runs(iter(batches)) for r in b.to_pylist()]
    assert [(r["bucket"], r["members"]) for r in got] == [(1, [10, 20]), (2, [30, 40]), (3, [10, 20, 30])]


def test_even_and_odd_bands_share_the_keys(spark):
    """The keys are dealt out in two parts: none is lost or in both, neither holds most."""
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(n)) for n in (0, 1, 2, 4, 9, 17, 40, 90, 300, 800) for _ in range(4)]
    docs = make_docs(spark, texts).select("doc_id", "text")
    whole, even, odd = (sorted(map(tuple, parity_join.block_rows(docs, Join(), k).collect())) for k in (None, 0, 1))
    assert sorted(even + odd) == whole
    assert not {k for k, _ in even} & {k for k, _ in odd}
    assert max(len(even), len(odd)) < 0.6 * len(whole)


def test_shuffles_and_rounds_leave_the_disk(spark, tmp_path, monkeypatch):
    """The shuffles of a table that is written go with it, not when the driver's
    garbage is collected; tables of earlier rounds and of the parts go too."""
    monkeypatch.setattr(session, "scratch_root", lambda spark: str(tmp_path))
    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    shuffles = lambda: {f for top in folders for _, _, fs in os.walk(top) for f in fs if f.startswith("shuffle_")}
    before = shuffles()
    rows = spark.range(2000).repartition(3, "id")
    tables.dropped(spark, tables.stored(rows.groupBy((rows["id"] % 7).alias("k")).count(), "sums")[1])
    tables.written(rows, "rows")
    for _ in range(40):  # Spark does not wait for the files to go
        if not shuffles() - before:
            break
        time.sleep(0.25)
    assert not shuffles() - before
    assert spark.conf.get(tables.CLEANUP_KEY, None) is None

    rng = random.Random(8)
    base = [f"w{i}" for i in range(80)]
    docs = make_docs(spark, [edited(rng, base, k % 4) for k in range(60)] + ["other words"])
    assert similarity_components(docs, Join()).count() == 61
    left = {p.name.rsplit("-", 1)[0] for p in (tmp_path / "martlake").iterdir()}
    assert {"buckets-once", "links", "small-star"} <= left
    assert not {"buckets", "edges", "both", "least", "large-star"} & left


def test_a_session_that_keeps_its_shuffles_is_left_alone(spark):
    spark.conf.set(tables.CLEANUP_KEY, "false")
    try:
        with tables.shuffles_dropped(spark):
            assert spark.conf.get(tables.CLEANUP_KEY) == "false"
        assert spark.conf.get(tables.CLEANUP_KEY) == "false"
    finally:
        spark.conf.unset(tables.CLEANUP_KEY)
    with tables.shuffles_dropped(spark):
        assert spark.conf.get(tables.CLEANUP_KEY) == "true"
    assert spark.conf.get(tables.CLEANUP_KEY, None) is None
