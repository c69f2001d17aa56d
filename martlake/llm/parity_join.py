"""Similarity join of documents on word n-grams by parity sketches.

A document is the set of its distinct word n-grams, as 64-bit hashes.  Two
documents link when ``den * |A & B| >= num * |A | B|``.

**Sketch.**  The hash range is cut into ``B`` blocks and the hashes in a block
are combined by XOR.  An n-gram that both documents have cancels out, so two
sketches differ in at most as many blocks (and, folded to ``FOLD`` words of
one-hot bits, in at most as many bits) as the symmetric difference has n-grams.

**Bands and pigeonhole.**  Sizes are cut into bands such that linked documents
are in the same or in neighbouring bands.  In the sketch of band j, linked
documents differ by at most ``D`` n-grams, so of ``B = D + 1 + E`` blocks at least
``1 + E`` agree.  Blocks without any n-gram agree for no reason and are not
keys: with at most ``E`` of them in either document a block with n-grams still
agrees.  A document with more empty blocks also emits each empty block
combined with the blocks of a second, independent sketch, so that nothing is
lost and no bucket of empty blocks forms.

**Buckets.**  Documents of one key form a bucket.  Keys are the largest rows of the
join, far larger than the texts on disk, so the even bands and the odd ones are dealt
out one after the other: each document has one of its two bands in either.  Each member is compared with
the bucket's first one only; buckets that are equal as sets count once.  After
the links found so far are joined into components, only buckets that still
hold several components are looked at again, for pairs of different components;
a bucket of more than ``SPLIT`` members is first split by the second sketch, in
which linked documents must agree as well.  No link between different sets is
lost, and a large group of near copies costs one comparison a member and bucket.

Candidates pass the sketches' bit distance first and are then verified on the
sets.  Equal sets are one node from the start.

Defined cases: null or empty texts, or texts without words, have no n-grams and
link with nothing; fewer words than n form one n-gram; each input row gives one
row; rows without an id are left out (they have no component id).  A node is a 64-bit
digest of the set.  Memory goes with the longest text (see the tests of ``textbuf``); an
empty table gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.graph import components
from martlake.llm.tables import dropped, stored, written
from martlake.llm.textbuf import SpanHash, TextBuf, chunks, mix64, ngram_hash, whole

FOLD = 16
SPLIT = 4096
#: Members of a bucket in one row of the bucket table.
ROW_MEMBERS = 4096
#: Nodes that a task remembers, to send copies on once.
REMEMBERED = 200_000
#: Largest set size that the bands are laid out for.
LARGEST = 1 << 36

_U = np.uint64
_FIRST, _SECOND = _U(0x1F83D9ABFB41BD6B), _U(0x5BE0CD19137E2179)


@dataclass(frozen=True)
class Join:
    """Word n-gram length, and the similarity ``num / den`` from which sets link."""

    n: int = 5
    num: int = 80
    den: int = 100

    def most_different(self, total):
        """Largest symmetric difference of linked sets with ``total`` members in all."""
        return total * (self.den - self.num) // (self.den + self.num)

    def bands(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Smallest size, number of blocks, and spare blocks of each band."""
        low, blocks, spare, lo, before = [], [], [], 1, 1
        while lo < LARGEST:
            hi = lo * self.den // self.num
            need = self.most_different(2 * hi) + 1
            empty = need * np.exp(-before / need) if need > 1 else 0.0
            e = int(np.ceil(empty + 4 * np.sqrt(empty)))
            low.append(lo)
            blocks.append(need + e)
            spare.append(e)
            lo, before = hi + 1, lo
        return np.array(low), np.array(blocks, dtype=np.int64), np.array(spare, dtype=np.int64)


def shingle_sets(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Document and hash of every distinct n-gram, sorted by both."""
    t = TextBuf(texts, lower=True)
    start, end, doc = t.words
    word = SpanHash(t.text, 4)(start, end)
    inside = whole(doc, n)
    docs, grams = [doc[: len(inside)][inside]], [ngram_hash(word, doc, n)[inside]]
    n_words = t.count(doc)
    first = np.cumsum(n_words) - n_words
    for k in range(1, n):  # fewer words: all of them as one n-gram
        at = np.flatnonzero(n_words == k)
        docs.append(at)
        grams.append(ngram_hash(word, doc, k)[first[at]])
    d, g = np.concatenate(docs), np.concatenate(grams)
    order = np.lexsort((g, d))
    d, g = d[order], g[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (g[1:] != g[:-1])
    return d[new], g[new]


def _sums(values: np.ndarray, d: np.ndarray, n_docs: int) -> np.ndarray:
    total = np.concatenate((np.zeros(1, _U), np.cumsum(values, dtype=_U)))
    cut = np.searchsorted(d, np.arange(n_docs + 1))
    return total[cut[1:]] - total[cut[:-1]]


def nodes(d: np.ndarray, g: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Set size and node of each document."""
    size = np.bincount(d, minlength=n_docs)
    return size, mix64(_sums(mix64(g ^ _FIRST), d, n_docs) + size.astype(_U)).view(np.int64)


def _blocks(d, g, blocks, tag) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, block number and XOR of the blocks that have n-grams."""
    if not len(d):
        return d, d, g
    at = ((g >> _U(32)) * blocks[d].astype(_U)) >> _U(32)
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (at[1:] != at[:-1])
    cut = np.flatnonzero(new)
    return d[cut], at[cut].astype(np.int64), np.bitwise_xor.reduceat(mix64(g + tag), cut)


def _key(*parts) -> np.ndarray:
    out = np.zeros(1, _U)
    for p in parts:
        out = mix64(np.atleast_1d(np.asarray(p)).astype(_U) ^ out * _U(0x9E3779B97F4A7C15) + _U(1))
    return out


def second_sketch(d, g):
    """The sets under other hashes, sorted by document and hash."""
    other = mix64(g ^ _SECOND)
    order = np.lexsort((other, d))
    return d[order], other[order]


def band_keys(d, g, size, join: Join, bands, parity: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Document and key of all blocks under which its partners can be found, or of
    those in even (``parity`` 0) or odd (1) bands."""
    low, blocks, spare = bands
    own = np.maximum(np.searchsorted(low, size, side="right") - 1, 0)
    docs, keys = [], []
    for step in (0, 1):  # partners of at most its own band, and of the next one
        band = own + step
        now = size > 0 if parity is None else (size > 0) & (band % 2 == parity)
        m = now[d]
        b_doc, b_at, b_xor = _blocks(d[m], g[m], blocks[band], _U(0))
        docs.append(b_doc)
        keys.append(_key(band[b_doc], b_at, b_xor))
        empty = blocks[band] - np.bincount(b_doc, minlength=len(size))
        for x in np.flatnonzero((empty > spare[band]) & now):
            gone = np.setdiff1d(np.arange(blocks[band[x]]), b_at[b_doc == x])
            mine = d == x
            o_d, o_g = second_sketch(d[mine], g[mine])
            s_doc, s_at, s_xor = _blocks(o_d, o_g, blocks[band], _U(1))
            pairs = _key(
                band[x], np.repeat(gone, len(s_at)), 7, np.tile(s_at, len(gone)), np.tile(s_xor, len(gone))
            )
            if blocks[band[x]] - len(s_at) > spare[band[x]]:  # too empty in both: one bucket a band
                pairs = np.append(pairs, _key(band[x], 11))
            docs.append(np.full(len(pairs), x))
            keys.append(pairs)
    return np.concatenate(docs), np.concatenate(keys)


def folded(d, g, n_docs: int) -> np.ndarray:
    """Parity of one-hot bits, ``FOLD`` words a document."""
    out = np.zeros((n_docs, FOLD), dtype=_U)
    bit = _U(1) << (g & _U(63))
    np.bitwise_xor.at(out, (d, ((g >> _U(6)) & _U(FOLD - 1)).astype(np.int64)), bit)
    return out


def profiles(docs: DataFrame, join: Join) -> DataFrame:
    """(doc_id, size, node, bits) per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            d, g = shingle_sets(texts, join.n)
            size, node = nodes(d, g, len(texts))
            bits = folded(d, g, len(texts)).view(np.int64)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, bits.size + 1, FOLD, dtype=np.int32)), pa.array(bits.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size), pa.array(node), lists], ["doc_id", "size", "node", "bits"]
            )

    return docs.mapInArrow(run, "doc_id long, size long, node long, bits array<long>")


def _pairs_table(*columns, names=("key", "node")) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], list(names))


def block_rows(docs: DataFrame, join: Join, parity: int | None = None) -> DataFrame:
    """(key, node): a row per key (of the even or odd bands, see ``band_keys``);
    equal sets are sent on once by each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, sent = join.bands(), set()
        for _, texts in chunks(batches):
            d, g = shingle_sets(texts, join.n)
            size, node = nodes(d, g, len(texts))
            if len(sent) > REMEMBERED:
                sent.clear()
            fresh = np.zeros(len(texts), bool)
            for i, x in enumerate(node.tolist()):
                fresh[i] = x not in sent
                sent.add(x)
            m = fresh[d]
            d, g = d[m], g[m]
            doc, key = band_keys(d, g, np.where(fresh, size, 0), join, bands, parity)
            yield _pairs_table(key.view(np.int64), node[doc])

    return docs.mapInArrow(run, "key long, node long")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets of two or more nodes from rows sorted by key and node, once for
    each set of members seen.  A bucket too long for one row goes on in further
    rows under the same id; its first node comes first in each."""
    said: set[int] = set()

    def rows(found):
        if found:
            ids, lists, single = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(lists, pa.list_(pa.int64())), pa.array(single, pa.bool_())],
                ["bucket", "members", "single"],
            )

    left_key, left = np.zeros(0, np.int64), np.zeros(0, np.int64)
    lead = None  # (key, first node) of a bucket whose earlier members are gone

    def cut(key, node, last):
        nonlocal left_key, left, lead
        found = []
        start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        end = np.append(start[1:], len(key))
        if not last:  # the last key may go on
            left_key, left = key[start[-1]:], node[start[-1]:]
            start, end = start[:-1], end[:-1]
            if len(left) > ROW_MEMBERS:
                k = int(left_key[0])
                if lead is None or lead[0] != k:
                    lead = (k, int(left[0]))
                found.append((k, [lead[1], *left[left != lead[1]].tolist()], False))
                left_key, left = left_key[:1], np.array([lead[1]])
        marks = np.add.reduceat(mix64(node[: end[-1]]), start) if len(start) else np.zeros(0, _U)
        for s, e, mark in zip(start, end, marks.tolist()):
            k = int(key[s])
            if e - s < 2 or (mark in said and (lead is None or lead[0] != k)):
                continue
            if len(said) > REMEMBERED:
                said.clear()
            said.add(mark)
            if lead is not None and lead[0] == k:
                found.append((k, node[s:e].tolist(), False))
                continue
            for a in range(s + 1, e, ROW_MEMBERS):
                part = node[a : min(e, a + ROW_MEMBERS)].tolist()
                found.append((k, [int(node[s]), *part], len(part) == e - s - 1))
        return rows(found)

    for batch in batches:
        key, node = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        key, node = np.concatenate((left_key, key)), np.concatenate((left, node))
        if len(key):
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
            yield from cut(key[new], node[new], False)
    if len(left):
        yield from cut(left_key, left, True)


def buckets(parts: Iterable[DataFrame], tag: str) -> DataFrame:
    """(bucket, members) of all keys with two or more nodes; equal member lists
    that fit one row count once over all tasks.  The parts, (key, node), have no key
    in common; the rows of one have left the disk when the next one begins."""
    found = []
    for rows in parts:
        sorted_rows = rows.repartition("key").sortWithinPartitions("key", "node")
        found.append(stored(sorted_rows.mapInArrow(_runs, "bucket long, members array<long>, single boolean"), tag))
    lists = reduce(DataFrame.unionByName, [x for x, _ in found])
    once = lists.filter("single").dropDuplicates(["members"]).unionByName(lists.filter("not single"))
    once = written(once.drop("single"), f"{tag}-once")
    dropped(lists.sparkSession, *(folder for _, folder in found))
    return once


def linked(pairs: DataFrame, docs: DataFrame, known: DataFrame, join: Join) -> DataFrame:
    """Those pairs (a, b) of nodes that link.  ``known`` has node, doc_id (of
    one document with that set), size and bits."""
    side = lambda c: known.select(
        F.col("node").alias(c), F.col("size").alias(f"{c}_size"), F.col("bits").alias(f"{c}_bits")
    )
    apart = F.aggregate(
        F.zip_with("a_bits", "b_bits", lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0), lambda acc, x: acc + x,
    )
    total = F.col("a_size") + F.col("b_size")
    near = (
        pairs.join(side("a"), "a").join(side("b"), "b")
        .filter((join.den * F.least("a_size", "b_size") >= join.num * F.greatest("a_size", "b_size"))
                & ((join.den + join.num) * apart <= (join.den - join.num) * total))
        .select("a", "b")
    )
    near, pairs_folder = stored(near, "near-pairs")
    wanted = near.select(F.col("a").alias("node")).union(near.select(F.col("b").alias("node"))).distinct()
    wanted = wanted.join(known.select("node", "doc_id"), "node").select(F.col("doc_id").alias("id"), "node")
    texts = docs.join(wanted.hint("shuffle_hash"), docs["doc_id"] == wanted["id"]).select("node", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in chunks(batches):
            d, g = shingle_sets(raw, join.n)
            _, node = nodes(d, g, len(raw))
            cut = np.searchsorted(d, np.arange(len(raw) + 1))
            same = np.flatnonzero(node == batch.column(0).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[same]), pa.array([g[cut[i] : cut[i + 1]].tobytes() for i in same], pa.binary())],
                ["node", "grams"],
            )

    grams, sets_folder = stored(texts.mapInArrow(sets, "node long, grams binary").dropDuplicates(["node"]), "node-sets")
    num, den = join.num, join.den

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(x.as_py(), _U), np.frombuffer(y.as_py(), _U)
                both = len(np.intersect1d(a, b, assume_unique=True))
                ok.append(den * both >= num * (len(a) + len(b) - both))
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    full = near.join(grams.select(F.col("node").alias("a"), F.col("grams").alias("x")), "a").join(
        grams.select(F.col("node").alias("b"), F.col("grams").alias("y")), "b"
    )
    links = written(full.select("a", "b", "x", "y").mapInArrow(verify, "a long, b long"), "links")
    dropped(docs.sparkSession, pairs_folder, sets_folder)
    return links


def _open_members(lists: DataFrame, comps: DataFrame) -> DataFrame:
    """(bucket, node, component, members) of buckets with several components."""
    rows = lists.select(F.xxhash64("bucket", F.element_at("members", 1)).alias("bucket"),
                        F.explode("members").alias("node"))
    rows = rows.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rows = written(rows, "bucket-members")
    mixed = (
        rows.groupBy("bucket")
        .agg(F.min("component").alias("c1"), F.max("component").alias("c2"), F.count(F.lit(1)).alias("members"))
        .filter("c1 <> c2")
    )
    return written(rows.join(mixed.select("bucket", "members"), "bucket").distinct(), "open-members")


def near_rows(size: np.ndarray, bits: np.ndarray, part: np.ndarray, join: Join) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all pairs of different components whose sizes and sketches
    allow a link; some rows against all later ones at a time."""
    step = max(1, (1 << 16) // max(1, len(size)))
    for at in range(0, len(size), step):
        to = min(at + step, len(size))
        i, j = np.nonzero((part[at:to, None] != part[None, at:]) & (np.arange(at, to)[:, None] < np.arange(at, len(size))[None]))
        i, j = i + at, j + at
        m = join.den * np.minimum(size[i], size[j]) >= join.num * np.maximum(size[i], size[j])
        i, j = i[m], j[m]
        apart = np.bitwise_count(bits[i] ^ bits[j]).sum(1, dtype=np.int64)
        m = (join.den + join.num) * apart <= (join.den - join.num) * (size[i] + size[j])
        if m.any():
            yield i[m], j[m]


def _cross(members: DataFrame, known: DataFrame, join: Join) -> DataFrame:
    """Pairs of members of a bucket that are in different components so far
    and whose sketches allow a link.  Sketches are compared within a task,
    some rows at a time; only pairs that pass leave it."""
    rows = members.select("bucket", "node", "component").join(known.select("node", "size", "bits"), "node")
    rows = rows.select("bucket", "node", "component", "size", "bits").repartition("bucket").sortWithinPartitions("bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def pairs(parts):
            node, part, size = (np.concatenate([p[k] for p in parts]) for k in range(3))
            bits = np.concatenate([p[3] for p in parts])
            for i, j in near_rows(size, bits, part, join):
                a, b = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
                yield _pairs_table(a, b, names=("a", "b"))

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            bucket, node, part, size = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            bits = batch.column(4).flatten().to_numpy(zero_copy_only=False).view(_U).reshape(-1, FOLD)
            start = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
            for s, e in zip(start, np.append(start[1:], len(bucket))):
                if held and last != bucket[s]:
                    yield from pairs(held)
                    held = []
                last = bucket[s]
                held.append((node[s:e], part[s:e], size[s:e], bits[s:e]))
        if held:
            yield from pairs(held)

    return rows.mapInArrow(run, "a long, b long")


def _resketched(members: DataFrame, docs: DataFrame, known: DataFrame, join: Join) -> DataFrame:
    """Large buckets split by the second sketch: (bucket, node, component)."""
    ids = known.select("node", F.col("doc_id").alias("id")).join(
        members.select("node").distinct(), "node", "left_semi"
    )
    texts = docs.join(ids.hint("shuffle_hash"), docs["doc_id"] == ids["id"]).select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = join.bands()
        for batch, raw in chunks(batches):
            d, g = shingle_sets(raw, join.n)
            size, node = nodes(d, g, len(raw))
            doc, key = band_keys(*second_sketch(d, g), size, join, bands)
            same = (node == batch.column(0).to_numpy(zero_copy_only=False))[doc]
            yield _pairs_table(key.view(np.int64)[same], node[doc[same]])

    keys = texts.mapInArrow(run, "key long, node long").distinct()
    return members.join(keys, "node").select(F.xxhash64("bucket", "key").alias("bucket"), "node", "component")


def similarity_components(docs: DataFrame, join: Join) -> DataFrame:
    """Per document row with an id: doc_id, n_shingles, component_id (the
    smallest doc_id reachable by links, its own included)."""
    docs = docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), "text")
    profile = written(profiles(docs, join), "profiles")
    known = written(
        profile.filter("size > 0").groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.min_by("size", "doc_id").alias("size"),
            F.min_by("bits", "doc_id").alias("bits"),
        ), "nodes",
    )
    lists = buckets((block_rows(docs, join, parity) for parity in (0, 1)), "buckets")
    first = F.element_at("members", 1)
    star = lists.select(first.alias("a"), F.explode("members").alias("b")).filter("a <> b").distinct()
    links = linked(star, docs, known, join)
    comps = written(components(links), "components")
    rest = _open_members(lists, comps)
    if not rest.isEmpty():
        large = rest.filter(F.col("members") > SPLIT)
        pairs = _cross(rest.filter(F.col("members") <= SPLIT), known, join)
        if not large.isEmpty():
            pairs = pairs.union(_cross(_resketched(large, docs, known, join), known, join))
        # pairs of a bucket's first node were looked at above
        pairs = pairs.distinct().join(
            star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"
        )
        links = links.union(linked(pairs, docs, known, join))
        comps = written(components(links), "components")
    # the least document of each component, then back to every document
    of_node = known.join(comps, "node", "left").select(
        "node", "doc_id", F.coalesce("component", "node").alias("component")
    )
    least = of_node.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = of_node.join(least, "component").select(F.col("node").alias("at"), "component_id")
    named = written(named, "named")
    out = profile.select("doc_id", F.col("size").alias("n_shingles"), F.when(F.col("size") > 0, F.col("node")).alias("node"))
    spread = F.coalesce(F.col("node"), F.xxhash64("doc_id"))
    return out.join(named, (spread == F.col("at")) & F.col("node").isNotNull(), "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )
