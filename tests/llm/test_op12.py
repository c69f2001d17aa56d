from __future__ import annotations

import hashlib
import os
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from public_tokenizers import path
from tokenizers import Tokenizer

from martlake.llm import token_alignment as ta
from martlake.llm.queries import QUERIES, alignment_vocabularies
from tests.llm.helpers import ODD_TEXTS, make_docs, table_rows

SF001 = "/root/testdata/sf0.001"
NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
MORE = [
    "▁a", "a ▁ b", "<s> </s> <unk> <0x41>", "it's  we'll you", "a  b", "\x1c x \x85 y", " lead and trail ",
    "emoji \U0001f469‍\U0001f680 in text", "é é", "́ x ́", "tab\tbetween words\r\nnext  line",
    "one two three " * 300, "x" * 3000 + " " + "y" * 10, "ﬁ ½ Ⅷ",
]


@pytest.fixture(scope="module")
def vocab():
    return alignment_vocabularies()


def brute(rows):
    """{row number: the seven columns}, from the libraries on whole texts."""
    a = Tokenizer.from_file(path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    letters = {c: i for c, i in ta._byte_letters().items()}
    found = {}
    for k, text in enumerate(rows):
        found[k] = None
        if not text:
            continue
        whole = (" " + text).encode()
        ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        ba = [bytes(letters[c] for c in a.id_to_token(i)) for i in ia]
        bb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        if b"".join(ba) != whole or b"".join(bb) != whole:
            continue
        ea, eb = np.cumsum([len(x) for x in ba]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
        cuts = sorted(set(ea) & set(eb))
        groups, links, pa, pb = [], [], 0, 0
        for c in cuts:
            qa, qb = ea.index(c, pa) + 1, eb.index(c, pb) + 1
            groups.append(",".join(map(str, ia[pa:qa])) + "|" + ",".join(map(str, ib[pb:qb])))
            for x in range(pa, qa):
                for y in range(pb, qb):
                    if max(ea[x] - len(ba[x]), eb[y] - len(bb[y])) < min(ea[x], eb[y]):
                        links.append((ia[x], ib[y]))
            pa, pb = qa, qb
        found[k] = (len(ia), len(ib), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest())
    count = Counter(p for f in found.values() if f for p in set(f[3]))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    return {
        k: (0,) * 6 + ("",) if not f else (
            f[0], f[1], f[2], len(f[3]), sum(count[p] == best[p[0]] for p in f[3]), sum(count[p] for p in f[3]), f[4]
        )
        for k, f in found.items()
    }


def check(df, rows):
    got = df.collect()
    want = brute(rows)
    assert sorted(r["doc_id"] for r in got) == sorted(want)
    for r in got:
        assert tuple(r[c] for c in NUMBERS) == want[r["doc_id"]], r["doc_id"]


def test_whole_table_equals_brute_force(spark):
    rows = dict(table_rows("documents", SF001))
    assert sorted(rows) == list(range(len(rows)))
    check(QUERIES["op12_cross_tokenizer_alignment"](spark, SF001), [rows[i] for i in range(len(rows))])


def test_odd_texts(spark, vocab):
    texts = [*ODD_TEXTS, *MORE]
    check(ta.aligned(make_docs(spark, texts).repartition(3), vocab), texts)


def test_small_segments_lanes_and_lumps(spark, vocab, monkeypatch):
    """Many segments a text, lanes, batches and lumps: the same results.  The
    work is done in this process, where the smaller sizes hold."""
    texts = [*ODD_TEXTS, *MORE, "so it goes on and on, Größe über alles, 1234 5678 " * 40]
    whole = list(ta.Aligner(vocab).documents(iter(t or "" for t in texts)))
    for name, value in (("SEGMENT", 40), ("BATCH", 300), ("LANE", 3), ("REMEMBERED", 50)):
        monkeypatch.setattr(ta, name, value)
    cut = list(ta.Aligner(vocab).documents(iter(t or "" for t in texts)))
    assert len(whole) == len(cut) == len(texts)
    for x, y in zip(whole, cut):
        assert (x.n_a, x.n_b, x.n_groups, x.n_links, x.digest) == (y.n_a, y.n_b, y.n_groups, y.n_links, y.digest)
        assert (x.parts[0][0] == y.parts[0][0]).all() and (x.parts[0][1] == y.parts[0][1]).all()


def test_without_word_cut(vocab):
    """With no proof that words may be cut, texts are encoded whole: as with it."""
    uncut = ta.Vocabularies(vocab.spec, vocab.model, vocab.a_bytes, vocab.b_bytes, False)
    texts = [t or "" for t in [*ODD_TEXTS, *MORE]]
    assert vocab.cut
    one, two = (list(ta.Aligner(v).documents(iter(texts))) for v in (vocab, uncut))
    assert [(d.n_a, d.n_b, d.n_links, d.digest) for d in one] == [(d.n_a, d.n_b, d.n_links, d.digest) for d in two]


def test_lump_keeps_long_steps_and_large_counts(vocab):
    rng = np.random.default_rng(1)
    docs, want = [], []
    for n in (0, 3, 200_000, 1):
        d = ta.Document()
        keys = np.unique(rng.integers(0, 1 << 31, n))
        times = rng.integers(1, 2000, len(keys))
        d.parts, d.digest = [(keys, times)], ""
        docs.append(d)
        want.append(int((keys % 97 * times).sum()))
    row = ta._lump(0, [5, None, 7, 7], docs, ta.pa.int64()).to_pylist()[0]
    steps = np.frombuffer(row["steps"], np.uint16).astype(np.int64)
    times = np.frombuffer(row["counts"], np.uint8).astype(np.int64)
    names, first, got = np.array(row["keys"]), 0, []
    for n in row["sizes"]:
        at = np.cumsum(steps[first : first + n])
        got.append(int((names[at] % 97 * times[first : first + n]).sum()))
        first += n
    assert got == want and row["ids"] == [5, None, 7, 7]


def test_rows_ids_columns_and_empty_table(spark, vocab):
    rows = [(1, "b c", 7), (1, "b c", 7), (None, "b c", 7), (2, None, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a long").selectExpr(
        "*", "1 AS id", "2 AS lump", "'x' AS keys", "3 AS n", "4 AS key", "5 AS n_best"
    )
    got = ta.aligned(docs, vocab).collect()
    assert sorted((r["doc_id"] or 0, r["n_a"], r["count_sum"]) for r in got) == [(0, 2, 6), (1, 2, 6), (1, 2, 6), (2, 0, 0)]
    assert ta.aligned(docs.limit(0), vocab).count() == 0
    blank = ta.aligned(docs.filter("doc_id = 2"), vocab).collect()
    assert [tuple(blank[0][c] for c in NUMBERS) for _ in blank] == [(0,) * 6 + ("",)]


class _Counting:
    """A library whose encoded texts are counted."""

    def __init__(self, library):
        self.library, self.texts = library, 0

    def __getattr__(self, name):
        def call(texts, **how):
            self.texts += len(texts)
            return getattr(self.library, name)(texts, **how)

        return call


def test_words_are_encoded_together(vocab):
    """A gets many words as one text, and their tokens are as of each word alone,
    also where the texts' bytes do not tell the words apart."""
    words = sorted({w for t in [*ODD_TEXTS, *MORE, "so it goes 1234 Größe über don't $5 x́"] for w in (t or "").split() if w})
    books = [ta.WordBook(vocab) for _ in range(3)]
    books[0].a = _Counting(books[0].a)
    books[0].numbers([words])
    assert books[0].a.texts <= len(words) // 64 + 1
    order = list(books[0].number)
    books[1].learn(order)
    books[2].length[0] = np.where(np.arange(len(vocab.a_bytes)) == books[0].ids[0].data[0], 0, books[2].length[0])
    books[2].learn(order, True)  # falls back to single words
    for side in (0, 1):
        for name in ("ids", "first", "count"):
            one, *rest = (getattr(b, name)[side] for b in books)
            assert all(one.n == x.n and (one.data[: one.n] == x.data[: x.n]).all() for x in rest), name
    assert (books[0].valid.data[: len(order)] == books[1].valid.data[: len(order)]).all()


def test_tasks_of_a_process_share_the_libraries_and_use_one_thread(vocab, monkeypatch):
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    one, other = ta.WordBook(vocab), ta.WordBook(vocab)
    assert one.a is other.a and one.b is other.b
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
