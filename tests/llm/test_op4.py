from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from martlake.llm.queries import QUERIES, TOKENIZER
from martlake.llm.token_shortcut import Counter, merge_ranks, proven_singles, token_counts
from tests.conftest import SF001
from tests.llm.helpers import ODD_TEXTS, by_id, make_docs, table_rows

SPEC = open(public_tokenizers.path(TOKENIZER), encoding="utf-8").read()


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_str(SPEC)


@pytest.fixture(scope="module")
def counter():
    return Counter(SPEC, proven_singles(SPEC))


def check(got, rows, tok):
    assert len(got) == len(rows)
    for d, t in rows:
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        assert tuple(got[d]) == (d, len((t or "").encode()), n, n > 1024), (d, t and t[:80])


def test_whole_table(spark, tok):
    check(by_id(QUERIES["op4_token_counts"](spark, SF001)), table_rows("documents", SF001), tok)


def test_odd_texts(spark, tok):
    texts = [*ODD_TEXTS, "a<|endoftext|> b  <|endoftext|><|endoftext|>", " " * 3000, "word " * 1024, "word " * 1023]
    docs = make_docs(spark, texts).withColumnRenamed("lang", "n_tokens")
    check(by_id(token_counts(docs, SPEC)), list(enumerate(texts)), tok)
    assert token_counts(docs.limit(0), SPEC).count() == 0


def test_every_character(counter, tok):
    """All code points beside a letter, a digit, a sign and white space."""
    chars = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000 and (i < 0x3200 or i % 61 == 0 or 0x1E000 < i < 0x1FC00)]
    texts = ["".join(f"a{c}1{c}!{c} {c}\n" for c in chars[k : k + 50]) for k in range(0, len(chars), 50)]
    want = [len(e.ids) for e in tok.encode_batch(texts, add_special_tokens=False)]
    assert counter.count(texts) == want


def test_random_strings_by_both_merges(counter, tok):
    rng = random.Random(5)
    alphabet = "aaeinorst  thing\n\t'sllre0123!?.,éüß漢字😀  "
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    want = [len(e.ids) for e in tok.encode_batch(texts, add_special_tokens=False)]
    assert counter.count(texts) == want
    library = Counter(SPEC, [])
    library.by_rank = None
    assert library.count(texts) == want


def test_singles_are_single(tok):
    singles = proven_singles(SPEC)
    assert len(singles) > 40_000 and merge_ranks(SPEC)
    assert all(len(e.ids) == 1 for e in tok.encode_batch(singles, add_special_tokens=False))
