from __future__ import annotations

import re
from collections import Counter

from martlake.llm.queries import QUERIES
from martlake.llm.repetition import NGRAM_LIMITS, repetition_measures, verdict
from tests.conftest import SF001
from tests.llm.helpers import ODD_TEXTS, by_id, make_docs, table_rows, words


def brute(text):
    w = words(text)
    n = len(w)

    def cover(size, first):
        seen, marked = Counter(tuple(w[i : i + size]) for i in range(n - size + 1)), set()
        before = set()
        for i in range(n - size + 1):
            g = tuple(w[i : i + size])
            if (seen[g] > 1 and first) or g in before:
                marked.update(range(i, i + size))
            before.add(g)
        return marked

    lines = [x for x in (text or "").split("\n") if words(x)]
    early, dup, dup_chars = set(), 0, 0
    for x in lines:
        if x in early:
            dup += 1
            dup_chars += sum(map(len, words(x)))
        early.add(x)
    out = {
        "n_words": n, "word_chars": sum(map(len, w)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": dup, "n_repeat_words": len(cover(3, True)),
        "n_lines": len(lines), "dup_line_chars": dup_chars,
    }
    for size in NGRAM_LIMITS:
        out[f"dup_chars_{size}"] = sum(len(w[i]) for i in cover(size, False))
    base = n < 50 or 100 * out["n_repeat_words"] > 50 * n
    bad = dup > 0.3 * len(lines) or dup_chars > 0.2 * out["word_chars"] or any(
        out[f"dup_chars_{k}"] > s * out["word_chars"] for k, s in NGRAM_LIMITS.items()
    )
    return out | {"base_failed": base, "kept": not base and not bad}


def check(got, texts):
    for i, t in texts:
        want = brute(t)
        assert {k: got[i][k] for k in want} == want, (i, t and t[:80])


def test_whole_table(spark):
    got = by_id(QUERIES["op9_quality_rules"](spark, SF001))
    rows = table_rows("documents", SF001)
    assert len(got) == len(rows)
    check(got, rows)


def test_odd_texts(spark):
    docs = make_docs(spark, ODD_TEXTS).withColumnRenamed("lang", "n_words")  # a clashing name
    got = by_id(verdict(repetition_measures(docs)))
    check(got, list(enumerate(ODD_TEXTS)))
    assert verdict(repetition_measures(docs.limit(0))).count() == 0


def test_null_id_passes(spark):
    docs = make_docs(spark, ["a b"]).selectExpr("cast(null as long) doc_id", "text")
    assert [r["doc_id"] for r in repetition_measures(docs).collect()] == [None]
