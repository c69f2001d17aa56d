from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from martlake import session
from martlake.llm import weak_toxicity
from martlake.llm.line_dedup import MIN_DOCS
from tests.conftest import SF001
from tests.llm.helpers import words
from tests.llm.test_op10 import STRIP, lower_az
from tests.llm.test_op5 import brute as brute_mix
from tests.llm.test_op6 import brute as brute_leaks
from tests.llm.test_op7 import brute as brute_groups
from martlake.llm import mixing


def brute_lines(rows):
    holders = {}
    key = lambda x: lower_az(x.strip(STRIP))
    for d, t in rows:
        for x in t.split("\n"):
            if len(key(x)) >= 40:
                holders.setdefault(key(x), set()).add(d)
    common = {k: max(h) for k, h in holders.items() if len(h) >= MIN_DOCS}
    return [(d, "\n".join(x for x in t.split("\n") if common.get(key(x), d) == d)) for d, t in rows]


def test_every_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns = docs.columns
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SF001), f"test-{name}")
        out[name] = {r.doc_id: r for r in docs.collect()}
        if name != "mixing":
            assert docs.columns == columns
    first = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    predicted = weak_toxicity.toxicity(spark.read.parquet(f"{SF001}/documents.parquet"), labels).collect()
    rows = sorted((r.doc_id, first[r.doc_id]) for r in predicted if not r.predicted)
    assert {d: r.text for d, r in out["toxicity"].items()} == dict(rows)
    assert len(rows) < len(first)
    rows = brute_lines(rows)
    assert {d: r.text for d, r in out["line_dedup"].items()} == dict(rows)
    assert all(r.n_chars == len(r.text) for r in out["line_dedup"].values())
    keep = {d for d, _, c in brute_groups(rows, corpus_pipeline.NEAR) if c == d}
    rows = [r for r in rows if r[0] in keep]
    assert {d: r.text for d, r in out["near_duplicates"].items()} == dict(rows)
    bench = [tuple(r) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {d for d, *_ in brute_leaks(rows, bench)}
    rows = [r for r in rows if r[0] not in bad]
    assert {d: r.text for d, r in out["decontamination"].items()} == dict(rows)
    before = out["decontamination"]
    leaves = [
        (d, mixing.DOMAINS[int(before[d].source[3:]) % len(mixing.DOMAINS)], before[d].lang, before[d].source, len(words(t)))
        for d, t in rows if words(t)
    ]
    want, _ = brute_mix(leaves, mixing.WEIGHTS, None, mixing.MAX_EPOCHS, mixing.SEED)
    assert {d: r.copies for d, r in out["mixing"].items()} == {r[0]: r[5] for r in want}
    assert list(out["mixing"][want[0][0]].asDict()) == [*columns, "domain", "copies"]


def test_stages_take_empty_tables_and_nulls(spark):
    docs = spark.createDataFrame(
        [(1, None, None, None, None), (None, "x", "en", "s", 1), (2, "", "en", None, 0), (3, "a b c", None, "s", 5), (3, "a b c", None, "s", 5)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF001).count() == 0
        got = stage(spark, docs, SF001)
        if name == "mixing":  # equal rows are chosen one by one
            chosen = mixing.choose(docs.withColumn("domain", mixing.domain_of()))
            assert sorted(r["doc_id"] or 0 for r in got.collect()) == sorted(r["doc_id"] or 0 for r in chosen.collect())
            assert 1 <= got.count() <= 3
        else:
            assert got.count() == 5, name


def test_stages_take_extra_columns_of_the_names_they_make(spark):
    """Columns named like those that stages and operators make inside pass through."""
    names = ["row", "id", "keep", "number", "n", "at", "word", "votes", "places", "score", "node", "key", "lang_", "_row", "_id",
             "_keep", "place", "reading", "window", "size", "found", "hit", "toxic", "domain", "copies"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "*", *(F.lit(i).alias(n) for i, n in enumerate(names))
    )
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        got, want = stage(spark, docs, "/root/testdata/sf0.001"), stage(spark, plain, "/root/testdata/sf0.001")
        assert len(set(got.columns)) == len(got.columns), name
        key = lambda df: sorted(map(tuple, df.select(*plain.columns).collect()))
        assert key(got) == key(want), name
        extra = [n for n in names if name != "mixing" or n not in ("domain", "copies")]
        assert got.select(*extra).distinct().count() == (1 if got.count() else 0), name


def test_mix_stage_returns_equal_rows_as_often_as_they_are_chosen(spark):
    from martlake.llm import mixing

    one = "word " * 10
    docs = spark.createDataFrame(
        [(1, one, "en", "s0", 50)] * 100 + [(2, one, "en", "s1", 50)] * 4, "doc_id long, text string, lang string, source string, n_chars long"
    )
    chosen = mixing.choose(docs.withColumn("domain", mixing.domain_of()))
    got = mixing.mix_stage(docs)
    want = sorted((r["doc_id"], r["copies"]) for r in chosen.collect())
    assert len(want) < 104 and sorted((r["doc_id"], r["copies"]) for r in got.collect()) == want


def test_stages_leave_no_whole_texts_behind(spark, tmp_path, monkeypatch):
    """Scratch tables that stay until the run ends hold no texts, and large ones go
    as soon as the next one is written."""
    monkeypatch.setattr(session, "scratch_root", lambda spark: str(tmp_path))
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        assert 0 < stage(spark, docs, SF001).count() <= docs.count()
    left = {p.name.rsplit("-", 1)[0]: p for p in (tmp_path / "martlake").iterdir()}
    assert {"word-places", "line-stream", "links"} <= set(left)
    assert not {"line-keys", "near-pairs", "node-sets"} & set(left)
    assert not any("text" in spark.read.parquet(str(p)).columns for p in left.values())
