from __future__ import annotations

import zlib

import numpy as np
import pytest

from martlake.llm.queries import QUERIES
from martlake.llm.weak_toxicity import LEXICON, VOTERS, LabelModel, Reader, drop_toxic, held_out, mine, toxicity
from tests.conftest import SF01
from tests.llm.helpers import ODD_TEXTS, by_id, make_docs, table_rows

SF1 = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scored(spark):
    return by_id(QUERIES["op3_toxicity"](spark, SF1))


def test_held_out_accuracy(scored):
    labels = dict(table_rows("labels", SF1, "doc_id, toxic"))
    text = dict(table_rows("documents", SF1))
    assert set(scored) == set(text)
    for d, r in scored.items():
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [d for d in labels if scored[d]["held_out"]]
    right = sum(scored[d]["predicted"] == labels[d] for d in held) / len(held)
    assert right > 0.96  # about 2 % of the labels are turned round
    # AUC on held-out rows
    pos = [scored[d]["score"] for d in held if labels[d]]
    neg = [scored[d]["score"] for d in held if not labels[d]]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc > 0.85
    # clean texts are left alone: rows labelled 0 are hardly ever predicted 1
    wrong = sum(scored[d]["predicted"] for d in held if not labels[d])
    assert wrong < 0.02 * len(held)
    # a listed insult is always caught
    reader = Reader()
    n_words = len(LEXICON)
    insulting = [d for d, t in text.items() if reader.read(t)[0] & ((1 << n_words) - 1)]
    assert sum(scored[d]["predicted"] for d in insulting) > 0.98 * len(insulting)


def test_scores_read_only_texts(spark):
    """Labels of held-out rows, and other columns, change nothing."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    first = by_id(toxicity(docs, labels))
    turned = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - toxic, toxic) toxic")
    other = docs.selectExpr("doc_id", "text", "'x' lang", "'y' source", "0L score", "1 toxic")
    second = by_id(toxicity(other, turned))
    assert {d: round(r["score"], 9) for d, r in first.items()} == {d: round(r["score"], 9) for d, r in second.items()}


def test_odd_rows_and_no_labels(spark):
    docs = make_docs(spark, [*ODD_TEXTS, "you are an IDIOT and a moron, pathetic"])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = by_id(toxicity(docs, none))
    assert len(got) == len(ODD_TEXTS) + 1
    assert got[len(ODD_TEXTS)]["predicted"] == 1 and not any(got[i]["predicted"] for i in range(len(ODD_TEXTS)))
    odd = spark.createDataFrame([(1, None), (None, 1), (2, 7), (3, 1), (3, 0)], "doc_id long, toxic int")
    assert toxicity(docs, odd).count() == len(ODD_TEXTS) + 1
    assert toxicity(docs.limit(0), none).count() == 0
    kept = drop_toxic(docs.union(docs.limit(2)), none)
    assert kept.columns == docs.columns and kept.count() == len(ODD_TEXTS) + 2


def test_label_model_recovers_accuracies_and_correlation():
    rng = np.random.default_rng(0)
    n, k = 40_000, len(VOTERS)
    y = rng.random(n) < 0.2
    hit = rng.random((n, k)) < np.where(y[:, None], np.linspace(0.2, 0.6, k), np.linspace(0.02, 0.1, k))
    copy = rng.random(n) < 0.8
    hit[:, 1] = np.where(copy, hit[:, 0], hit[:, 1])  # voter 1 mostly repeats voter 0
    masks = (hit * (1 << np.arange(k))).sum(1)
    labels = np.where(rng.random(n) < 0.3, np.where(rng.random(n) < 0.95, y, ~y).astype(int), -1)
    keys, counts = np.unique(np.stack([masks, labels]), axis=1, return_counts=True)
    model = LabelModel(k).fit(keys[0], keys[1], counts.astype(float))
    assert (0, 1) in model.cliques
    assert abs(model.rate - 0.2) < 0.02 and abs(model.label[1, 1] - 0.95) < 0.03
    for clique, table in zip(model.cliques, model.tables):
        if len(clique) == 1:
            assert abs(table[1, 1] - np.linspace(0.2, 0.6, k)[clique[0]]) < 0.05
    p = model.posterior(masks, np.full(n, -1))
    assert np.mean((p > 0.5) == y) > 0.9


def test_rare_insults_that_no_list_has(spark):
    """Insults with many forms, each in under 0.1 % of all rows, and one or two in
    a text: found in held-out rows; clean rows are left alone."""
    rng = np.random.default_rng(8)
    syllables = ["ba", "de", "ki", "lo", "mu", "ne", "ra", "so", "ti", "vu", "zen", "por", "gal", "min"]
    word = lambda: "".join(rng.choice(syllables, rng.integers(1, 4)))
    roots = ["xanthu", "qorbel", "wyvra", "jiskol"]
    texts, toxic = [], []
    for i in range(12_000):
        words = [word() for _ in range(int(rng.integers(20, 60)))]
        bad = rng.random() < 0.03
        for _ in range(int(rng.integers(1, 3)) if bad else 0):
            words.insert(int(rng.integers(0, len(words))), str(rng.choice(roots)) + str(rng.choice(syllables)))
        texts.append(" ".join(words))
        toxic.append(int(bad))
    docs = make_docs(spark, texts).repartition(4)
    said = [(i, int(t) ^ int(rng.random() < 0.02)) for i, t in enumerate(toxic) if i % 10]
    labels = spark.createDataFrame(said, "doc_id long, toxic int")
    got = by_id(toxicity(docs, labels))
    test = [i for i in range(len(texts)) if got[i]["held_out"]]
    caught = [got[i]["predicted"] for i in test if toxic[i]]
    wrong = [got[i]["predicted"] for i in test if not toxic[i]]
    assert np.mean(caught) > 0.95 and np.mean(wrong) < 0.005
    units = mine(docs.join(labels, "doc_id").filter(~held_out()).select("text", "toxic"))
    assert all(any(r.startswith(u.lstrip("=")) or u.lstrip("=").startswith(r) for u in units) for r in roots)


def test_extra_columns_pass(spark):
    docs = make_docs(spark, ["a fine text", "you are an idiot and a moron", None]).selectExpr(
        "*", "1 AS votes", "2 AS places", "3 AS score", "4 AS toxic", "5 AS Votes_"
    )
    labels = spark.createDataFrame([(0, 0), (1, 1)], "doc_id long, toxic int").selectExpr("*", "7 AS text", "8 AS votes")
    kept = drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2]
    assert toxicity(docs, labels).columns == ["doc_id", "held_out", "score", "predicted"]


def test_texts_do_not_pass_through_python_to_be_scored(spark):
    """Scoring sends votes and word places to Python; other columns stay."""
    texts = ["fine words here"] * 30 + ["you idiot"] * 10 + [None, ""]
    docs = make_docs(spark, texts).selectExpr("*", "5 AS `a.b`")
    labels = spark.createDataFrame([(i, int(t == "you idiot")) for i, t in enumerate(texts)], "doc_id long, toxic int")
    out = drop_toxic(docs, labels)
    assert out.columns == docs.columns
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "ArrowEvalPython" in plan
    assert {r["a.b"] for r in out.collect()} == {5}
