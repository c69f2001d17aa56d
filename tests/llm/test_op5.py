from __future__ import annotations

import hashlib
from collections import defaultdict
from fractions import Fraction

from martlake.llm import mixing
from martlake.llm.oracle import ORACLE_SQL
from martlake.llm.queries import QUERIES
from tests.conftest import SF01
from tests.llm.helpers import ODD_TEXTS, make_docs, words
from tests.oracle_check import compare, duck

LEVELS = ("domain", "lang", "source")


def fill(budget, children):
    """Water-filling by repeated rounds: full children leave, the rest share."""
    open_, out, rest = dict(children), {}, budget
    while open_:
        total = sum(w for w, _ in open_.values())
        full = [k for k, (w, cap) in open_.items() if Fraction(w * rest, total) >= cap]
        if not full:
            return out | {k: w * rest // total for k, (w, _) in open_.items()}
        for k in full:
            out[k] = open_.pop(k)[1]
            rest -= out[k]
    return out


def brute(rows, weights, budget, epochs, seed):
    """rows: (doc_id, domain, lang, source, tokens) with tokens > 0."""
    leaves = defaultdict(int)
    for r in rows:
        leaves[r[1:4]] += r[4]
    weight = lambda level, x: max(0, weights.get(level, {}).get(x, 1))
    cap = {k: v * epochs * all(weight(level, x) for level, x in zip(LEVELS, k)) for k, v in leaves.items()}
    budgets = {(): min(sum(leaves.values()) if budget is None else budget, sum(cap.values()))}
    for depth, level in enumerate(LEVELS):
        children = defaultdict(lambda: defaultdict(int))
        for k, c in cap.items():
            if c:
                children[k[:depth]][k[: depth + 1]] += c
        for parent, kids in children.items():
            budgets |= fill(budgets[parent], {k: (weight(level, k[-1]), c) for k, c in kids.items()})
    out = []
    for leaf, tokens in leaves.items():
        full, rest = divmod(budgets.get(leaf, 0), tokens)
        order = sorted(
            (r for r in rows if r[1:4] == leaf),
            key=lambda r: hashlib.md5(f"{seed}:{full}:{r[0]}".encode()).hexdigest(),
        )
        run = 0
        for r in order:
            run += r[4]
            if full + (run <= rest):
                out.append((*r, full + (run <= rest)))
    return sorted(out), budgets


def test_matches_sql_on_whole_table(spark):
    key = "op5_source_mixing"
    info = compare(spark, duck(SF01), key, QUERIES[key], ORACLE_SQL[key], SF01)
    assert info["ok"], info


def test_budgets_and_prefixes(spark):
    texts = [("w " * (1 + i * 7 % 40)).strip() for i in range(900)]
    docs = make_docs(spark, texts).selectExpr(
        "doc_id", "text", "elt(int(1 + doc_id % 7 % 3), 'x', 'y', 'z') domain",
        "if(doc_id % 3 = 0, null, if(doc_id % 10 < 8, 'en', 'fr')) lang", "concat('s', if(doc_id < 500, 0, doc_id % 4)) source",
        "1 as budget", "2 as cap",  # clashing names
    ).repartition(3)
    rows = [(r.doc_id, r.domain, r.lang or "", r.source, len(words(r.text))) for r in docs.collect()]
    weights = {"domain": {"x": 7, "y": 1}, "lang": {"en": 3, "": 0}, "source": {"s0": 1, "s1": 6}}
    total = sum(r[4] for r in rows)
    for budget, epochs in ((None, 4), (total // 3, 1), (10 * total, 2), (17, 3), (0, 1)):
        got = mixing.choose(docs, LEVELS, weights, budget, epochs, 5).drop("row").collect()
        want, budgets = brute(rows, weights, budget, epochs, 5)
        assert sorted(map(tuple, got)) == want, (budget, epochs)
    assert want == [] and budgets[()] == 0


def test_odd_rows(spark):
    docs = make_docs(spark, ODD_TEXTS).withColumn("source", mixing.F.lit(None).cast("string"))
    got = mixing.mixture(docs).collect()
    assert {r.source for r in got} == {""} and {r.domain for r in got} == {mixing.DOMAINS[0]}
    assert {r.doc_id for r in got} == {i for i, t in enumerate(ODD_TEXTS) if words(t)}
    assert mixing.mixture(docs.limit(0)).count() == 0
    stage = mixing.mix_stage(docs.union(docs.limit(6)))
    assert stage.columns == [*docs.columns, "domain", "copies"] and stage.filter("copies < 1").isEmpty()


def test_domain_names(spark):
    names = spark.createDataFrame([("src0",), ("src13",), ("a",), (None,), ("x99999999999",)], "source string")
    got = [r[0] for r in names.select(mixing.domain_of()).collect()]
    assert got == ["web", "reference", "web", "web", mixing.DOMAINS[999999999 % 4]]


def test_main_path_is_native(spark):
    plan = mixing.mixture(make_docs(spark, ["a b"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
