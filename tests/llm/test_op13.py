from __future__ import annotations

import numpy as np
import pytest

from martlake.llm import nn_descent
from martlake.llm.nn_descent import Graph, nearest
from martlake.llm.queries import QUERIES
from tests.llm.helpers import table_rows

SCHEMA = "vec_id long, embedding array<float>"
EVERY_20 = "id % 20 = 0"


def brute(rows, is_query=lambda i: i % 20 == 0, most=20):
    """{query id: [(id, score)]} by comparing everything in double precision."""
    rows = sorted({
        (i, tuple(c + 0.0 for c in v)) for i, v in rows
        if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v) and any(v)
    })
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = {}
    for q in np.flatnonzero([is_query(i) for i in ids]):
        score = x @ x[q]
        order = np.lexsort((ids, -score))
        out[int(ids[q])] = [(int(ids[k]), float(score[k])) for k in order if ids[k] != ids[q]][:most]
    return out


def lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def check(got, rows, recall):
    """Exact scores and order; at least ``recall`` of the true neighbours found."""
    want = brute(rows)
    vectors = {i: np.array(v, float) for i, v in rows if v is not None and None not in v}
    assert set(got) == set(want)
    found = total = 0
    for q, w in want.items():
        g = got[q]
        assert len(g) == len(w) and len({i for i, _ in g}) == len(g) and q not in {i for i, _ in g}
        assert all(abs(s - vectors[q] @ vectors[i]) < 1e-12 * max(1, abs(s)) for i, s in g)
        assert g == sorted(g, key=lambda p: (-p[1], p[0]))
        worst = w[-1][1]
        found += sum(s >= worst - 1e-12 * max(1, abs(worst)) for _, s in g)
        total += len(w)
    assert found >= recall * total, found / total


@pytest.mark.parametrize("sf, recall", [("sf0.001", 0.999), ("sf0.1", 0.97)])
def test_whole_table_recall(spark, sf, recall):
    rows = table_rows("embeddings", f"/root/testdata/{sf}", "vec_id, embedding")
    check(lists(QUERIES["op13_nearest_neighbours"](spark, f"/root/testdata/{sf}")), rows, recall)


def test_rounds_find_what_small_tiles_miss(spark, monkeypatch):
    """Few pivots, one place each and tiny tiles: NN-descent and the search make
    up for the poor first graph."""
    for name, value in (("PLACES", 1), ("BLOCK", 40), ("TILE", 60), ("PIVOTS", 30), ("FROM_TILE", 8)):
        monkeypatch.setattr(nn_descent, name, value)
    rounds = []
    monkeypatch.setattr(Graph, "drop", lambda g: rounds.extend(g.rounds))
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 8))
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x / np.linalg.norm(x, axis=1)[:, None])]
    check(lists(nearest(spark.createDataFrame(rows, SCHEMA), EVERY_20)), rows, 0.9)
    assert len(rounds) >= 3 and rounds[-1] < rounds[0]


def test_unequal_norms_copies_and_ties(spark):
    rng = np.random.default_rng(4)
    base = [(rng.normal(size=5) * rng.uniform(0.1, 30)).astype(np.float32).tolist() for _ in range(300)]
    rows = [(i, v) for i, v in enumerate(base)]
    rows += [(1000 + i, base[40]) for i in range(400)]  # over half of all rows are one vector
    rows += [(2000 + i, [c * 2 for c in base[7]]) for i in range(3)]
    check(lists(nearest(spark.createDataFrame(rows, SCHEMA), EVERY_20)), rows, 0.97)


def test_copies_answer_with_the_smallest_ids(spark):
    rows = [(i, [1.0, 0.0]) for i in range(100, 200)] + [(5, [0.0, 1.0])]
    got = lists(nearest(spark.createDataFrame(rows, SCHEMA), EVERY_20))
    assert got[180] == [(i, 1.0) for i in range(100, 120)]
    assert got[100] == [(i, 1.0) for i in range(101, 121)]


def test_rows_that_take_no_part(spark):
    odd = [
        (0, [1.0, 2.0]), (20, [2.0, 1.0]), (20, [2.0, 1.0]), (40, [0.0, -0.0]), (60, None), (80, [None, 1.0]),
        (100, [float("nan"), 1.0]), (120, [float("inf"), 0.0]), (140, []), (160, [1.0]), (None, [1.0, 1.0]), (3, [-0.0, 1.0]),
    ]
    df = spark.createDataFrame(odd, SCHEMA).selectExpr("*", "1 AS id", "2 AS node", "'x' AS vector", "3 AS rank", "4 AS score")
    got = lists(nearest(df, EVERY_20))
    assert got == {0: [(20, 4.0), (3, 2.0)], 20: [(0, 4.0), (3, 1.0)]}


def test_empty_single_and_equal_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert nearest(empty, EVERY_20).count() == 0
    assert nearest(spark.createDataFrame([(0, [1.0, 1.0])], SCHEMA), EVERY_20).count() == 0
    same = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(0, 60, 20)], SCHEMA)
    assert lists(nearest(same, EVERY_20)) == {0: [(20, 2.0), (40, 2.0)], 20: [(0, 2.0), (40, 2.0)], 40: [(0, 2.0), (20, 2.0)]}
