from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from martlake.llm.queries import QUERIES
from martlake.llm.spectrum_slicing import Slicer, count_above, whitened
from tests.llm.helpers import table_rows

SF001 = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>"


def brute(rows):
    """The contract's columns from plain loops, exact fractions and numpy's solver."""
    rows = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    xs = [(i, tuple(math.floor(256 * float(c)) for c in v)) for i, v in rows]
    fit = sorted({x for _, x in xs})
    n, d = len(fit), len(fit[0])
    s = [sum(x[k] for x in fit) for k in range(d)]
    y = np.array([[float(Fraction(n * x[k] - s[k], n)) for k in range(d)] for x in fit])
    value, vector = np.linalg.eigh(y.T @ y / n)
    value, vector = value[::-1], vector[:, ::-1]
    out = {}
    for at, (i, x) in enumerate(xs):
        z = np.array([float(Fraction(n * x[k] - s[k], n)) for k in range(d)])
        deviation = sum((n * x[k] - s[k]) ** 2 for k in range(d))
        for c in range(min(4, d)):
            if value[c] > 1e-9 * value.sum():
                out[i, c + 1] = (n, deviation, z @ vector[:, c] / math.sqrt(value[c]), value[c] / value.sum())
    return out


def same(got, want):
    got = {(r["vec_id"], r["component"]): r for r in got}
    assert set(got) == set(want)
    sign = {}
    for (i, c), (n, deviation, w, e) in want.items():
        r = got[i, c]
        assert (r["n"], r["deviation"]) == (n, deviation)
        if abs(w) > 1e-3:
            sign.setdefault(c, math.copysign(1, w * r["whitened"]))
        assert abs(r["whitened"] * sign.get(c, 1) - w) < 1e-7 or abs(w) <= 1e-3
        assert abs(r["explained"] / e - 1) < 1e-9 and 0 <= r["identity_error"] < 1e-8
    assert len({r["identity_error"] for r in got.values()}) <= 1


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_whole_table_equals_brute_force(spark, sf):
    rows = table_rows("embeddings", f"/root/testdata/{sf}", "vec_id, embedding")
    got = QUERIES["op11_embedding_whitening"](spark, f"/root/testdata/{sf}").collect()
    assert len(got) == 4 * len(rows)
    same(got, brute(rows))


def test_rows_left_out_repeated_and_null_ids(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=6)]) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(30)]  # copies count once in the fit
    rows += [(5, rows[5][1]), (200, None), (201, []), (202, [1.0, 2.0]), (203, [1.0, None, 0.0, 0.0, 0.0, 0.0])]
    rows += [(204, [float("nan")] * 6), (205, [float("inf")] + [0.0] * 5), (206, [-0.0, 0.0, -0.001, 100.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS x", "3 AS n", "4 AS component")
    got = whitened(df).collect()
    want = brute([r for r in rows if r[0] not in (201, 202)])
    assert len(got) == len(want) + 4  # id 5 twice
    same(got, want)
    with_null = whitened(df.selectExpr("nullif(vec_id, 3) vec_id", "embedding")).collect()
    assert sum(r["vec_id"] is None for r in with_null) == 4


def test_small_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whitened(empty).count() == 0
    assert "whitened" in whitened(empty).columns
    assert whitened(spark.createDataFrame([(1, [1.0, 2.0])] * 3, SCHEMA)).count() == 0  # no variance
    two = whitened(spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], SCHEMA)).collect()
    assert [(r["component"], round(abs(r["whitened"]), 9), round(r["explained"], 12)) for r in two] == [(1, 1.0, 1.0)] * 2
    doubles = spark.createDataFrame([(1, [1e300]), (2, [-1e300]), (3, [0.0])], "vec_id long, embedding array<double>")
    big = whitened(doubles).collect()
    assert len(big) == 3 and {r["deviation"] for r in big if r["vec_id"] != 3} == {None}


def test_equal_eigenvalues(spark):
    """All directions alike: any basis, still white."""
    rows = [(2 * i + s, [0.0] * i + [(-1.0) ** s] + [0.0] * (5 - i)) for i in range(6) for s in (0, 1)]
    got = whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 48 and got[0]["identity_error"] < 1e-9
    assert all(abs(r["explained"] - 1 / 6) < 1e-12 for r in got)


def test_counts_and_slices_against_the_solver():
    rng = np.random.default_rng(5)
    for d in (1, 2, 3, 7, 40, 120):
        q, _ = np.linalg.qr(rng.normal(size=(d, d)))
        values = np.sort(rng.choice([0, 1e-6, 1, 1, 2, 2 + 1e-9, 5, 1e4, 1e4 + 1e-3], d))[::-1].astype(float)
        a = q * values @ q.T
        a = (a + a.T) / 2
        true = np.linalg.eigvalsh(a)[::-1]
        for shift in rng.uniform(-1, 1.1e4, 20).tolist() + [0.5, 1.5, 3.0, -5.0]:
            assert count_above(a, shift) == (true > shift).sum()
        pairs = Slicer(a).leading(4)
        want = [t for t in true[:4] if t > 1e-9 * max(true[0], 1e-300)]
        assert len(pairs) >= len(want)
        for (value, x), t in zip(pairs, want):
            assert abs(value - t) <= 1e-11 * true[0]
            assert np.linalg.norm(a @ x - value * x) <= 1e-10 * true[0]
        basis = np.array([x for _, x in pairs]).reshape(-1, d)
        assert np.abs(basis @ basis.T - np.eye(len(basis))).max(initial=0) < 1e-7
    zero = np.zeros((3, 3))
    assert Slicer(zero).leading(2) == [] and count_above(zero, 0.0) == 0
    indefinite = np.array([[0.0, 1.0], [1.0, 0.0]])
    assert count_above(indefinite, 0.0) == 1 and count_above(indefinite, -2.0) == 2
