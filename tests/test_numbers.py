from __future__ import annotations

from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martlake.functions.numbers import half_up_int, ratio_half_up


def _half_up(n: int, d: int, scale: int) -> float | None:
    if d == 0:
        return None
    q = Fraction(n, d) * 10**scale
    sign = -1 if q < 0 else 1
    q = abs(q)
    r = int(q) + (1 if q - int(q) >= Fraction(1, 2) else 0)
    return sign * r / 10**scale


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        # a quotient of at most 9 digits, so that 6 decimals are exact as double
        st.one_of(
            st.tuples(
                st.integers(-(10**9), 10**9), st.integers(-(10**9), 10**9), st.sampled_from([0, 1, 2, 6])
            ),
            st.tuples(
                st.integers(-(10**15), 10**15), st.integers(10**6, 10**9), st.sampled_from([0, 1, 2, 6])
            ),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_ratio_half_up_is_exact(spark, rows):
    rows = rows + [(1, 2, 0), (-1, 2, 0), (5, 1000, 2), (2000001, 4000002 * 100, 2), (7, 0, 2), (9_007_199_254, 1, 6), (-(10**15), 10**6 + 3, 6), (1, 10**9, 6)]
    df = spark.createDataFrame(rows, "n long, d long, s int")
    out = df.select(
        "n", "d", "s",
        *[ratio_half_up(F.col("n"), F.col("d"), s).alias(f"r{s}") for s in (0, 1, 2, 6)],
    ).collect()
    for r in out:
        assert r[f"r{r['s']}"] == _half_up(r["n"], r["d"], r["s"]), r


def test_half_up_int(spark):
    df = spark.createDataFrame([(10, 3), (20, 3), (5, 2), (-5, 2)], "n long, d long")
    got = [r[0] for r in df.select(half_up_int(F.col("n"), F.col("d"), 1)).collect()]
    assert got == [3, 7, 3, -3]


def test_fraction_sum_is_exact_for_any_counts(spark):
    from math import prod

    from martlake.functions.numbers import fraction_sum_half_up

    primes = [3299, 3301, 3307, 3313, 3319, 3323, 3329, 3331, 3343, 3347, 3359, 3361, 3371]

    def near(tie: int, off: int, counts: list[int]) -> list[tuple[int, int]]:
        """Fractions that sum to ``tie`` + ``off`` / product of the counts."""
        whole = prod(counts)
        rest = [(c, off * pow(whole // c, -1, c) % c) for c in counts]
        left = tie + Fraction(off, whole) - sum(Fraction(s, c) for c, s in rest)
        assert left.denominator == 1
        return [(1, int(left)), *rest]

    rows = [
        ([(p, 4 * p - k) for k, p in enumerate(primes)], 13),
        ([(c, 3 * c + 1) for c in range(1, 82)], 81),
        # a tie (801 / 200 = 4.005), and a hair off it
        *((near(801, off, primes), 200) for off in (0, 1, -1, 7, -7)),
        *((near(801, off, [999_999_937, 999_999_929, 999_999_893]), 200) for off in (1, -1)),
        ([(1, 800), (2, 1), (3, 1), (6, 1)], 200), ([(1, -800), (2, -1), (3, -1), (6, -1)], 200),
        ([(1, -1), (3, 2), (7, 1)], 3), ([(3, 5)], 1), ([(5, 0)], 1), ([(4, 7)], 0),
    ]
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], "i int, parts array<struct<c: long, s: long>>, n long")
    got = df.select("i", fraction_sum_half_up(F.col("parts"), F.col("n"), 2).alias("v")).collect()
    for r in got:
        parts, n = rows[r["i"]]
        total = sum(Fraction(s, c) for c, s in parts)
        assert r["v"] == _half_up(total.numerator, total.denominator * n, 2), rows[r["i"]]
