"""Exact money and ratio arithmetic.

Money is summed as ``decimal``.  Every rounded ratio (order value, rates,
shares, growth) is computed from two integers with a half-up integer
division, so the result does not depend on floating-point sums or on the
scale Spark picks for a decimal quotient.  Values leave as ``double``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from martlake.schemas import MONEY

_WIDE = DecimalType(38, 0)


def to_money(col: Column | str) -> Column:
    """Cast to ``decimal(12,2)``; text or values that do not fit become NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast(MONEY)


def cents(col: Column | str) -> Column:
    """A 2-decimal money value as an exact integer count of cents."""
    c = F.col(col) if isinstance(col, str) else col
    return (c * 100).cast(_WIDE)


def _floor_div(a: Column, b: Column) -> Column:
    # a >= 0, b > 0, both integral decimals: a - (a mod b) is a multiple of b,
    # so the decimal quotient is exact.
    return ((a - F.pmod(a, b)) / b).cast("long")


def half_up_int(num: Column, den: Column, multiplier: int = 1) -> Column:
    """``round(num * multiplier / den)`` to a whole number, half away from zero.

    ``num`` and ``den`` must be integral (counts, cents).  NULL when either is
    NULL or ``den`` is 0.  Computed in ``decimal(38,0)``, so it is exact.
    """
    n = num.cast(_WIDE)
    d = den.cast(_WIDE)
    sign = F.signum(n) * F.signum(d)
    scaled = F.abs(n) * F.lit(multiplier).cast(_WIDE) * 2 + F.abs(d)
    q = _floor_div(scaled, F.abs(d) * 2)
    return F.when(d != 0, (sign * q).cast("long"))


def ratio_half_up(num: Column, den: Column, scale: int) -> Column:
    """``round(num / den, scale)``, half away from zero, as double.

    ``num`` and ``den`` must be integral (counts, cents).  NULL when either is
    NULL or ``den`` is 0 (the SQL ``NULLIF(den, 0)`` rule).
    """
    return half_up_int(num, den, 10**scale).cast("double") / F.lit(float(10**scale))


#: Fractions are taken 18 digits at a time.
_BLOCK = 10**18


def _wide(v: Column | int) -> Column:
    return (v if isinstance(v, Column) else F.lit(v)).cast(_WIDE)


def _sum_of(items: Column, value) -> Column:
    return F.aggregate(items, _wide(0), lambda acc, x: _wide(acc + value(x)))


def _next_digits(rest: Column) -> Column:
    """Sum of the next 18 digits of each r / c, of an array of (c, r)."""
    return _sum_of(rest, lambda x: _wide(_floor_div(x["r"] * _wide(_BLOCK), x["c"])))


def _after_digits(rest: Column) -> Column:
    return F.transform(rest, lambda x: F.struct(x["c"].alias("c"), _wide(F.pmod(x["r"] * _wide(_BLOCK), x["c"])).alias("r")))


def _reaches(rest: Column, gap: Column) -> Column:
    """Whether the sum of r / c over ``rest`` is at least ``gap``, a whole number.

    Further digits are taken until the gap is closed or wider than what is left,
    which is less than one per fraction.  Two different values differ by one over
    the product of all c at least, so the number of digits that settles it is
    known; if they do not, the values are equal."""
    many = _wide(F.size(rest))
    digits = F.aggregate(rest, F.log10(F.size(rest).cast("double")), lambda acc, x: acc + F.log10(x["c"].cast("double")))
    blocks = F.sequence(F.lit(1), (digits / 18).cast("int") + 2)
    start = F.struct(rest.alias("rest"), _wide(gap).alias("gap"))
    end = F.aggregate(blocks, start, lambda acc, _: F.when(
        (acc["gap"] > 0) & (acc["gap"] < many),
        F.struct(
            _after_digits(acc["rest"]).alias("rest"),
            _wide(acc["gap"] * _wide(_BLOCK) - _next_digits(acc["rest"])).alias("gap"),
        ),
    ).otherwise(acc))
    return end["gap"] < many


def fraction_sum_half_up(parts: Column, den: Column, scale: int) -> Column:
    """``round(sum(s / c) / den, scale)`` over an array of whole (c, s), c > 0,
    half away from zero, as double.

    Exact for any c: whole parts and 18 digits of each fraction are summed, and
    only if the rest could reach the next tie are more digits taken."""
    negative = F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x["s"].cast("double") / x["c"].cast("double")) < 0
    signed = F.transform(parts, lambda x: F.struct(
        _wide(x["c"]).alias("c"), _wide(F.when(negative, -_wide(x["s"])).otherwise(_wide(x["s"]))).alias("s")))
    # floor, also for a negative s among positive ones
    whole = _sum_of(signed, lambda x: _wide((x["s"] - F.pmod(x["s"], x["c"])) / x["c"]))
    rest = F.transform(signed, lambda x: F.struct(x["c"].alias("c"), _wide(F.pmod(x["s"], x["c"])).alias("r")))
    d, m = _wide(den), 10**scale
    # a value just below zero counts as zero
    low = F.greatest(_wide(whole * _wide(_BLOCK) + _next_digits(rest)), _wide(0))
    q = _wide(_floor_div(low * _wide(2 * m) + d * _wide(_BLOCK), d * _wide(2 * _BLOCK)))
    gap = _wide((q * 2 + 1) * d * _wide(_BLOCK // (2 * m)) - low)
    rest = _after_digits(rest)
    up = F.when(gap < F.size(rest), _reaches(rest, gap)).otherwise(False)
    rounded = (q + up.cast("int")).cast("long")
    return F.when(den != 0, F.when(negative, -rounded).otherwise(rounded)).cast("double") / F.lit(float(m))


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Output form: every decimal column as double, names and order unchanged."""
    cols = [
        F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, DecimalType)
        else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)
