"""Date helpers.  Inputs are ``timestamp_ntz``, so no session time zone applies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def purchase_date(ts: Column | str) -> Column:
    return F.to_date(ts)


def day_span(end: Column | str, start: Column | str) -> Column:
    """Calendar days from ``start`` to ``end`` (23:00 -> 01:00 next day is 1)."""
    return F.datediff(end, start)


def month_key(d: Column | str) -> Column:
    """``yyyy-MM`` text of a date."""
    return F.date_format(d, "yyyy-MM")
