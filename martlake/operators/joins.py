"""Join helpers for fact-to-dimension lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_KEY, _DIM_KEY = "_lookup_key", "_dim_key"


def lookup_left(fact: DataFrame, dim: DataFrame, key: str, row_key: list[str]) -> DataFrame:
    """``fact LEFT JOIN dim USING (key)``, with NULL fact keys spread.

    A NULL key matches nothing, yet a plain shuffle join sends every NULL to
    one reducer.  Here a NULL key is replaced by a text made of a hash of
    ``row_key`` (columns that tell fact rows apart; keep them few, they are
    read even if nothing else needs them), so those rows spread over all
    reducers.  The join also asks for a key that is not NULL, in case a
    dimension key looks like such a text.  Hot keys that are not NULL are split
    by AQE's skew join; the dimension has one row per key.  ``key`` is text.
    Output columns: ``key``, fact columns, dim columns.
    """
    filler = F.concat(F.lit("null-"), F.xxhash64(*row_key).cast("string"))
    left = fact.withColumn(_KEY, F.coalesce(F.col(key), filler))
    right = dim.withColumnRenamed(key, _DIM_KEY)
    on = (F.col(_KEY) == F.col(_DIM_KEY)) & left[key].isNotNull()
    return left.join(right, on, "left").select(
        key, *(c for c in fact.columns if c != key), *(c for c in dim.columns if c != key)
    )
