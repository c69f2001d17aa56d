"""Connected components of an edge list, on executors only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.tables import dropped, stored


def _mark(edges: DataFrame) -> tuple:
    """Tells whether two edge lists are the same set: a count and two sums."""
    h = F.xxhash64("u", "v")
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.shiftright(h, 20)), F.sum(h.bitwiseAND((1 << 40) - 1))
    ).first()
    return tuple(row)


def _with_least(edges: DataFrame) -> tuple[DataFrame, str]:
    """Edges and the least ``v`` of their ``u``.  The least values are written
    first (to the folder returned), so that the join reads two plain shuffles and
    a hub's edges can be split over tasks."""
    least, folder = stored(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    return edges.join(least, "u"), folder


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (two long columns); the
    component is its least node.  Alternates the large-star and small-star
    steps (Kiveris et al. 2014) until each component is a star, in a number of
    rounds logarithmic in the longest path, each round written out; only the last
    round's table stays."""
    a, b = edges.columns
    now, now_folder = stored(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct(), "edges"
    )
    mark = _mark(now)
    while mark[0]:
        both, both_folder = stored(now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v"))), "both")
        large, least_of_both = _with_least(both)
        large = large.filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        large, large_folder = stored(large, "large-star")
        small, least_of_large = _with_least(large)
        before, (now, now_folder) = now_folder, stored(
            small.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(small.select("u", F.col("m").alias("v"))).distinct(),
            "small-star",
        )
        dropped(now.sparkSession, before, both_folder, least_of_both, large_folder, least_of_large)
        last, mark = mark, _mark(now)
        if mark == last:
            break
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
