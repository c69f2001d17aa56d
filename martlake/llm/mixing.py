"""Mixing sources to target weights, by hierarchical budgets.

The documents' groups form a tree (by default domain, language, source).  A
token budget goes from the root down: among siblings in proportion to their
weights, each up to what its own subtree can give (tokens x ``max_epochs``).
What a sibling cannot take goes to its siblings first, since a node's budget is
settled above only by the capacity of the whole subtree; it leaves the subtree
only if all of it is full.

A leaf with budget b and t tokens gives ``b div t`` whole epochs and the
token-prefix of one more epoch, whose order is a seeded hash of epoch and id.
The prefix is found by summing tokens per leaf and hash bucket; only the one
bucket in which the prefix ends is looked at row by row, so a leaf with a third
of all rows is spread like the others.

Everything is built-in DataFrame functions and integer arithmetic.  A level's
floors leave at most one token per node unspent.

Defined cases: null or empty group names are the group ``''``; null, empty or
wordless texts have 0 tokens and are never chosen; rows are told apart by id
and text, so repeated rows each count; unlisted groups have weight 1, weights
of 0 or less give nothing; texts of any length count whole; ties in the seeded
order go by the row's hash; an empty table gives an empty result; other columns
pass through the stage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlake.llm.tables import free_names, row_key, written

WORD = r"[^\x20\x09-\x0D]+"
#: Hexadecimal digits of the order hash that name a bucket.
BUCKET_DIGITS = 3

DOMAINS = ("web", "reference", "forum", "news")
#: Target weights, per level; siblings share in proportion.
WEIGHTS: dict[str, dict[str, int]] = {
    "domain": {"web": 4, "reference": 3, "forum": 2, "news": 1},
    "lang": {"en": 5, "de": 2, "fr": 2, "es": 1},
    "source": {},
}
MAX_EPOCHS, SEED = 4, 17


def domain_of(source: str = "source") -> Column:
    """Domain by the number at the end of a source's name; without one, the first."""
    number = F.regexp_extract(F.coalesce(F.col(source), F.lit("")), r"([0-9]{1,9})$", 1)
    at = F.pmod(F.coalesce(number.try_cast("int"), F.lit(0)), F.lit(len(DOMAINS)))
    return F.element_at(F.array(*map(F.lit, DOMAINS)), at + 1)


def _weight(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    listed = [x for k, v in weights.get(level, {}).items() for x in (F.lit(k), F.lit(int(v)).cast("long"))]
    one = F.lit(1).cast("long")
    return F.coalesce(F.element_at(F.create_map(*listed), F.col(level)), one) if listed else one


def _shares(children: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """Budgets of the children of each parent (columns ``above`` budget of the
    parent, ``cap``, ``weight``): a child is full if its cap is at most its
    share of what the children filled before it leave; children come in order
    of cap per weight, so the full ones come first."""
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = by.orderBy(F.col("cap").cast("double") / F.col("weight").cast("double"), name)
    rows = (
        children.withColumn("w_from", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("c_before", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("full", F.col("cap") * F.col("w_from") <= F.col("weight") * (F.col("above") - F.col("c_before")))
    )
    return (
        rows.withColumn("taken", F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(by), F.lit(0)))
        .withColumn("w_open", F.sum(F.when(~F.col("full"), F.col("weight"))).over(by))
        .withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(
            F.expr("weight * (above - taken) div w_open")))
        .drop("w_from", "c_before", "full", "taken", "w_open", "above")
    )


def leaf_budgets(
    leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, int]],
    budget: int | None, max_epochs: int,
) -> DataFrame:
    """(levels..., tokens, budget) from (levels..., tokens).  ``budget`` None
    means as many tokens as there are."""
    for level in levels:
        leaves = leaves.withColumn(f"w_{level}", _weight(level, weights))
    usable = F.forall(F.array(*(F.col(f"w_{x}") for x in levels)), lambda w: w > 0)
    leaves = written(
        leaves.withColumn("cap", F.when(usable, F.col("tokens") * max_epochs).otherwise(0)), "mix-leaves"
    )
    total = F.sum("tokens") if budget is None else F.lit(int(budget)).cast("long")
    above = leaves.agg(F.least(total, F.sum("cap")).alias("above"))  # one row
    for depth, level in enumerate(levels):
        parent, path = list(levels[:depth]), list(levels[: depth + 1])
        nodes = leaves.groupBy(*path).agg(F.sum("cap").alias("cap"), F.max(f"w_{level}").alias("weight"))
        nodes = nodes.filter("cap > 0")
        nodes = nodes.join(above, parent) if parent else nodes.join(F.broadcast(above))
        shares = _shares(nodes, parent, level)
        above = shares.select(*path, F.col("budget").alias("above"))
    return leaves.select(*levels, "tokens").join(above, list(levels), "left").select(
        *levels, "tokens", F.coalesce("above", F.lit(0)).alias("budget")
    )


def choose(
    docs: DataFrame, levels: Sequence[str] = ("domain", "lang", "source"),
    weights: Mapping[str, Mapping[str, int]] = WEIGHTS, budget: int | None = None,
    max_epochs: int = MAX_EPOCHS, seed: int = SEED, row: Column | None = None,
) -> DataFrame:
    """(row, doc_id, levels..., n_tokens, copies) of the chosen documents:
    ``copies`` is the number of epochs that contain the row.  ``docs`` has
    doc_id, text and the columns named by ``levels``; ``row`` tells rows apart
    (default: by id and text)."""
    base = docs.select(
        (row_key() if row is None else row).alias("row"), "doc_id", *(F.coalesce(F.col(x), F.lit("")).alias(x) for x in levels),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"),
    ).filter("n_tokens > 0")
    base = written(base, "mix-rows")
    leaves = base.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens"))
    plan = leaf_budgets(leaves, levels, weights, budget, max_epochs)
    plan = plan.filter("budget > 0").select(
        *levels, F.expr("budget div tokens").alias("epochs"), F.expr("budget % tokens").alias("rest")
    )
    plan = written(plan, "mix-plan")
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"), F.col("doc_id").cast("string")))
    rows = base.join(plan, list(levels)).withColumn("at", order).withColumn("bucket", F.substring("at", 1, BUCKET_DIGITS))
    rows = written(rows, "mix-ordered")
    by = Window.partitionBy(*levels)
    sums = rows.groupBy(*levels, "bucket").agg(F.sum("n_tokens").alias("sum"), F.max("rest").alias("most"))
    sums = sums.withColumn("upto", F.sum("sum").over(by.orderBy("bucket")))
    sums = written(
        sums.select(*levels, "bucket", (F.col("upto") - F.col("sum")).alias("before"),
                    (F.col("upto") <= F.col("most")).alias("inside"),
                    ((F.col("upto") > F.col("most")) & (F.col("upto") - F.col("sum") < F.col("most"))).alias("edge")),
        "mix-buckets",
    )
    placed = rows.join(sums, [*levels, "bucket"])
    keep = ["row", "doc_id", *levels, "n_tokens"]
    plain = placed.filter(~F.col("edge")).select(*keep, (F.col("epochs") + F.col("inside").cast("long")).alias("copies"))
    running = F.sum("n_tokens").over(
        Window.partitionBy(*levels, "bucket").orderBy("at", "row").rowsBetween(Window.unboundedPreceding, 0)
    )
    edge = placed.filter("edge").withColumn("running", F.col("before") + running).select(
        *keep, (F.col("epochs") + (F.col("running") <= F.col("rest")).cast("long")).alias("copies")
    )
    return plain.unionByName(edge).filter("copies > 0")


def mixture(docs: DataFrame) -> DataFrame:
    """The production mix: doc_id, domain, lang, source, n_tokens, copies."""
    return choose(docs.withColumn("domain", domain_of())).drop("row")


def mix_stage(docs: DataFrame) -> DataFrame:
    """The chosen documents with all their columns, ``domain`` and ``copies``
    (columns of these names are replaced).  Equal rows are chosen one by one: rows
    are numbered, and written with their numbers, first."""
    rest = [c for c in docs.columns if c.lower() not in ("domain", "copies")]
    number, row = free_names([*rest, "domain", "copies"], "number", "row")
    rows = written(docs.select(*rest).withColumn(number, F.monotonically_increasing_id()), "mix-numbered")
    rows = rows.withColumn("domain", domain_of())
    chosen = choose(rows, row=F.col(number)).select(F.col("row").alias(row), "copies")
    return rows.join(chosen.hint("shuffle_hash"), F.col(number) == F.col(row)).select(*rest, "domain", "copies")
