"""Benchmark decontamination by templates.

Texts and benchmark items are cut into words and made into templates: words
with a digit become a number slot, unit words after a number a unit slot, names a
name slot; other words are lower-cased and lose their punctuation.  What is a
name depends on the reading (a capitalised word is one not in capitals
throughout):

* as written: a capitalised word inside a sentence is a name, one that opens a
  sentence is not, and no unit opens one;
* names: every capitalised word is a name, so names may open sentences;
* literal: none is, so case does not count (as far as lower case tells: ß and SS
  differ).

The last two look at words without their punctuation: a stop that was changed,
added or lost makes no difference.  Windows of ``WINDOW`` template words with at
least ``LITERALS`` plain words are joined by hash with those of the benchmark in
the same reading.

A text and an item match along alignments (distance of the two windows).  In a
re-parameterised copy a value of the item stands for one value of the text
throughout; an alignment in which some value of the item meets two values in a
reading is no copy there, and its windows do not count (so equal values of an item that
are equal by chance must stay equal in a copy).  Numbers written as words are plain
words.  A text is contaminated
by an item when the counted windows cover ``COVER`` percent of the item's, or
``RUN`` of them, in one reading or in all together.  Counts are those of the
first reading that matches, in the order above, all together last; then slots
are counted in each of them.

An item without a window, since it has fewer than ``WINDOW`` words or too many
slots in all of them, has its whole text as its only window, without slots: it is
found where all its words stand in a row, apart from case and punctuation, with
the same numbers and names.  The report has every such place; :func:`drop_contaminated`
takes items of under ``SHORT`` words only where they are the whole document, since such
words stand in many a clean text.

Built-in functions only.  All windows of all texts are searched: by the longest
plain word of each benchmark window, then by the window's hash.  The benchmark
windows are counted first: up to ``BROADCAST_WINDOWS`` of them (a bounded table
of three small columns) are sent to all tasks, and the texts' words are never
shuffled; beyond that single words are shuffled, and the places found are joined back
to their texts once, in proportion to the texts, with the same result.

Defined cases: texts and items that are null or have no word match nothing; words of signs only, as + and
*, are no words; repeated rows and equal items give equal results; rows are told apart
by id and text; texts of any length are searched whole; empty tables match nothing; other
columns pass through :func:`drop_contaminated` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.llm.tables import free_names, row_key, written

WINDOW, LITERALS = 8, 4
COVER, RUN = 50, 13
BROADCAST_WINDOWS = 500_000
#: For cleaning, items of fewer words have to be the whole document.
SHORT = 3

#: Unit words, as they follow a number.
UNITS = (
    "mm cm m km in ft yd mi mg g kg lb oz t ml l cl s sec min h hr hours minutes seconds days weeks months "
    "years percent pct usd eur dollars euros cents kmh mph w kw v a hz kb mb gb tb meters metres miles grams liters"
).split()

_NUM, _UNIT, _NAME = "\ue000", "\ue001", "\ue002"  # private-use characters; texts lose theirs

#: The template column of each reading, and the number of all readings together.
READINGS = ("written", "names", "literal")
#: The own words, for items matched as a whole.
WHOLE = len(READINGS)
ANY = 9


def plain_words(text: Column) -> Column:
    """Single spaces between words that have a letter or digit; others go."""
    spaced = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D\uE000-\uE002]+", " "))
    return F.trim(F.regexp_replace(spaced, r"(?:^| )[^\p{L}\p{N} ]++(?= |$)", ""))


def template(words: Column) -> Column:
    """The template of ``plain_words``, word for word."""
    # the end of a sentence stays, for the names; a pattern starts at a word's
    # start only, so long words cost no more than their length
    numbers = F.regexp_replace(words, r"(?<![^ ])[^ 0-9]*+[0-9](?:[^ ]*[^ .!?:])?", _NUM)
    units = F.regexp_replace(numbers, rf"(?i){_NUM} (?:{'|'.join(UNITS)})(?!\p{{L}})(?:[^ ]*[^ .!?:])?", f"{_NUM} {_UNIT}")
    numbered = F.when(words.rlike("[0-9]"), units).otherwise(words)
    names = F.regexp_replace(numbered, r"\p{Lu}(?=\p{Ll})(?<=[^ .!?:] .)[^ ]*+", _NAME)
    return F.lower(F.regexp_replace(names, rf"[^\p{{L}}\p{{N}} {_NUM}{_UNIT}{_NAME}]+", ""))


def bare_words(words: Column) -> Column:
    """``plain_words`` without punctuation, in their own case."""
    return F.regexp_replace(words, r"[^\p{L}\p{N} ]+", "")


def literal_template(bare: Column) -> Column:
    """Number and unit slots of ``bare_words``; the rest in its own case."""
    numbers = F.regexp_replace(bare, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", _NUM)
    units = F.regexp_replace(numbers, rf"(?i){_NUM} (?:{'|'.join(UNITS)})(?![^ ])", f"{_NUM} {_UNIT}")
    return F.when(bare.rlike("[0-9]"), units).otherwise(bare)


def _split(words: Column) -> Column:
    return F.split(words, " ")


def templates(table: DataFrame, key: list[str]) -> DataFrame:
    """(key..., raw, v, written, names, literal): a text's own words, the same
    in lower case without punctuation, and its template words in each reading,
    in the same places.  No filter on them here: the optimizer would move it
    below the projection and make every template twice."""
    rows = table.withColumn("_plain", plain_words(F.col("text"))).withColumn("_bare", bare_words(F.col("_plain")))
    rows = rows.withColumn("_slots", literal_template(F.col("_bare")))
    return rows.select(
        *key, _split(F.col("_plain")).alias("raw"), _split(F.lower("_bare")).alias("v"),
        _split(template(F.col("_plain"))).alias("written"),
        _split(F.lower(F.regexp_replace("_slots", r"(?<![^ ])\p{Lu}\p{Ll}[^ ]*+", _NAME))).alias("names"),
        _split(F.lower("_slots")).alias("literal"),
    )


def _read(reading: Column) -> Column:
    """The template words of the reading with that number."""
    first, *others = READINGS
    chosen = F.when(reading == 0, F.col(first))
    for i, name in enumerate(others, 1):
        chosen = chosen.when(reading == i, F.col(name))
    return chosen.when(reading == WHOLE, F.col("v"))


def _window(reading: Column, at: Column, n: Column) -> Column:
    return F.xxhash64(reading, F.slice(_read(reading), at + 1, n))


def _has_window() -> Column:
    starts = F.sequence(F.lit(0), F.size("v") - WINDOW)

    def found(words: str) -> Column:
        slots = lambda at: F.filter(F.slice(words, at + 1, WINDOW), lambda w: w.isin(_NUM, _UNIT, _NAME))
        return F.exists(starts, lambda at: F.size(slots(at)) <= WINDOW - LITERALS)

    return F.when(F.size("v") >= WINDOW, F.greatest(*map(found, READINGS))).otherwise(False)


def whole_items(rows: DataFrame) -> DataFrame:
    """The one window of each item that has no other, as ``benchmark_windows``."""
    rows = rows.filter((F.col("v")[0] != "") & ~_has_window())
    longest = F.array_max(F.transform("v", lambda w, k: F.struct(F.length(w).alias("n"), (-k).alias("k"), w.alias("word"))))
    reading, at = F.lit(WHOLE), F.lit(0)
    return rows.withColumn("a", longest).select(
        "item_id", reading.alias("reading"), at.alias("at"), F.size("v").alias("n"),
        _window(reading, at, F.size("v")).alias("window"), F.col("a.word").alias("word"),
        (-F.col("a.k")).alias("offset"), F.array().cast("array<struct<k:int,v:string>>").alias("slots"),
    )


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, reading, at, n, window, word, offset, slots): every window of n
    words in each reading with its hash, its longest plain word (the first of
    equal ones) and that word's place in it, and the values in its slots."""
    items = templates(benchmark.select("item_id", "text"), ["item_id"])
    rows = items.filter(F.size("v") >= WINDOW)
    rows = rows.withColumn("at", F.explode(F.sequence(F.lit(0), F.size("v") - WINDOW)))
    rows = rows.withColumn("reading", F.explode(F.array(*(F.lit(i) for i in range(len(READINGS))))))
    rows = rows.withColumn("t", _read(F.col("reading")))
    places = [F.col("t")[F.col("at") + k] for k in range(WINDOW)]
    slots = F.array_compact(F.array(*(
        F.when(p.isin(_NUM, _UNIT, _NAME), F.struct(F.lit(k).alias("k"), F.col("raw")[F.col("at") + k].alias("v")))
        for k, p in enumerate(places)
    )))
    longest = F.greatest(*(
        F.struct(F.when(p.isin(_NUM, _UNIT, _NAME), 0).otherwise(F.length(p)).alias("n"), F.lit(-k).alias("k"), p.alias("word"))
        for k, p in enumerate(places)
    ))
    rows = rows.select(
        "item_id", "reading", "at", F.lit(WINDOW).alias("n"),
        _window(F.col("reading"), F.col("at"), F.lit(WINDOW)).alias("window"), longest.alias("a"), slots.alias("slots"),
    )
    return rows.filter(F.size("slots") <= WINDOW - LITERALS).select(
        "item_id", "reading", "at", "n", "window", F.col("a.word").alias("word"), (-F.col("a.k")).alias("offset"), "slots"
    ).unionByName(whole_items(items))


def window_hits(texts: DataFrame, ours: DataFrame, short: int = 0) -> DataFrame:
    """(row, doc_id, at, window, raw): the windows of the texts that are among
    ``ours``.  Each word of a text is looked up once; only where a benchmark
    window's longest word stands is a window hashed, in that reading, and looked
    up."""
    anchor = ["word", "offset", "reading", "n"]
    searched = ours.select("window", *anchor).distinct()
    anchors = searched.select(*anchor).distinct()
    small = searched.count() <= BROADCAST_WINDOWS
    rows = templates(texts, ["row", "doc_id"])
    size, start = F.size("v").alias("size"), F.col("place") - F.col("offset")
    inside = (start >= 0) & (start + F.col("n") <= F.col("size"))
    if short:  # items of fewer words are a document of their own, or nothing
        inside &= (F.col("n") >= short) | (F.col("n") == F.col("size"))
    # outer, since the inner form also gets a filter on the array
    word = F.posexplode_outer("v").alias("place", "word")
    if small:
        found = rows.select("*", size, word).join(F.broadcast(anchors), "word").filter(inside).withColumn("at", start)
    else:
        # only single words are shuffled; the places found come back to their text once
        places = rows.select("row", "doc_id", size, word).join(anchors, "word").filter(inside).withColumn("at", start)
        places = places.groupBy("row", "doc_id").agg(F.collect_set(F.struct("at", *anchor)).alias("found"))
        places = places.select(F.col("row").alias("of"), F.col("doc_id").alias("of_id"), "found")
        on = (F.col("row") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("of_id"))
        found = rows.join(places.hint("shuffle_hash"), on).select("*", F.explode("found").alias("f")).select(*rows.columns, "f.*")
    found = found.withColumn("window", _window(F.col("reading"), F.col("at"), F.col("n")))
    return found.join(F.broadcast(searched) if small else searched, ["window", *anchor]).select(
        "row", "doc_id", "at", "window", F.slice("raw", F.col("at") + 1, F.col("n")).alias("raw")
    )


def _value(word: Column) -> Column:
    return F.lower(F.regexp_replace(word, r"[^\p{L}\p{N}]+", ""))


def contaminated(docs: DataFrame, benchmark: DataFrame, short: int = 0) -> DataFrame:
    """(row, doc_id, item_id, n_windows, item_windows, n_slots) of every
    document and item that match; ``row`` is the document's ``row_key``.  Items of
    fewer than ``short`` words match only a document that is nothing else."""
    ours = written(benchmark_windows(benchmark), "benchmark-windows")
    read = F.explode(F.array("reading", F.lit(ANY))).alias("reading")
    sizes = ours.select("item_id", "at", read).groupBy("item_id", "reading").agg(
        F.countDistinct("at").alias("item_windows"))
    texts = docs.select(row_key().alias("row"), "doc_id", "text")
    found = written(window_hits(texts, ours, short), "template-hits")
    places = ours.select("window", "item_id", "reading", F.col("at").alias("item_at"), "slots")
    hits = found.join(places, "window").withColumn("shift", F.col("at") - F.col("item_at"))
    pairs = F.transform("slots", lambda s: F.struct(
        _value(s["v"]).alias("theirs"), _value(F.element_at("raw", s["k"] + 1)).alias("ours")))
    hits = written(hits.select("row", "doc_id", "item_id", "shift", "reading", "item_at", pairs.alias("pairs")), "template-pairs")
    along = ["row", "doc_id", "item_id", "shift", "reading"]
    values = (
        hits.select(*along, F.explode("pairs").alias("p")).groupBy(*along, "p.theirs")
        .agg(F.min("p.ours").alias("a"), F.max("p.ours").alias("b"), F.count(F.lit(1)).alias("n"))
        .groupBy(*along).agg(F.max((F.col("a") != F.col("b")).cast("int")).alias("torn"), F.sum("n").alias("n_slots"))
    )
    runs = hits.groupBy(*along).agg(F.collect_set("item_at").alias("places"))  # at most an item's windows
    on = [runs[c].eqNullSafe(values[c]) for c in along]
    good = runs.join(values, on, "left").filter("torn IS NULL OR torn = 0").select(
        *(runs[c] for c in along), "places", "n_slots"
    )
    pair = ["row", "doc_id", "item_id"]
    matched = good.select(*pair, read, "places", "n_slots").groupBy(*pair, "reading").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).cast("long").alias("n_windows"),
        F.coalesce(F.sum("n_slots"), F.lit(0)).alias("n_slots"),
    )
    judged = matched.join(sizes, ["item_id", "reading"]).filter(
        (100 * F.col("n_windows") >= COVER * F.col("item_windows")) | (F.col("n_windows") >= RUN)
    )
    first = F.min(F.struct("reading", "n_windows", "item_windows", "n_slots")).alias("m")
    return judged.groupBy(*pair).agg(first).select(*pair, "m.n_windows", "m.item_windows", "m.n_slots")


def leak_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_windows, item_windows, n_slots per contaminated
    document and item."""
    return contaminated(docs, benchmark).drop("row")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without the contaminated ones; columns as they were."""
    row, doc = free_names(docs.columns, "row", "id")
    bad = contaminated(docs, benchmark, SHORT).select(F.col("row").alias(row), F.col("doc_id").alias(doc)).distinct()
    on = (row_key() == F.col(row)) & F.col("doc_id").eqNullSafe(F.col(doc))
    return docs.join(bad.hint("shuffle_hash"), on, "left_anti")
