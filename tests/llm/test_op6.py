from __future__ import annotations

from collections import defaultdict

import pytest
import regex

from martlake.llm import decontam
from martlake.llm.decontam import COVER, LITERALS, RUN, UNITS, WINDOW, drop_contaminated, leak_report
from martlake.llm.queries import QUERIES
from tests.conftest import SF01
from tests.llm.helpers import ODD_TEXTS, make_docs, table_rows


def parts(text):
    """(template word, own word) of every word, word by word."""
    raw = [w for w in regex.split(r"[\x20\x09-\x0D\uE000-\uE002]+", text or "") if regex.search(r"[\p{L}\p{N}]", w)]
    out, before = [], ""
    for i, w in enumerate(raw):
        ended = bool(i) and raw[i - 1][-1] in ".!?:"
        unit = regex.match(rf"(?i)(?:{'|'.join(UNITS)})(?!\p{{L}})", w)
        if regex.search("[0-9]", w):
            t = "<num>"
        elif unit and before == "<num>" and not ended:
            t = "<unit>"
        elif i and regex.match(r"\p{Lu}\p{Ll}", w) and not ended:
            t = "<name>"
        else:
            t = "".join(regex.findall(r"[\p{L}\p{N}]", w)).lower()
        before = t
        out.append((t, w))
    return out


def value(w):
    return "".join(regex.findall(r"[\p{L}\p{N}]", w)).lower()


def brute(docs, bench):
    index, items = defaultdict(list), {}
    for item, text in bench:
        p = parts(text)
        good = [
            i for i in range(len(p) - WINDOW + 1)
            if sum(t[0] == "<" for t, _ in p[i : i + WINDOW]) <= WINDOW - LITERALS
        ]
        items[item] = (p, len(good))
        for i in good:
            index[tuple(t for t, _ in p[i : i + WINDOW])].append((item, i))
    out = []
    for d, text in docs:
        p, along = parts(text), defaultdict(set)
        for i in range(len(p) - WINDOW + 1):
            for item, j in index.get(tuple(t for t, _ in p[i : i + WINDOW]), ()):
                along[item, i - j].add(j)
        matched = defaultdict(set)
        for (item, shift), places in along.items():
            maps = defaultdict(set)
            for j in places:
                for k in range(WINDOW):
                    t, w = items[item][0][j + k]
                    if t[0] == "<":
                        maps[value(w)].add(value(p[j + k + shift][1]))
            if all(len(x) == 1 for x in maps.values()):
                matched[item] |= places
        for item, places in matched.items():
            if 100 * len(places) >= COVER * items[item][1] or len(places) >= RUN:
                out.append((d, item, len(places), items[item][1]))
    return sorted(out, key=str)


def run(docs, bench):
    return sorted(
        ((r.doc_id, r.item_id, r.n_windows, r.item_windows) for r in leak_report(docs, bench).collect()), key=str
    )


@pytest.fixture(scope="module")
def bench(spark):
    texts = [
        "If Anna buys 12 apples for 3 dollars each and Boris buys 12 pears, how much does Anna pay in all?",
        "A train goes 60 km in 2 hours. How far does the train go in 5 hours at the same speed?",
        "short item", None, "", "The same words as in another item stand here without any slots at all, you see?",
        "The same words as in another item stand here without any slots at all, you see?",
    ]
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def test_whole_table(spark):
    rows, bench = table_rows("documents", SF01), table_rows("benchmark", SF01, "item_id, text")
    got = QUERIES["op6_decontamination"](spark, SF01).collect()
    want = brute(rows, bench)
    assert sorted(((r.doc_id, r.item_id, r.n_windows, r.item_windows) for r in got), key=str) == want
    # every document that holds a whole item is found, and no other
    text = dict(bench)
    holds = {(d, i) for d, t in rows for i in text if text[i] in t}
    assert holds <= {x[:2] for x in want} and len(want) < 2 * len(holds) + 3


def test_parameters_slots_and_odd_texts(spark, bench):
    texts = [
        *ODD_TEXTS,
        "x y z. If Carla buys 7 apples for 9 euros each and Dora buys 7 pears, how much does Carla pay in all? z",
        "If Carla buys 7 apples for 9 euros each and Dora buys 8 pears, how much does Carla pay in all?",
        "If Carla buys 7 apples for 9 euros each and Dora buys 7 pears, how much does Emil pay in all?",
        "A TRAIN GOES 75 MI IN 3 HOURS. HOW FAR DOES THE TRAIN GO IN 9 HOURS AT THE SAME SPEED?",
        "A | train -- goes 75 mi in\n3 hours. How far does the train go in 9 hours at *** the same speed?",
        "the same words as in another item stand here, without ANY slots!",
        "7 8 9 10 11 12 13 14 15 16 17 18 19 20",
        "ß É İ " * 30,
    ]
    docs = make_docs(spark, texts).withColumnRenamed("lang", "window").withColumnRenamed("source", "item_id")
    want = brute(list(enumerate(texts)), [tuple(r) for r in bench.collect()])
    assert run(docs, bench) == want
    n = len(ODD_TEXTS)
    assert {x[:2] for x in want} == {(n, 0), (n + 3, 1), (n + 4, 1), (n + 5, 5), (n + 5, 6)}
    assert run(docs.limit(0), bench) == [] and run(docs, bench.limit(0)) == []


def test_shuffled_join_gives_the_same(spark, bench, monkeypatch):
    texts = ["A train goes 60 km in 2 hours. How far does the train go in 5 hours at the same speed?"] * 3
    docs = make_docs(spark, texts)
    first = run(docs, bench)
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", 0)
    assert run(docs, bench) == first and len(first) == 3


def test_drop_keeps_clean_rows_null_ids_and_repeats(spark, bench):
    leak = "The same words as in another item stand here without any slots at all, you see?"
    rows = [(1, leak, "a"), (1, "clean", "b"), (None, leak, "c"), (None, "clean", None), (3, None, "d"), (4, "x", "e"), (4, "x", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string")
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted((r for r in rows if r[1] != leak), key=str)


def test_main_path_is_native(spark, bench):
    plan = leak_report(make_docs(spark, ["a"]), bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_names_at_sentence_starts_and_changed_stops(spark):
    items = [
        "Anna has 12 red apples. Boris gives her 5 more apples. How many apples does Anna have now?",
        "Tom walks to the shop and buys 4 pens. Mary takes 3 of them home. How many pens are left for Tom today?",
        "He counts up to 5. Seconds later the bell of the old school rings and everybody runs out into the yard",
    ]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    plain = [regex.sub(r"[^\p{L}\p{N} ]", "", t) for t in items]
    texts = [
        "Clara has 15 red apples. David gives her 7 more apples. How many apples does Clara have now?",
        "Jim walks to the shop and buys 9 pens. Lucy takes 2 of them home. How many pens are left for Jim today?",
        "Clara has 15 red apples. Clara gives her 7 more apples. How many apples does David have now?",
        *items, *plain, *(t.replace(".", ",") for t in items), *(t.title() for t in items), *(t.upper() for t in items),
        *("and then " + t for t in plain),
    ]
    got = {x[:2] for x in run(make_docs(spark, texts), bench)}
    assert got == {(0, 0), (1, 1)} | {(k, (k - 3) % 3) for k in range(3, len(texts))}


def test_items_without_a_window_match_as_a_whole(spark):
    items = [
        "What is the capital of France?", "Compute 3 + 4 * 5 - 6 / 2 + 9 * 8 - 7", "Name the longest river of the whole continent.",
        "Photosynthesis", None, "", "...",
    ]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [
        items[0], "quiz: WHAT is the Capital, of france", "What is the capital of Spain?", "what is the capital",
        items[1], "Compute 3 + 4 * 5 - 6 / 2 + 9 * 8 - 1", "Compute 3 + 4 * 5 - 6 / 2 + 9 * 8",
        "and so Name the longest river of the whole continent", "about photosynthesis, twice photosynthesis.",
        "", None, "...", "x",
    ]
    got = {x[:2] for x in run(make_docs(spark, texts), bench)}
    assert got == {(0, 0), (1, 0), (4, 1), (7, 2), (8, 3)}


def test_cleaning_takes_items_of_one_or_two_words_as_whole_documents(spark):
    bench = spark.createDataFrame([(1, "Paris"), (2, "New York."), (3, "Is it so?")], "item_id long, text string")
    texts = ["paris!", "I have seen Paris", "NEW york", "in New York", "tell me: is it so", "Paris Paris"]
    docs = make_docs(spark, texts)
    assert {r[0] for r in run(docs, bench)} == set(range(6))
    assert {r["doc_id"] for r in decontam.drop_contaminated(docs, bench).collect()} == {1, 3, 5}
