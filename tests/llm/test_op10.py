from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np

from martlake.llm import line_dedup
from tests.conftest import SF001, SF01
from tests.llm.helpers import ODD_TEXTS, lower_az, make_docs, table_rows

STRIP = " \t\n\x0b\x0c\r"


def brute(rows):
    holders = defaultdict(set)
    split = [(d, (t or "").split("\n")) for d, t in rows]
    key = lambda x: lower_az(x.strip(STRIP))
    for d, lines in split:
        for x in lines:
            if len(key(x)) >= 40:
                holders[key(x)].add(d)
    out = []
    for d, lines in split:
        keep = [x for x in lines if not (len(h := holders.get(key(x), ())) >= 5 and max(h) != d)]
        sha = hashlib.sha256("\n".join(keep).encode()).hexdigest()
        out.append((d, len(lines), len(lines) - len(keep), sha))
    return sorted(out)


def run(df):
    return sorted(map(tuple, line_dedup.line_report(df).collect()))


def test_whole_table(spark):
    for sf in (SF001, SF01):
        docs = spark.read.parquet(f"{sf}/documents.parquet")
        want = brute(table_rows("documents", sf))
        assert run(docs) == want
        assert sum(x[2] for x in want) > 0


def test_odd_texts_ties_and_hot_line(spark):
    hot = "This very line stands in every document of the table"
    texts = [*ODD_TEXTS, *([f"own {i} " + "z" * 50 + "\n  " + hot.upper() + "\t\n" + hot for i in range(300)])]
    texts += ["forty code points are needed to count: é" + "é" * i for i in (0, 0, 0, 0, 0, 1, 1, 1, 1)]
    assert run(make_docs(spark, texts)) == brute(list(enumerate(texts)))
    assert run(make_docs(spark, texts).limit(0)) == []


def test_hot_line_over_many_partitions(spark):
    """One line over many range partitions, several times in some documents."""
    hot = "h" * 45
    texts = [hot + ("\n" + hot) * (i % 3) + f"\n{'q' * 40}{i % 40}" for i in range(2000)]
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert run(make_docs(spark, texts).repartition(5)) == brute(list(enumerate(texts)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    line = "l" * 41
    rows = [(i, line + "\nx", "r") for i in (1, 2, 3, 4, 5, 5, 5)] + [(5, "other\n" + line, "r"), (None, line, "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string")
    got = run(docs)
    assert got == brute([(d, t) for d, t, _ in rows if d is not None])


def test_drop_lines_keeps_columns_and_null_ids(spark):
    line = "M" * 40
    docs = make_docs(spark, [f"{line}\n{i}" for i in range(6)]).union(
        make_docs(spark, [line]).selectExpr("cast(null as long)", "text", "lang", "source", "n_chars")
    )
    out = {r["doc_id"]: r for r in line_dedup.drop_lines(docs).collect()}
    assert line_dedup.drop_lines(docs).columns == docs.columns
    assert out[0]["text"] == "0" and out[0]["n_chars"] == 1
    assert out[5]["text"] == f"{line}\n5" and out[None]["text"] == line


def test_bitmap_round_trip():
    for n, gone in ((1, [0]), (8, [7]), (9, [0, 8]), (1000, range(0, 1000, 3))):
        keep = line_dedup.unpack_keep(line_dedup.pack_keep(np.array(list(gone))), n)
        assert set(np.flatnonzero(~keep)) == set(gone)
