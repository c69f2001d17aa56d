"""Small document tables and brute-force building blocks for the tests."""

from __future__ import annotations

import re

import duckdb

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Texts that every operator has to take.
ODD_TEXTS = [
    None, "", " ", "\n", "\n\n", "a", "\t\x0b\x0c\r ", "ß é 漢字 \U0001f600", "x" * 5000,
    "aaaa " * 400, " no break ", "one two", "one two", "İ ſ K k K", "<|endoftext|>",
    "line one\nline one\nline one", "tail newline\n", "﻿bom", "a\x00b", "9" * 300,
]


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower_az(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def make_docs(spark, texts, first_id=0):
    return spark.createDataFrame(
        [(first_id + i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)], DOC_SCHEMA
    )


def table_rows(name: str, sf_dir: str, columns: str = "doc_id, text"):
    return duckdb.sql(f"SELECT {columns} FROM read_parquet('{sf_dir}/{name}.parquet')").fetchall()


def by_id(df, key="doc_id"):
    rows = df.collect()
    out = {r[key]: r for r in rows}
    assert len(out) == len(rows)
    return out
