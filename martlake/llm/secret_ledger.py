"""Secret scans with an incremental ledger of content-addressed blobs.

Every version of every path is reduced to a blob id (SHA-256 of its text).
The ledger, a folder of two Parquet tables, remembers which (blob, rule
version) pairs were scanned and what was found.  A scan reads each blob that
still lacks a rule version once, however many paths and versions share it,
applies only the missing rules, appends to the ledger, and joins the findings
back to all paths.

Offsets are code points, end exclusive.  Null texts count as empty; a null
path is a path of its own kind and gets its findings as well; repeated rows
and equal texts share one blob.  A text of any length is scanned whole; an empty table
gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.llm.tables import new_scratch_dir, written


@dataclass(frozen=True)
class Rule:
    """Leftmost, non-overlapping matches of ``pattern`` whose ``group`` has at
    least ``least`` characters.  A changed rule gets a new ``version``."""

    name: str
    version: int
    pattern: str
    group: int
    least: int
    any_case: bool = False

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


#: In the order in which findings at one place are listed.
RULES: tuple[Rule, ...] = (
    Rule(
        "assign", 1,
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 12, any_case=True,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", 1, r"[0-9a-f]{16,}", 0, 16),
)

_FINDING = "blob binary, rule string, start long, end long"
_SEEN = "blob binary, rules array<string>"


def find(rule: Rule, text: str) -> list[tuple[int, int]]:
    flags = re.ASCII | (re.IGNORECASE if rule.any_case else 0)
    return [
        m.span() for m in re.compile(rule.pattern, flags).finditer(text)
        if m.end(rule.group) - m.start(rule.group) >= rule.least
    ]


def blob_id(text_column: str = "text"):
    return F.unhex(F.sha2(F.coalesce(F.col(text_column), F.lit("")), 256))


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    if jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def scan(
    versions: DataFrame, ledger: str, rules: Sequence[Rule] = RULES,
    path_column: str = "path", text_column: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Brings the ledger up to date for ``versions`` (one row per version of a
    path) and returns ``(paths, findings)``: the blob of every row's path, and
    (blob, rule, start, end) for those blobs and the given rules, each blob's
    findings once."""
    spark = versions.sparkSession
    rows = versions.select(
        F.col(path_column).alias("path"), blob_id(text_column).alias("blob"), F.col(text_column).alias("text")
    )
    paths = written(rows.select("path", "blob"), "blob-paths")
    wanted = F.array(*(F.lit(r.key) for r in rules))
    seen = (
        _read(spark, f"{ledger}/seen", _SEEN)
        .groupBy("blob")
        .agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("done"))
    )
    # one path stands for each blob; nothing but ids is shuffled so far
    todo = (
        paths.groupBy("blob").agg(F.min("path").alias("path"))
        .join(seen, "blob", "left")
        .withColumn("todo", F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>"))))
        .filter(F.size("todo") > 0)
        .select(F.col("blob").alias("b"), F.col("path").alias("p"), "todo")
    )
    todo = written(todo, "blob-todo")
    by_key = {r.key: r for r in rules}

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = {
            k: re.compile(r.pattern, re.ASCII | (re.IGNORECASE if r.any_case else 0)) for k, r in by_key.items()
        }
        for batch in batches:
            found = []
            for blob, text, keys in zip(*(batch.column(i) for i in range(3))):
                raw, blob = text.as_py() or "", blob.as_py()
                for key in keys.as_py():
                    g, least = by_key[key].group, by_key[key].least
                    found += [
                        (blob, key, m.start(), m.end()) for m in compiled[key].finditer(raw)
                        if m.end(g) - m.start(g) >= least
                    ]
            b, k, s, e = zip(*found) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(b, pa.binary()), pa.array(k, pa.string()), pa.array(s, pa.int64()), pa.array(e, pa.int64())],
                ["blob", "rule", "start", "end"],
            )

    on = rows["blob"].eqNullSafe(todo["b"]) & rows["path"].eqNullSafe(todo["p"])
    texts = rows.join(todo.hint("shuffle_hash"), on).select("blob", "text", "todo")
    new = texts.mapInArrow(apply, _FINDING).distinct()  # a representative row may stand there twice
    # findings first: a scan cut short between the two writes is repeated, and
    # findings read through distinct() never count twice
    new.write.mode("append").parquet(f"{ledger}/findings")
    todo.select(F.col("b").alias("blob"), F.col("todo").alias("rules")).write.mode("append").parquet(f"{ledger}/seen")
    findings = (
        _read(spark, f"{ledger}/findings", _FINDING)
        .filter(F.col("rule").isin(list(by_key)))
        .join(paths.select("blob").distinct(), "blob", "left_semi")
        .distinct()
    )
    return paths, findings


def span_digest(findings: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Per blob with findings: how many of each rule, and all spans as
    ``name:start:end`` by start, then in the order of ``rules``."""
    rank = reduce(lambda c, ir: c.when(F.col("rule") == ir[1].key, ir[0]), enumerate(rules), F)
    name = F.element_at(F.split("rule", "@"), 1)
    spans = F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "end", name.alias("name"))))
    text = F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["name"], x["start"], x["end"])))
    counts = [F.count_if(F.col("rule") == r.key).alias(f"n_{r.name}") for r in rules]
    return findings.groupBy("blob").agg(*counts, text.alias("spans"))


def secret_report(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    ledger = ledger or new_scratch_dir(docs.sparkSession, "secret-ledger")
    paths, findings = scan(docs, ledger, RULES, "doc_id", "text")
    digest = span_digest(findings, RULES)
    counts = [F.coalesce(f"n_{r.name}", F.lit(0).cast("long")).alias(f"n_{r.name}") for r in RULES]
    spans = F.coalesce("spans", F.lit(""))
    return paths.join(digest, "blob", "left").select(
        F.col("path").alias("doc_id"), *counts, F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans")
    )
