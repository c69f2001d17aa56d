"""Toxicity by weak supervision.

*Voters.*  Each lexicon family, each pattern and each stratum of mined units either
fires on a text or not; a document's votes are one bit mask.  Units are words and
word beginnings that stand out in labelled toxic rows (``mine``), for insults that no
list here has: all labelled rows count, and every unit that stands out gets a vote.
Units vote by how strongly they stand out, so that a voter is a set of units of like
reliability, and there are as many voters however many insults there are.

*Label model.*  A hidden class (toxic or not) generates the votes.  Voters are
grouped into cliques: pairs whose votes stay correlated, given the class, share
one joint table; the rest are independent given the class.  A voter that does not fire
abstains; that no voter of words fires is a vote of its own.  The given labels
are one more noisy voter, present on some rows only.  Class rate and tables are
estimated by EM from counts of vote masks (at most 3 * 2**20 of them, by the number
of voters; hundreds in practice), first with independent voters, then with the
correlated pairs found from the residual covariances.

*Classifier.*  A logistic regression over the label model's log-odds of the votes and
hashed distinct words is trained on the posterior labels, each row counted with both
classes by its posterior.  It is fitted on at most ``SAMPLE_ROWS`` labelled rows, those
with the smallest hash of their id.  A score reads nothing but the text.

Labelled texts are read once to find the units, then every text once: votes and word
places are written, and training and scoring read those.

Only rows that are not held out (see ``held_out``) teach anything.

Defined cases: null and empty texts have no votes and no words and get the score of
a text without any; without any labelled row to learn from the score is the label
model's posterior of the votes.  Repeated rows are scored alike; a document with
several labels counts as toxic if one says so; a null id teaches without a label.
Long texts are read whole.  An empty table gives an empty result.  Columns of any
other names pass through ``drop_toxic``.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, StructField, StructType

from martlake.llm.tables import free_names, row_key, written

#: Word families; a voter fires if a text has one of its words.
LEXICON: dict[str, str] = {
    "idiot": "idiot idiots idiotic idiota idiotas idiote idioten",
    "moron": "moron morons moronic imbecile imbecil imbécil imbécile",
    "stupid": "stupid stupidity stupide estúpido estúpida dummkopf blödmann",
    "clown": "clown clowns payaso buffoon",
    "loser": "loser losers versager perdedor",
    "scum": "scum scumbag vermin abschaum",
    "trash": "trash garbage filthy basura",
    "worthless": "worthless useless wertlos",
    "pathetic": "pathetic pitiful erbärmlich pathétique patético",
    "disgusting": "disgusting repulsive ekelhaft dégoûtant asqueroso",
    "hate": "hate hateful despise",
}
#: Patterns over the whole text, and what a text must hold for them to match (a
#: quick test; ``words`` are its lower-cased words).
PATTERNS: dict[str, str] = {
    "shouting": r"(?:\b[A-ZÄÖÜÉÈÊÇÑ]{3,}\b\W+){4}",
    "exclaiming": r"!{2,}",
    "masked_word": r"\b\w+[*@#$%]{2,}\w*",
    "you_are": r"(?i)\b(?:you|you're|du bist|tu es|eres)\s+(?:are\s+)?(?:an?\s+|ein\s+|un\s+)?\w+",
    "stretched": r"([^\W\d_])\1{4,}",  # in a lower-cased word
}
_CAPITALS = re.compile("[A-ZÄÖÜÉÈÊÇÑ]{3}").search
_MASKS = re.compile("[*@#$%]{2}").search
_ADDRESS = {"you", "du", "tu", "eres"}
_QUICK = {
    "shouting": lambda text, words: _CAPITALS(text),
    "exclaiming": lambda text, words: "!!" in text,
    "masked_word": lambda text, words: _MASKS(text),
    "you_are": lambda text, words: not _ADDRESS.isdisjoint(words),
}
#: Lengths of word beginnings, and the least evidence of each stratum of units:
#: the log ratio of their shares of toxic and other rows, less one standard error.
STEM_LENGTHS = (3, 4, 5, 6, 7)
STRATA = (2.5, 3.5, 4.5, 6.0)
#: A unit occurs in this share of the toxic rows and in so many rows at least.  (With
#: the share, at most 1 / UNIT_SHARE times the mean number of units in a toxic row.)
UNIT_SHARE, UNIT_ROWS = 0.002, 4
VOTERS = [*LEXICON, *PATTERNS, *(f"stratum_{i}" for i in range(len(STRATA)))]

#: The voters that read words.
EVIDENCE = sum(1 << j for j, name in enumerate(VOTERS) if name not in PATTERNS)
_PLACE_BITS = 15
DIMENSIONS = 1 << _PLACE_BITS
#: Words that a task remembers.
WORDS_KEPT = 200_000
SAMPLE_ROWS = 20_000
#: A pair of voters whose residual correlation, given the class, is larger
#: than this shares a joint table.
CORRELATED = 0.1
#: Log-odds are cut at so much; labels are broadcast up to so many rows.
ODDS, BROADCAST_LABELS = 12.0, 1_000_000
#: Weight of the squared coefficients in the classifier's loss.
PENALTY = 1e-5
_WORD = r"[^\W\d_]+"


def fold(id_column: str = "doc_id") -> Column:
    return F.crc32(F.col(id_column).cast("string")) % 5


def held_out(id_column: str = "doc_id") -> Column:
    """True for rows that teach nothing; a null id is not held out."""
    return F.coalesce(fold(id_column) == 0, F.lit(False))


class _Words(dict):
    """Votes and hashed place of a word, packed in one number, by the word."""

    def __init__(self, units: dict[str, int]):
        self.family = {w: 1 << i for i, ws in enumerate(LEXICON.values()) for w in ws.split()}
        first = len(LEXICON) + len(PATTERNS)
        self.units = {u: 1 << (first + k) for u, k in units.items()}
        self.lengths = sorted({len(u) for u in units if not u.startswith("=")})
        self.stretched, self.stretch_bit = re.compile(PATTERNS["stretched"]).search, 1 << (first - 1)

    def __missing__(self, w: str) -> int:
        votes = self.family.get(w, 0) | self.units.get("=" + w, 0)
        for n in self.lengths:
            votes |= self.units.get(w[:n], 0) if len(w) >= n else 0
        if self.stretched(w):
            votes |= self.stretch_bit
        place = zlib.crc32(w.encode("utf-8", "surrogatepass")) % DIMENSIONS
        self[w] = votes * DIMENSIONS + place
        return self[w]


class Reader:
    """Votes and word places of texts.  ``units`` maps each mined unit, a word
    (written ``=word``) or a beginning, to its stratum."""

    def __init__(self, units: dict[str, int] | None = None):
        self.find = re.compile(_WORD).findall
        self.known = _Words(units or {})
        self.patterns = [
            (_QUICK[name], re.compile(p).search, 1 << (len(LEXICON) + i))
            for i, (name, p) in enumerate(PATTERNS.items()) if name in _QUICK
        ]

    def read(self, text: str | None) -> tuple[int, np.ndarray]:
        """The vote mask, and the distinct hashed places of the words."""
        if not text:
            return 0, np.zeros(0, np.uint16)
        if len(self.known) > WORDS_KEPT:
            self.known.clear()
        words = set(self.find(text.lower()))
        found = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        votes = int(np.bitwise_or.reduce(found >> _PLACE_BITS)) if len(found) else 0
        for quick, search, bit in self.patterns:
            if quick(text, words) and search(text):
                votes |= bit
        return votes, np.unique(found & (DIMENSIONS - 1)).astype(np.uint16)


def _named(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def unit_counts(rows: DataFrame) -> DataFrame:
    """(unit, clean, toxic, forms): how many labelled rows (text, toxic) of each
    class hold each word (``=word``) or beginning, and of how many words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, listed = re.compile(_WORD).findall, {w for ws in LEXICON.values() for w in ws.split()}
        for batch in batches:
            seen: tuple[dict[str, int], dict[str, int]] = ({}, {})
            for text, toxic in zip(batch.column(0), batch.column(1)):
                words = set(find((text.as_py() or "").lower())) - listed
                units = {w[:n] for n in STEM_LENGTHS for w in words if len(w) >= n}
                units.update(["=" + w for w in words])
                counts = seen[toxic.as_py()]
                for u in units:
                    counts[u] = counts.get(u, 0) + 1
            for toxic, counts in enumerate(seen):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64()),
                     pa.array(np.full(len(counts), toxic, np.int32))],
                    ["unit", "n", "toxic"],
                )

    counted = rows.mapInArrow(run, "unit string, n long, toxic int").groupBy("unit")
    return counted.agg(
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("clean"),
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"),
    )


def mine(rows: DataFrame) -> dict[str, int]:
    """The units that stand out in the toxic ones of some labelled rows (text,
    toxic), with their strata.  A unit is left out where a beginning of it has at
    least its stratum."""
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_toxic, n_clean = n.get(1, 0), n.get(0, 0)
    t, c = F.col("toxic") + 0.5, F.col("clean") + 0.5
    evidence = F.log(t / (n_toxic + 1)) - F.log(c / (n_clean + 1)) - F.sqrt(1 / t + 1 / c)
    standing = (
        unit_counts(rows).filter(F.col("toxic") >= max(UNIT_ROWS, UNIT_SHARE * n_toxic))
        .withColumn("evidence", evidence).filter(F.col("evidence") >= STRATA[0]).select("unit", "evidence").collect()
    )
    out: dict[str, int] = {}
    for unit, found in sorted(standing, key=lambda r: (len(r[0].lstrip("=")), r[0])):
        stratum = sum(found >= e for e in STRATA) - 1
        word = unit.lstrip("=")
        if not any(out.get(word[:k], -1) >= stratum for k in STEM_LENGTHS if k <= len(word)):
            out[unit] = stratum
    return out


def votes_of(docs: DataFrame, units: dict[str, int], keep: list[str], names: tuple[str, str] = ("votes", "places")) -> DataFrame:
    """The columns ``keep`` of the rows and two more: the vote mask, and the word
    places (16-bit numbers in a binary).  Only texts go to Python, and only the two
    new columns come back."""

    @F.arrow_udf(StructType([StructField("votes", LongType()), StructField("places", BinaryType())]))
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = Reader(units)
        for texts in batches:
            votes, places = np.zeros(len(texts), np.int64), []
            for i, text in enumerate(texts):
                votes[i], found = reader.read(text.as_py())
                places.append(found.tobytes())
            yield pa.StructArray.from_arrays([pa.array(votes), pa.array(places, pa.binary())], ["votes", "places"])

    kept, (name,) = [_named(c) for c in keep], free_names([*keep, *names], "read")
    out = docs.select(*kept, read("text").alias(name))
    return out.select(*kept, F.col(f"{name}.votes").alias(names[0]), F.col(f"{name}.places").alias(names[1]))


class LabelModel:
    """P(class, votes, label) with disjoint cliques of one or two voters.

    With ``evidence`` (a mask of voters) a voter that does not fire abstains, which
    tells nothing, since a text has the words of one language only; that none of the
    voters in the mask fires is then one more vote."""

    def __init__(self, n_voters: int, evidence: int | None = None):
        self.evidence = evidence
        self.n = n_voters + (evidence is not None)
        self.cliques: list[tuple[int, ...]] = [(j,) for j in range(n_voters)]
        self.rate = 0.1
        # voters that read words are first taken to be reliable, patterns not
        patterns = range(len(LEXICON), len(LEXICON) + len(PATTERNS))
        self.tables = [np.array([[0.9, 0.1], [0.85, 0.15]] if j in patterns else [[0.98, 0.02], [0.7, 0.3]])
                       for j in range(n_voters)]
        if evidence is not None:
            self.cliques.append((n_voters,))
            self.tables.append(np.array([[0.05, 0.95], [0.7, 0.3]]))
        self.label = np.array([[0.95, 0.05], [0.1, 0.9]])

    def _bits(self, masks: np.ndarray) -> np.ndarray:
        if self.evidence is None:
            return (masks[:, None] >> np.arange(self.n)) & 1
        return np.column_stack([(masks[:, None] >> np.arange(self.n - 1)) & 1, (masks & self.evidence) == 0])

    def _state(self, bits: np.ndarray, clique: tuple[int, ...]) -> np.ndarray:
        return sum(bits[:, j] << i for i, j in enumerate(clique))

    def posterior(self, masks: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """P(toxic | votes, label); label -1 is unknown."""
        bits = self._bits(masks)
        log = np.log(np.array([1 - self.rate, self.rate]))[None, :].repeat(len(masks), 0)
        for clique, table in zip(self.cliques, self.tables):
            state = self._state(bits, clique)
            told = np.log(table[:, state]).T
            log += told if self.evidence is None else np.where((state > 0)[:, None], told, 0)
        known = labels >= 0
        log[known] += np.log(self.label[:, labels[known]]).T
        p = np.exp(log - log.max(1, keepdims=True))
        return p[:, 1] / p.sum(1)

    def _fit(self, masks, labels, counts, rounds):
        bits = self._bits(masks)
        for _ in range(rounds):
            p = self.posterior(masks, labels)
            weight = np.stack([counts * (1 - p), counts * p])
            self.rate = float(np.clip((weight[1].sum() + 1) / (counts.sum() + 2), 1e-6, 1 - 1e-6))
            for k, clique in enumerate(self.cliques):
                size, state = 1 << len(clique), self._state(bits, clique)
                got = np.stack([np.bincount(state, w, minlength=size) for w in weight]) + 0.1
                self.tables[k] = got / got.sum(1, keepdims=True)
            known = labels >= 0
            if known.any():
                got = np.stack([np.bincount(labels[known], w[known], minlength=2) for w in weight]) + 0.1
                self.label = got / got.sum(1, keepdims=True)

    def correlations(self, masks, labels, counts) -> np.ndarray:
        """Correlation of each pair of voters within the classes."""
        bits = self._bits(masks).astype(float)
        p = self.posterior(masks, labels)
        cov, var = np.zeros((self.n, self.n)), np.zeros(self.n)
        for w in (counts * (1 - p), counts * p):
            mean = (w[:, None] * bits).sum(0) / max(w.sum(), 1e-9)
            off = bits - mean
            cov += (w[:, None] * off).T @ off
            var += (w[:, None] * off * off).sum(0)
        scale = np.sqrt(np.outer(var, var))
        return np.where(scale > 0, cov / np.where(scale > 0, scale, 1), 0)

    def fit(self, masks: np.ndarray, labels: np.ndarray, counts: np.ndarray, rounds: int = 60) -> LabelModel:
        if not len(masks):
            return self
        self._fit(masks, labels, counts, rounds)
        found = np.abs(np.triu(self.correlations(masks, labels, counts), 1))
        if self.evidence is not None:
            found[:, -1] = 0  # the last vote is made of the others
        free, pairs = set(range(self.n)), []
        for at in np.argsort(-found, axis=None, kind="stable"):
            a, b = divmod(int(at), self.n)
            if found[a, b] <= CORRELATED:
                break
            if a in free and b in free:
                free -= {a, b}
                pairs.append((a, b))
        if pairs:
            alone = {c[0]: t for c, t in zip(self.cliques, self.tables)}
            self.cliques = [*pairs, *((j,) for j in sorted(free))]
            self.tables = [
                alone[c[0]] if len(c) == 1 else np.stack(
                    [np.outer(alone[c[1]][y], alone[c[0]][y]).ravel() for y in (0, 1)])
                for c in self.cliques
            ]
            self._fit(masks, labels, counts, rounds)
        return self


@dataclass
class Scorer:
    """Scores votes and word places; its size depends on ``DIMENSIONS`` only."""

    labels: LabelModel
    intercept: float = 0.0
    weights: np.ndarray | None = None  # of the places, then of the log-odds

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        """Log-odds of toxic by the votes alone, between -``ODDS`` and ``ODDS``."""
        masks, back = np.unique(votes, return_inverse=True)
        p = self.labels.posterior(masks, np.full(len(masks), -1)) if len(masks) else np.zeros(0)
        e = math.exp(-ODDS)
        return np.clip(np.log((p + e) / (1 - p + e)), -ODDS, ODDS)[back]

    def scores(self, votes: np.ndarray, places: list[bytes]) -> np.ndarray:
        z = self.log_odds(votes)
        if self.weights is not None:
            size = np.fromiter(map(len, places), np.int64, len(places)) // 2
            at = np.frombuffer(b"".join(places), np.uint16)
            ends = np.concatenate(([0], np.cumsum(self.weights[:DIMENSIONS][at])))
            stop = np.cumsum(size)
            words = (ends[stop] - ends[stop - size]) / np.sqrt(np.maximum(size, 1))
            z = self.intercept + self.weights[DIMENSIONS] * z + words
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def learnt_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the labelled rows that are not held out, each id once."""
    given = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
    return given.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))


def fit(read: DataFrame, given: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Scorer:
    """Learns from ``read`` (doc_id, votes, places) and the labels ``given``."""
    # needed on the driver only (and for a sample): tasks that read texts stay small
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import SparseVector, VectorUDT

    counted = (
        read.filter(~held_out()).select("doc_id", "votes").join(given, "doc_id", "left")
        .groupBy("votes", F.coalesce("toxic", F.lit(-1)).alias("toxic")).agg(F.count(F.lit(1)).alias("n"))
        .collect()  # a row per vote mask and label that occur
    )
    counted.sort()
    masks, known, counts = (np.array([r[i] for r in counted], dtype=np.int64) for i in range(3))
    model = LabelModel(len(VOTERS), EVIDENCE).fit(masks, known, counts.astype(float))
    scorer = Scorer(model)

    @F.udf(VectorUDT())
    def vector(places: bytes, odds: float) -> SparseVector:
        at = np.frombuffer(places, np.uint16)
        values = np.full(len(at) + 1, 1 / math.sqrt(max(1, len(at))))
        values[-1] = odds
        return SparseVector(DIMENSIONS + 1, np.append(at.astype(np.int32), DIMENSIONS), values)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes, toxic = (batch.column(i).to_numpy() for i in (0, 2))
            p = pa.array(model.posterior(votes, toxic) if len(votes) else votes.astype(float))
            yield pa.RecordBatch.from_arrays([p, batch.column(1), pa.array(scorer.log_odds(votes))], ["p", "places", "odds"])

    sample = given.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    # at most sample_rows ids
    chosen = read.join(F.broadcast(sample), "doc_id").select("votes", "places", F.col("toxic").cast("long"))
    drawn = chosen.mapInArrow(judged, "p double, places binary, odds double")
    x = written(drawn.select(vector("places", "odds").alias("features"), "p"), "training-rows")
    if x.isEmpty():
        return scorer
    both = x.select("features", F.lit(1.0).alias("label"), F.col("p").alias("weight")).union(
        x.select("features", F.lit(0.0).alias("label"), (1 - F.col("p")).alias("weight"))
    )
    trained = LogisticRegression(
        weightCol="weight", regParam=PENALTY, maxIter=100, standardization=False, family="binomial"
    ).fit(both.filter("weight > 0"))
    scorer.intercept, scorer.weights = float(trained.intercept), np.array(trained.coefficients.toArray())
    return scorer


def scored(docs: DataFrame, labels: DataFrame, keep: list[str], name: str = "score") -> DataFrame:
    """The columns ``keep`` (``doc_id`` among them) of the rows, and their score."""
    given = learnt_labels(labels)
    if given.count() <= BROADCAST_LABELS:  # else both sides are shuffled
        given = F.broadcast(given)
    texts = docs.select("doc_id", "text").join(given, "doc_id").select("text", "toxic")
    votes, places = free_names([*keep, name], "votes", "places")
    read = written(votes_of(docs, mine(texts), keep, (votes, places)), "word-places")
    short = read.select("doc_id", F.col(votes).alias("votes"), F.col(places).alias("places"))
    scorer = fit(short, learnt_labels(labels))

    @F.arrow_udf(DoubleType())
    def score(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for masks, words in batches:
            yield pa.array(scorer.scores(masks.to_numpy(), words.to_pylist()))

    # the kept columns, whole texts among them, stay out of Python
    return read.select(*(_named(c) for c in keep), score(votes, places).alias(name))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    out = scored(docs.select("doc_id", "text"), labels, ["doc_id"])
    return out.select("doc_id", held_out().alias("held_out"), "score").withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic; columns as they were.  Toxic
    rows are named by id and ``row_key``: the table that is written for scoring
    holds no texts and no other columns."""
    row, doc = free_names(docs.columns, "row", "id")
    short = docs.select("doc_id", "text", row_key().alias("row"))
    bad = scored(short, labels, ["doc_id", "row"]).filter("score >= 0.5")
    bad = bad.select(F.col("row").alias(row), F.col("doc_id").alias(doc)).distinct()
    on = (row_key() == F.col(row)) & F.col("doc_id").eqNullSafe(F.col(doc))
    return docs.join(bad.hint("shuffle_hash"), on, "left_anti")
