"""Token counts of a byte-level BPE vocabulary, mostly by table lookup.

Such a tokenizer first splits a text into pre-tokens, then merges inside each
one.  :func:`proven_singles` goes through the vocabulary once, offline, and
keeps the strings which the library itself splits into one pre-token and
encodes as exactly one token.  A pre-token found in that table counts 1; only
the rest are merged by the library, each distinct one once per task while the
table of learned counts has room.  They are merged by rank when the vocabulary
numbers its merges in order (checked offline), else by the library.

Two implementations of Unicode may disagree on new characters.  Each character
beyond Latin is therefore checked once per task against the library's own
splitting, and texts with one that differs are split by the library.

The library's default handling of special strings is kept: they are cut out
of a text first and count as one token each.  Null and empty texts have 0 bytes
and 0 tokens; repeated rows and null ids each give a row; texts of any length are
counted whole, one at a time; an empty table gives an empty result; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How a byte-level tokenizer splits text before it merges (public pattern).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Learned counts that a task keeps, as code points of their strings.
LEARNED_POINTS = 8_000_000
LIMIT = 1024
_SLICE = 1 << 20


def _byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary writes each byte: printable
    bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def proven_singles(spec: str) -> list[str]:
    """The vocabulary strings that alone are one pre-token and one token."""
    from tokenizers import Tokenizer

    tok, letters = Tokenizer.from_str(spec), _byte_letters()
    specials = {t["content"] for t in json.loads(spec)["added_tokens"]}
    names = []
    for word in tok.get_vocab(with_added_tokens=False):
        try:
            text = bytes(letters[c] for c in word).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            continue
        if not any(s in text for s in specials):
            names.append(text)
    split = regex.compile(SPLIT)
    found = tok.encode_batch(names, add_special_tokens=False)
    return [
        t for t, e in zip(names, found)
        if len(e.ids) == 1 and split.findall(t) == [t] and len(tok.pre_tokenizer.pre_tokenize_str(t)) == 1
    ]


def merge_ranks(spec: str) -> dict[bytes, int] | None:
    """Token bytes to rank, if ids are the 256 bytes and then the merges in
    order, so that merging by rank is what the library does; else None."""
    model, letters = json.loads(spec)["model"], _byte_letters()
    vocab, merges = model["vocab"], model["merges"]
    joined = ["".join(m if isinstance(m, list) else m.split(" ")) for m in merges]
    if any(vocab.get(w) != 256 + i for i, w in enumerate(joined)) or len(vocab) != 256 + len(merges):
        return None
    return {bytes(letters[c] for c in w): i for w, i in vocab.items()}


class Counter:
    """Counts tokens in one task."""

    def __init__(self, spec: str, singles: list[str]):
        import tiktoken
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(spec)
        ranks = merge_ranks(spec)
        self.by_rank = ranks and tiktoken.Encoding(
            "ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}
        )._core_bpe.encode_single_piece
        self.beyond_latin = regex.compile(r"[^\x00-\u024F]").search
        self.agreed, self.differ = set(), set()
        self.split = regex.compile(SPLIT).findall
        specials = sorted((t["content"] for t in json.loads(spec)["added_tokens"]), key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.proven = dict.fromkeys(singles, 1)
        self.table, self.learned = dict(self.proven), 0

    def merge(self, words: list[str]) -> None:
        """Learns the counts of pre-tokens that are not in the table."""
        if self.by_rank:
            counts = [len(self.by_rank(w.encode("utf-8"))) for w in words]
        else:
            got = self.tok.encode(words, is_pretokenized=True, add_special_tokens=False)
            counts = np.bincount(np.array(got.word_ids, dtype=np.int64), minlength=len(words)).tolist()
        self.table.update(zip(words, counts))
        self.learned += sum(map(len, words))

    def _library_split(self, text: str) -> list[str]:
        return [text[i:j] for _, (i, j) in self.tok.pre_tokenizer.pre_tokenize_str(text)]

    def pieces(self, text: str) -> list[str]:
        """The pre-tokens of a text without special strings."""
        if self.beyond_latin(text):
            chars = set(text)
            for c in chars - self.agreed - self.differ:
                probes = (f"a{c}", f"1{c}", f"!{c}", f" {c}a")
                same = all(self.split(x) == self._library_split(x) for x in probes)
                (self.agreed if same else self.differ).add(c)
            if not chars.isdisjoint(self.differ):
                return self._library_split(text)
        return self.split(text)

    def count(self, texts: list[str]) -> list[int]:
        if self.learned > LEARNED_POINTS:
            self.table, self.learned = dict(self.proven), 0
        pieces, extra = [], []
        for text in texts:
            cut = self.specials.findall(text) if self.specials else []
            extra.append(len(cut))
            if cut:
                pieces.append([p for part in self.specials.split(text) for p in self.pieces(part)])
            else:
                pieces.append(self.pieces(text))
        rest = set().union(*pieces) - self.table.keys()
        if rest:
            self.merge(list(rest))
        look = self.table.__getitem__
        return [n + sum(map(look, p)) for n, p in zip(extra, pieces)]


def token_counts(
    docs: DataFrame, spec: str, limit: int = LIMIT, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per document: its id, n_bytes, n_tokens, over_limit.  ``spec`` is the
    tokenizer's JSON text, read on the driver, so executors need no file."""
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast((spec, proven_singles(spec)))  # one vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(*shared.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            tokens, held, size = [], [], 0
            for t in texts:
                held.append(t)
                size += len(t)
                if size > _SLICE:
                    tokens += counter.count(held)
                    held, size = [], 0
            tokens += counter.count(held)
            n_bytes = [len(t) if t.isascii() else len(t.encode("utf-8", "surrogatepass")) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(tokens, pa.int64())],
                ["id", "n_bytes", "n_tokens"],
            )

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit).withColumnRenamed("id", id_column)
