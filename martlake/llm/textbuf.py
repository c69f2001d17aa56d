"""Vectorised helpers over a run of texts joined into one byte buffer.

A :class:`TextBuf` holds some documents as UTF-8 bytes, each followed by one
newline, with word and line spans and hashes of any span, all as numpy arrays.  Words are ``[^\\x20\\x09-\\x0D]+``; UTF-8 never uses those bytes
inside a character, so byte spans and code point spans agree.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes of text worked on at a time inside a task; a longer single document
#: is worked on whole, alone.
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (xor-shift and multiply rounds)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _stream(seed: int, n: int) -> np.ndarray:
    """n reproducible 64-bit values."""
    return mix64(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed))


def _limbs(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one number, bytes beyond the end
    as zeros; a view, nothing is multiplied in memory."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    return np.ndarray((len(buf) + 1,), "<u8", padded, strides=(1,))


#: Keeps the first k of eight bytes.
_FIRST_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=_U)
#: Spans longer than this are hashed one by one.
LONG_SPAN = 4096


class SpanHash:
    """64-bit hashes of arbitrary spans of a buffer: eight bytes at a time are
    xored into the value, which is scrambled after each step and begins with seed
    and length.  No table and no prefix sum, so memory goes with the number of
    spans, and (unlike polynomials modulo 2**64) no texts that collide for every
    seed; hashes of different seeds are independent."""

    def __init__(self, buf: np.ndarray, seed: int):
        self.buf, self.seed, self.limbs = buf, seed, _limbs(buf)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = end - start
        out = mix64(size.astype(_U) * _U(0xD6E8FEB86659FD93) + _stream(self.seed, 1))
        long = size > LONG_SPAN
        which = np.flatnonzero((size > 0) & ~long)
        at, left = start[which].astype(np.int64), size[which].astype(np.int64)
        while len(which):
            limb = self.limbs[at] & _FIRST_BYTES[np.minimum(left, 8)]
            out[which] = mix64(out[which] ^ limb)
            more = left > 8
            which, at, left = which[more], at[more] + 8, left[more] - 8
        for k in np.flatnonzero(long):
            out[k] = xxhash.xxh3_64_intdigest(self.buf[start[k] : end[k]].tobytes(), self.seed)
        return out


def gram_hash(buf: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hash of the n bytes (a multiple of 8) from each place on that has as many."""
    total, limbs = max(0, len(buf) - n + 1), _limbs(buf)
    out = np.broadcast_to(_stream(seed, 1), total)
    for k in range(0, n, 8):
        out = mix64(out ^ limbs[k : k + total])
    return out


class TextBuf:
    def __init__(self, texts: list[bytes], lower: bool = False):
        self.n_docs = len(texts)
        self.buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        self.doc_bytes = sizes
        self.doc_end = np.cumsum(sizes + 1) - 1  # place of each document's closing newline
        self.doc_start = self.doc_end - sizes
        self.text = _LOWER[self.buf] if lower else self.buf

    def doc_of(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_end, place, side="left")

    @functools.cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and document of every word, in order."""
        inside = np.concatenate(([False], ~_SPACE[self.buf], [False]))
        turns = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = turns[0::2], turns[1::2]
        return start, end, self.doc_of(start)

    @functools.cached_property
    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end (without the newline) and document of every line."""
        end = np.flatnonzero(self.buf == 0x0A)
        start = np.concatenate(([0], end[:-1] + 1))
        return start, end, self.doc_of(end)

    @functools.cached_property
    def points(self) -> np.ndarray:
        """Code points before each byte place."""
        out = np.zeros(len(self.buf) + 1, dtype=np.int32 if len(self.buf) < 1 << 31 else np.int64)
        np.cumsum((self.buf & 0xC0) != 0x80, out=out[1:], dtype=out.dtype)
        return out

    def count(self, docs: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        got = np.bincount(docs, weights=weights, minlength=self.n_docs)
        return got.astype(np.int64)


def as_bytes(text: str | None) -> bytes:
    """UTF-8 of a text; null counts as empty."""
    return text.encode("utf-8", "surrogatepass") if text else b""


def chunks(
    batches: Iterator[pa.RecordBatch], text_column: str = "text"
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cuts Arrow batches into slices of about ``CHUNK_BYTES`` of text; yields
    each slice with its texts as bytes."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text_column))
        first, texts, size = 0, [], 0
        for at in range(batch.num_rows):
            raw = as_bytes(column[at].as_py())
            if texts and size + len(raw) > CHUNK_BYTES:
                yield batch.slice(first, at - first), texts
                first, texts, size = at, [], 0
            texts.append(raw)
            size += len(raw)
        if texts:
            yield batch.slice(first, batch.num_rows - first), texts


def ngram_hash(word_hash: np.ndarray, word_doc: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place on; only the first ``len - n + 1``
    places, windows that cross documents included (see :func:`whole`)."""
    total = max(0, len(word_hash) - n + 1)
    out = np.zeros(total, dtype=_U)
    for j, factor in enumerate(_stream(1000 + n, n) | _U(1)):
        out += word_hash[j : j + total] * factor
    return mix64(out)


def whole(word_doc: np.ndarray, n: int) -> np.ndarray:
    """True where the n words from a place on belong to one document."""
    total = max(0, len(word_doc) - n + 1)
    return word_doc[:total] == word_doc[n - 1 : n - 1 + total]
