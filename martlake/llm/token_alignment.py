"""Alignment of two tokenizers over the same bytes, with corpus-wide counts of
linked token pairs.

A text is encoded by a byte-level vocabulary (A) as space + text and by a piece
vocabulary (B) that adds the space itself.  Token bytes are compared on one byte
axis: where tokens of both end, the axis is cut into groups; two tokens whose
byte ranges overlap are linked.

*Encoding.*  :func:`word_cut` proves offline, from the two vocabularies, that a
single space between two non-blank characters always starts a new token on both
sides.  Texts are split there, and each distinct word is encoded once per task by
the libraries themselves (without the proof a text is one word).  For A, words are
joined by single spaces again and encoded ``JOINED`` at a time; their tokens are told
apart by their bytes.  A word, and with it its text, is valid if the token bytes of
both sides are space + word.

*Lockstep merging.*  The words of all documents of a batch are laid out as lanes
(a long document has several, cut between words, where both sides end a token).
One vector of A places and one of B places holds the state of every lane.  Each
step emits one link per lane, emits a cut where both ends agree, advances the side
that ends first (or both), and drops the finished lanes.

*Counts.*  Documents are packed in lumps with a dictionary of their id pairs.  The
number of documents that hold a pair is summed over dictionaries; the sums come
back joined to the dictionaries, once per lump and pair and not once per
document, and each lump is finished by itself.  The highest count of an A id is
a table of at most one row per vocabulary entry.

Defined cases: null, empty and invalid texts have no tokens: zeros and ``''``;
rows with null or repeated ids are rows of their own and count as documents of
their own; other columns, whatever their names, are not read; an empty table
gives an empty result.  Texts of any length are worked on in segments of about
``SEGMENT`` characters; only one word without any such space is taken whole.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.tables import written
from martlake.llm.token_shortcut import _byte_letters

#: Characters of one segment of a text, and of all segments merged at a time.
SEGMENT, BATCH = 1 << 19, 1 << 20
#: Words in a lane.
LANE = 128
#: Pairs (one per document and id pair) in a lump.
LUMP_PAIRS = 1 << 20
#: Tokens (both sides) of the words that a task remembers, and words encoded
#: by one call of the libraries.
REMEMBERED, ENCODED = 2_500_000, 1 << 14
#: Words encoded as one text by A.
JOINED = 64

_GAP = re.compile(r"(?<=\S) (?=\S)")
#: A space beside another blank, or at an end: the text needs the pattern.
_BLANKS = re.compile(r" (?:(?<=\s )|(?=\s))")


@dataclass(frozen=True)
class Vocabularies:
    """Token bytes by id of both sides, and whether words may be cut."""

    spec: str
    model: bytes
    a_bytes: list[bytes]
    b_bytes: list[bytes]
    cut: bool

    @property
    def shift(self) -> int:
        """Bits of a B id in a pair key."""
        return max(1, (len(self.b_bytes) - 1).bit_length())


@functools.lru_cache(1)
def _libraries(spec: str, model: bytes):
    """Both libraries, loaded once in a process: loading them anew in every task
    leaves holes in its memory."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_str(spec)
    a.encode_special_tokens = True  # special strings in a text are plain text
    return a, sentencepiece.SentencePieceProcessor(model_proto=model)


def word_cut(a, b, pieces: list[str]) -> bool:
    """True if a single space between non-blank characters starts a token on
    both sides: A has no normalizer and splits before such a space whatever the
    class of the character after it; B adds a space in front, keeps the spaces of
    a text, and none of its pieces has a space after another character, so that
    no merge crosses one."""
    probes = ("é", "7", "$", "漢", "'s", "́", "\U0001f600")
    split = a.pre_tokenizer.pre_tokenize_str
    if a.normalizer is not None or any(
        len(x) + 1 not in {p[0] for _, p in split(f" {x} {y}")} for x in probes for y in probes
    ):
        return False
    if b.encode("x", out_type=str) != b.encode("x  y", out_type=str)[:1] or any(re.search("[^▁]▁", p) for p in pieces):
        return False
    whole = ["a  b", " a", "a ", "a \n b"]
    return all("".join(b.encode(t, out_type=str)).replace("▁", " ").replace("<0x0A>", "\n") == " " + t for t in whole)


def vocabularies(spec: str, model: bytes) -> Vocabularies:
    """Token bytes of the byte-level JSON ``spec`` and the piece ``model``."""
    a, b = _libraries(spec, model)
    letters = _byte_letters()
    names = a.get_vocab(with_added_tokens=True)
    a_bytes = [b""] * (max(names.values()) + 1)
    added = {t.content for t in a.get_added_tokens_decoder().values()}
    for name, i in names.items():
        a_bytes[i] = name.encode("utf-8") if name in added else bytes(letters[c] for c in name)
    pieces = [b.id_to_piece(i) for i in range(b.vocab_size())]
    b_bytes = [
        bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode("utf-8") for i, p in enumerate(pieces)
    ]
    return Vocabularies(spec, model, a_bytes, b_bytes, word_cut(a, b, pieces))


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of every run, one run after another."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(int(size.sum()))


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the lists, and how many each list has."""
    n = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int32, int(n.sum())), n


class Grown:
    """An array that grows at its end."""

    def __init__(self, dtype):
        self.data, self.n = np.zeros(1 << 12, dtype), 0

    def add(self, values: np.ndarray) -> None:
        need = self.n + len(values)
        if need > len(self.data):
            self.data = np.concatenate([self.data, np.zeros(max(need, len(self.data)), self.data.dtype)])
        self.data[self.n : need] = values
        self.n = need


class WordBook:
    """Numbers the distinct words a task meets and keeps their tokens."""

    def __init__(self, v: Vocabularies):
        self.v = v
        # a task has one core; threads of a library would each hold memory of their own
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a, self.b = _libraries(v.spec, v.model)
        self.length = [np.array([len(x) for x in side], np.int32) for side in (v.a_bytes, v.b_bytes)]
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.ends = [Grown(np.int32), Grown(np.int32)], [Grown(np.int32), Grown(np.int32)]
        self.first, self.count = [Grown(np.int64), Grown(np.int64)], [Grown(np.int64), Grown(np.int64)]
        self.size, self.valid = Grown(np.int64), Grown(bool)

    def split(self, text: str) -> list[str]:
        if not self.v.cut:
            return [text]
        blank = text[:1] == " " or text[-1:] == " " or _BLANKS.search(text)
        return _GAP.split(text) if blank else text.split(" ")

    def _ids_a(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _flat([e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)])

    def _encoded_a(self, words: list[str], size: np.ndarray, join: bool) -> tuple[np.ndarray, np.ndarray]:
        """A's ids of all words, and how many each has."""
        if join:
            ids, _ = self._ids_a([" ".join(words[at : at + JOINED]) for at in range(0, len(words), JOINED)])
            length = self.length[0][ids]
            ends, stop = np.cumsum(length, dtype=np.int64), np.cumsum(size)
            last = np.searchsorted(ends, stop)
            # every word's bytes end where a token ends, else each is encoded alone
            if length.all() and len(ends) and ends[-1] == stop[-1] and (ends[last] == stop).all():
                return ids, np.diff(last, prepend=-1)
        return self._ids_a(words)

    def learn(self, words: list[str], join: bool = False) -> None:
        """``join``: the words may be cut and have no blanks at their ends."""
        raw = [b" " + w.encode("utf-8", "surrogatepass") for w in words]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        valid = np.ones(len(words), bool)
        got = self._encoded_a(words, size, join), _flat(self.b.encode(words, num_threads=1))
        for side, ((flat, n), table) in enumerate(zip(got, (self.v.a_bytes, self.v.b_bytes))):
            first = np.cumsum(n) - n
            ends = np.cumsum(self.length[side][flat], dtype=np.int64)
            before, stop = (np.append(0, ends)[at] for at in (first, first + n))
            joined = b"".join(map(table.__getitem__, flat.tolist()))
            if joined != b"".join(raw) or (stop - before != size).any():
                valid &= [joined[x:y] == r for x, y, r in zip(before.tolist(), stop.tolist(), raw)]
            self.first[side].add(first + self.ids[side].n)
            self.count[side].add(n)
            self.ids[side].add(flat)
            self.ends[side].add(ends - np.repeat(before, n))
        self.size.add(size)
        self.valid.add(valid)
        self.number.update(zip(words, range(len(self.number), len(self.number) + len(words))))

    def numbers(self, segments: list[list[str]]) -> np.ndarray:
        if self.ids[0].n + self.ids[1].n > REMEMBERED:
            self.forget()
        new = set().union(*segments) - self.number.keys()
        blank = [w for w in new if not w or w[0].isspace() or w[-1].isspace()]
        for words, join in ((list(new.difference(blank)), self.v.cut), (blank, False)):
            for first in range(0, len(words), ENCODED):
                self.learn(words[first : first + ENCODED], join)
        look = self.number.__getitem__
        return np.fromiter(map(look, chain.from_iterable(segments)), np.int64, sum(map(len, segments)))


def lockstep(a_end, b_end, a_first, a_stop, b_first) -> tuple[np.ndarray, ...]:
    """Merges all lanes at once.  ``a_end`` and ``b_end`` are byte ends of the
    tokens of all lanes on one axis; lanes hold whole groups.  Returns the A and B
    places of every link (in step order) and of the last tokens of every group."""
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    live = a_first < a_stop
    i, j, stop = a_first[live], b_first[live], a_stop[live]
    while len(i):
        links_a.append(i)
        links_b.append(j)
        to_a, to_b = a_end[i], b_end[j]
        both = to_a == to_b
        cuts_a.append(i[both])
        cuts_b.append(j[both])
        i, j = i + (to_a <= to_b), j + (to_b <= to_a)
        live = i < stop
        if not live.all():  # finished lanes go
            i, j, stop = i[live], j[live], stop[live]
    none = [np.zeros(0, np.int64)]
    links_a, links_b, cuts_a, cuts_b = (np.concatenate(x or none) for x in (links_a, links_b, cuts_a, cuts_b))
    return links_a, links_b, np.sort(cuts_a), np.sort(cuts_b)


def _digits(n: int) -> np.ndarray:
    """Row i: the decimal digits of i, then zeros; the last column is free."""
    width = len(str(n))
    out = np.zeros((n, width + 1), np.uint8)
    out[:, :width] = np.arange(n).astype(f"S{width}").view(np.uint8).reshape(n, width)
    return out


@dataclass
class Segment:
    """What the merging of one segment found."""

    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    text: bytes = b""  # groups, each with its closing ';'
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    times: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    valid: bool = True


class Aligner:
    def __init__(self, v: Vocabularies):
        self.book, self.shift = WordBook(v), v.shift
        self.key_bits = v.shift + (len(v.a_bytes) - 1).bit_length()
        width = max(len(v.a_bytes), len(v.b_bytes))
        self.digits = _digits(width)
        self.n_digits = (self.digits != 0).sum(1)

    def merge(self, segments: list[str]) -> list[Segment]:
        """Links, cuts and pair counts of non-empty segments, all in lockstep."""
        book = self.book
        words = [book.split(s) for s in segments]
        number = book.numbers(words)
        n_words = np.fromiter(map(len, words), np.int64, len(words))
        seg = np.repeat(np.arange(len(words)), n_words)
        out = [Segment() for _ in segments]
        bad = np.bincount(seg, ~book.valid.data[number], minlength=len(words)) > 0
        for k in np.flatnonzero(bad):
            out[k].valid = False
        keep = ~bad[seg]
        number, seg = number[keep], seg[keep]
        n_words = np.where(bad, 0, n_words)
        if not len(number):
            return out
        size = book.size.data[number]
        base = np.cumsum(size) - size
        ids, ends, ptr, seg_of = [], [], [], []
        for side in (0, 1):
            n = book.count[side].data[number]
            at = ragged(book.first[side].data[number], n)
            ids.append(book.ids[side].data[at])
            ends.append(book.ends[side].data[at] + np.repeat(base, n))
            ptr.append(np.concatenate(([0], np.cumsum(n))))
            seg_of.append(np.repeat(seg, n))
        # lanes of LANE words, none of which crosses segments
        n_lanes = -(-n_words // LANE)
        word_first = np.cumsum(n_words) - n_words
        lane_first = np.repeat(word_first, n_lanes) + LANE * ragged(np.zeros(len(n_lanes), np.int64), n_lanes)
        lane_stop = np.append(lane_first[1:], len(number))
        li, lj, ci, cj = lockstep(ends[0], ends[1], ptr[0][lane_first], ptr[0][lane_stop], ptr[1][lane_first])

        n_out = len(words)
        count = [np.bincount(s, minlength=n_out) for s in (*seg_of, seg_of[0][ci], seg_of[0][li])]
        # text of the groups: A tokens, '|', B tokens, ';'
        group_a, group_b = np.diff(ci, prepend=-1), np.diff(cj, prepend=-1)
        a_place = np.arange(len(ids[0])) + np.repeat(cj + 1 - group_b, group_a)
        b_place = np.arange(len(ids[1])) + np.repeat(ci + 1, group_b)
        rows = np.zeros((len(ids[0]) + len(ids[1]), self.digits.shape[1]), np.uint8)
        rows[a_place], rows[b_place] = self.digits[ids[0]], self.digits[ids[1]]
        rows[:, -1] = 44  # ','
        rows[a_place[ci], -1], rows[b_place[cj], -1] = 124, 59  # '|', ';'
        flat = rows[rows != 0].tobytes()
        size_a = np.bincount(seg_of[0], self.n_digits[ids[0]] + 1, minlength=n_out)
        size_b = np.bincount(seg_of[1], self.n_digits[ids[1]] + 1, minlength=n_out)
        text_stop = np.cumsum((size_a + size_b).astype(np.int64))
        # distinct pairs of every segment
        key = (seg_of[0][li] << self.key_bits) | (ids[0][li].astype(np.int64) << self.shift) | ids[1][lj]
        key, times = np.unique(key, return_counts=True)
        part = np.searchsorted(key, np.arange(n_out + 1) << self.key_bits)
        key &= (1 << self.key_bits) - 1
        for k in np.flatnonzero(~bad):
            s = out[k]
            s.n_a, s.n_b, s.n_groups, s.n_links = (int(c[k]) for c in count)
            s.text = flat[(text_stop[k - 1] if k else 0) : text_stop[k]]
            s.keys, s.times = key[part[k] : part[k + 1]], times[part[k] : part[k + 1]]
        return out

    def segments(self, text: str) -> Iterator[str]:
        """The text cut between words after every ``SEGMENT`` characters."""
        first = 0
        while self.book.v.cut and len(text) - first > SEGMENT:
            gap = _GAP.search(text, first + SEGMENT)
            if not gap:
                break
            yield text[first : gap.start()]
            first = gap.end()
        yield text[first:]

    def documents(self, texts: Iterator[str]) -> Iterator[Document]:
        """One result per text, in order."""
        held: list[tuple[int, str]] = []
        size, done, open_doc = 0, 0, Document()

        def flush(until: int):
            nonlocal done, open_doc
            found = self.merge([s for _, s in held]) if held else []
            for (k, _), s in zip(held, found):
                while done < k:
                    yield open_doc.close()
                    done, open_doc = done + 1, Document()
                open_doc.add(s)
            while done < until:
                yield open_doc.close()
                done, open_doc = done + 1, Document()
            held.clear()

        k = -1
        for k, text in enumerate(texts):
            for s in self.segments(text) if text else ():
                held.append((k, s))
                size += len(s)
                if size > BATCH:
                    yield from flush(k)
                    size = 0
        yield from flush(k + 1)


class Document:
    """Sums the segments of one text."""

    def __init__(self):
        self.n_a = self.n_b = self.n_groups = self.n_links = 0
        self.valid, self.sha, self.tail = True, hashlib.sha256(), b""
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, s: Segment) -> None:
        self.valid &= s.valid
        if not self.valid:
            return
        self.n_a, self.n_b = self.n_a + s.n_a, self.n_b + s.n_b
        self.n_groups, self.n_links = self.n_groups + s.n_groups, self.n_links + s.n_links
        self.sha.update(self.tail + s.text[:-1])
        self.tail = s.text[-1:]
        self.parts.append((s.keys, s.times))
        if len(self.parts) > 16:
            self._fold()

    def _fold(self) -> None:
        keys, back = np.unique(np.concatenate([k for k, _ in self.parts]), return_inverse=True)
        times = np.bincount(back, np.concatenate([t for _, t in self.parts]), minlength=len(keys)).astype(np.int64)
        self.parts = [(keys, times)]

    def close(self) -> Document:
        if not self.valid or not self.parts:
            self.n_a = self.n_b = self.n_groups = self.n_links = 0
            self.parts, self.digest = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], ""
            return self
        if len(self.parts) > 1:
            self._fold()
        self.digest = self.sha.hexdigest()
        return self


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def _lump(number: int, ids: list, docs: list[Document], id_type: pa.DataType) -> pa.RecordBatch:
    """One row: the documents and the dictionary of their pairs.  A document's
    pairs are ascending places in the dictionary, kept as 16-bit steps (a longer
    step goes over several, of which all but the last count 0 times), and how
    often each occurs, in one byte (more often: the place again)."""
    keys = [d.parts[0][0] for d in docs]
    sizes = np.array([len(k) for k in keys])
    names, at, held = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    times = np.concatenate([d.parts[0][1] for d in docs])
    first = np.cumsum(sizes) - sizes
    step = np.diff(at, prepend=0)
    opening = first[sizes > 0]
    step[opening] = at[opening]
    owner = np.repeat(np.arange(len(docs)), sizes)
    # long steps and large counts take more entries
    fill, more = step // 65_535, np.maximum(times - 1, 0) // 255
    entries = fill + 1 + more
    place = np.cumsum(entries) - entries
    steps, counts = np.zeros(int(entries.sum()), np.uint16), np.full(int(entries.sum()), 255, np.uint8)
    long_steps = ragged(place, fill)
    steps[long_steps], counts[long_steps] = 65_535, 0
    steps[place + fill] = step % 65_535
    counts[place + fill + more] = times - 255 * more
    sizes = np.bincount(owner, entries, minlength=len(docs)).astype(np.int64)
    one = lambda values, kind: pa.array([values], pa.list_(kind))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()), one(names, pa.int64()), one(held, pa.int32()), one(ids, id_type),
            *(one([getattr(d, n) for d in docs], pa.int64()) for n in _NUMBERS), one([d.digest for d in docs], pa.string()),
            one(sizes, pa.int32()), pa.array([steps.tobytes()], pa.binary()), pa.array([counts.tobytes()], pa.binary()),
        ],
        ["lump", "keys", "held", "ids", *_NUMBERS, "sha", "sizes", "steps", "counts"],
    )


def lumps(docs: DataFrame, v: Vocabularies, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The aligned documents, packed; see :func:`_lump`."""
    shared = docs.sparkSession.sparkContext.broadcast(v)  # two vocabularies
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = Aligner(shared.value), TaskContext.get().partitionId() << 32
        waiting: list = []  # ids of texts that are read but not merged yet
        kind = pa.int64()

        def texts() -> Iterator[str]:
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field(0).type
                for at in range(batch.num_rows):
                    waiting.append(batch.column(0)[at].as_py())
                    yield batch.column(1)[at].as_py() or ""

        ids, held, pairs = [], [], 0
        for d in aligner.documents(texts()):
            ids.append(waiting[len(ids)])
            held.append(d)
            pairs += len(d.parts[0][0])
            if pairs >= LUMP_PAIRS:
                yield _lump(number, ids, held, kind)
                del waiting[: len(ids)]
                number, ids, held, pairs = number + 1, [], [], 0
        if held:
            yield _lump(number, ids, held, kind)

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"lump long, keys array<long>, held array<int>, ids array<{kind}>, "
        + ", ".join(f"{n} array<long>" for n in _NUMBERS)
        + ", sha array<string>, sizes array<int>, steps binary, counts binary",
    )


def pair_counts(packed: DataFrame) -> DataFrame:
    """(key, n): how many documents hold each id pair."""
    pairs = packed.select(F.explode(F.arrays_zip("keys", "held")).alias("p")).select("p.keys", "p.held")
    return pairs.groupBy(F.col("keys").alias("key")).agg(F.sum("held").alias("n"))


def aligned(docs: DataFrame, v: Vocabularies, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: its id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256."""
    packed = written(lumps(docs, v, id_column, text_column), "lumps")
    counts = written(pair_counts(packed), "pair-counts")
    a_id = F.shiftright("key", v.shift)
    # at most one row per id of vocabulary A
    best = counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("most"))
    known = counts.withColumn("a", a_id).join(F.broadcast(best), "a").select(
        "key", (F.col("n") * 2 + (F.col("n") == F.col("most")).cast("long")).alias("n")
    )
    entries = packed.select("lump", F.posexplode("keys").alias("pos", "key"))
    back = (
        entries.join(known.hint("shuffle_hash"), "key").groupBy("lump")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "n"))).alias("n")).select("lump", F.col("n.n").alias("n"))
    )
    # a lump without any pair has no entry
    ready = packed.drop("keys", "held").join(back, "lump", "left").drop("lump")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = batch.slice(r, 1)
                lists = {n: row.column(n).flatten() for n in ("ids", *_NUMBERS, "sha", "sizes", "n")}
                sizes = lists["sizes"].to_numpy().astype(np.int64)
                steps = np.frombuffer(row.column("steps")[0].as_py(), np.uint16).astype(np.int64)
                times = np.frombuffer(row.column("counts")[0].as_py(), np.uint8)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                at = np.cumsum(steps)
                # every document's steps start anew
                first = np.cumsum(sizes) - sizes
                before = np.where(first > 0, at[np.maximum(first, 1) - 1], 0) if len(at) else first
                at = at - before[owner]
                known = lists["n"].to_numpy()
                n = known[at] if len(at) else np.zeros(0, np.int64)
                times = np.where(times > 0, times, 0).astype(np.int64)
                total = np.zeros((2, len(sizes)), np.int64)
                for k, x in enumerate(((n & 1) * times, (n >> 1) * times)):
                    np.add.at(total[k], owner, x)
                yield pa.RecordBatch.from_arrays(
                    [lists["ids"], *(lists[c] for c in _NUMBERS), pa.array(total[0]), pa.array(total[1]), lists["sha"]],
                    ["id", *_NUMBERS, "n_best", "count_sum", "groups_sha256"],
                )

    kind = docs.schema[id_column].dataType.simpleString()
    return ready.mapInArrow(
        finish,
        f"id {kind}, " + ", ".join(f"{n} long" for n in _NUMBERS) + ", n_best long, count_sum long, groups_sha256 string",
    ).withColumnRenamed("id", id_column)
