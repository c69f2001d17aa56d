"""Chat transcripts: roles recovered by a hidden Markov model, then rendered.

A transcript is a run of pieces of text in order (conv_id, turn); where turns
begin and who speaks is unknown.  Every line is one observation: its speaker
marker if any ("User:", "### Assistant", "[system]", ...), length class, final
question mark, and whether the line before it in its piece is blank.  Hidden
states are role x (first line of a turn, further line).  Tables are counted on
labelled conversations; Viterbi finds the best states; the canonical form
writes each turn as ``<|role|>``, its lines without the marker, ``<|end|>``.

A conversation may be of any length.  Its pieces are cut into blocks of
``BLOCK`` turns; each block gives its 6 x 6 max-plus transfer matrix, the
matrices of a conversation are chained in order (36 numbers a block), and
blocks are then decoded on their own between known end states: the same states
as Viterbi over the whole.

Defined cases: null texts are one empty line; rows without conv_id or turn
have no place in a transcript and are left out; rows of one turn are ordered by
their text; unknown roles teach nothing; without labelled rows all tables are
uniform but for the markers.  Repeated rows are turns of their own; an empty table
gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.llm.tables import written

ROLES = ("system", "user", "assistant")
STATES = 2 * len(ROLES)
BLOCK = 256
CODES = 64

#: Speaker names as transcripts write them, by role.
SPEAKERS: dict[str, str] = {
    "system": "system|sys|instruction|instructions",
    "user": "user|human|prompter|question|q|customer",
    "assistant": "assistant|ai|bot|model|answer|a|agent",
}
_NAMES = "|".join(f"(?P<{r}>{names})" for r, names in SPEAKERS.items())
#: A name with a colon, or a name in brackets or after hash signs.
MARKER = re.compile(
    rf"\s*(?:(?:\*\*)?(?:{_NAMES})(?:\*\*)?\s*:(?:\*\*)?\s*|"
    rf"(?:#{{1,6}}\s+|\[|<\|)(?:{_NAMES.replace('(?P<', '(?P<b_')})(?:\s*:|\]:?|\|>)?(?:$|(?<=[:\]>]))\s*)",
    re.IGNORECASE,
)


def marker_of(line: str) -> tuple[int, int]:
    """Number of the marked role (0: none) and where the line goes on."""
    m = MARKER.match(line)
    if not m:
        return 0, 0
    names = [k.removeprefix("b_") for k, v in m.groupdict().items() if v]
    return 1 + ROLES.index(names[0]), m.end()


def observations(text: str | None) -> list[int]:
    """One code per line."""
    out, blank = [], False
    for line in (text or "").split("\n"):
        body = line.strip()
        size = 0 if not body else 1 if len(body) < 40 else 2 if len(body) < 200 else 3
        out.append(marker_of(line)[0] * 16 + size * 4 + body.endswith("?") * 2 + blank)
        blank = not body
    return out


@dataclass
class Model:
    """Log tables; a few hundred numbers."""

    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray

    def block_matrix(self, codes: list[int]) -> np.ndarray:
        """Best log weight from a state before the block to one at its end."""
        m = self.step + self.emit[:, codes[0]]
        for c in codes[1:]:
            m = (m[:, :, None] + self.step[None]).max(1) + self.emit[:, c]
        return m

    def first_vector(self, codes: list[int]) -> np.ndarray:
        """The same from the start of a conversation."""
        v = self.start + self.emit[:, codes[0]]
        for c in codes[1:]:
            v = (v[:, None] + self.step).max(0) + self.emit[:, c]
        return v

    def decode(self, codes: list[int], before: int, end: int) -> list[int]:
        """States of the lines between the state before (-1: start) and the last one."""
        v = (self.start if before < 0 else self.step[before]) + self.emit[:, codes[0]]
        back = []
        for c in codes[1:]:
            all_ = v[:, None] + self.step
            back.append(all_.argmax(0))
            v = all_.max(0) + self.emit[:, c]
        states = [end]
        for b in reversed(back):
            states.append(int(b[states[-1]]))
        return states[::-1]


def block_of(turn: str = "turn") -> Column:
    return F.floor(F.col(turn) / BLOCK).cast("long")


def pieces(transcripts: DataFrame) -> DataFrame:
    """(conv_id, turn, role, mark, codes) of every piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [observations(t.as_py()) for t in batch.column(4)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(codes, pa.list_(pa.int32()))], ["conv_id", "turn", "role", "mark", "codes"]
            )

    rows = _placed(transcripts)
    return rows.mapInArrow(run, "conv_id long, turn long, role string, mark long, codes array<int>")


def _placed(transcripts: DataFrame) -> DataFrame:
    role = F.col("role") if "role" in transcripts.columns else F.lit(None)
    return transcripts.filter(F.col("conv_id").isNotNull() & F.col("turn").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        role.cast("string").alias("role"), F.xxhash64("text").alias("mark"), "text",
    )


def fit(labelled: DataFrame) -> Model:
    """Tables from ``pieces`` whose role is known.  Only counts by state and
    code come to the driver."""
    number = F.array_position(F.array(*map(F.lit, ROLES)), F.col("role")).cast("int") - 1
    known = labelled.filter(F.col("role").isin(*ROLES)).withColumn("first", number * 2)
    lines = known.select("first", F.posexplode("codes").alias("at", "code"))
    emitted = lines.groupBy((F.col("first") + (F.col("at") > 0).cast("int")).alias("state"), "code").count().collect()
    inside = known.groupBy("first").agg(
        F.sum((F.size("codes") > 1).cast("long")).alias("one"),
        F.sum(F.greatest(F.size("codes") - 2, F.lit(0))).alias("more"),
    ).collect()
    last = known.select("conv_id", (F.col("turn") + 1).alias("turn"),
                        (F.col("first") + (F.size("codes") > 1).cast("int")).alias("state"))
    follow = known.select("conv_id", "turn", "first").join(last, ["conv_id", "turn"]).groupBy("state", "first").count().collect()
    begin = known.filter("turn = 0").groupBy("first").count().collect()

    start, step = np.full(STATES, 0.0), np.zeros((STATES, STATES))
    emit = np.full((STATES, CODES), 0.05)
    for r, role in enumerate(ROLES):  # a marker speaks for its role, unless the counts say otherwise
        emit[2 * r, 16 * (r + 1) : 16 * (r + 2)] += 0.5
    for r in begin:
        start[r["first"]] += r["count"]
    for r in emitted:
        emit[r["state"], r["code"]] += r["count"]
    for r in inside:
        step[r["first"], r["first"] + 1] += r["one"] or 0
        step[r["first"] + 1, r["first"] + 1] += r["more"] or 0
    for r in follow:
        step[r["state"], r["first"]] += r["count"]
    for s in range(STATES):  # what can follow at all: any first line, or a further line of the same role
        step[s, 0::2] += 0.5
        step[s, s | 1] += 0.5
    start[0::2] += 0.5
    with np.errstate(divide="ignore"):
        return Model(*(np.log(x / x.sum(-1, keepdims=True)) for x in (start, step, emit)))


def _by_block(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows, sorted by their first two columns, by blocks."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(width))):
            if row[:2] != key:
                if rows:
                    yield key, rows
                key, rows = row[:2], []
            rows.append(row)
    if rows:
        yield key, rows


def _in_blocks(df: DataFrame, *last: str) -> DataFrame:
    by = ("conv_id", "block", *last)
    return df.repartition("conv_id", "block").sortWithinPartitions(*by)


def block_ends(codes: DataFrame, model: Model) -> DataFrame:
    """(conv_id, block, before, end): the states before and at the end of each
    block on the best path of its conversation; before is -1 at the start."""

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for (conv, block), rows in _by_block(batches, 5):
            line = [c for r in rows for c in r[4]]
            out.append((conv, block, model.first_vector(line).tolist(), model.block_matrix(line).ravel().tolist()))
        conv, block, v, m = zip(*out) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(conv, pa.int64()), pa.array(block, pa.int64()),
             pa.array(v, pa.list_(pa.float64())), pa.array(m, pa.list_(pa.float64()))],
            ["conv_id", "block", "first", "matrix"],
        )

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ends(conv, blocks, backs, v):
            state, path = int(v.argmax()), []
            for b, back in zip(reversed(blocks), reversed(backs)):
                before = -1 if back is None else int(back[state])
                path.append((conv, b, before, state))
                state = before
            return path

        def rows(out):
            c, b, s, e = zip(*out) if out else ((), (), (), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()), pa.array(b, pa.int64()), pa.array(s, pa.int32()), pa.array(e, pa.int32())],
                ["conv_id", "block", "before", "end"],
            )

        conv, blocks, backs, v, out = None, [], [], None, []
        for batch in batches:
            for c, b, first, matrix in zip(*(batch.column(i) for i in range(4))):
                c, b = c.as_py(), b.as_py()
                if c != conv:
                    if blocks:
                        out += ends(conv, blocks, backs, v)
                    if len(out) > 50_000:
                        yield rows(out)
                        out = []
                    conv, blocks, backs, v = c, [], [], None
                if v is None:
                    v, back = np.array(first.as_py()), None
                else:
                    all_ = v[:, None] + np.array(matrix.as_py()).reshape(STATES, STATES)
                    back, v = all_.argmax(0).astype(np.int8), all_.max(0)
                blocks.append(b)
                backs.append(back)
        if blocks:
            out += ends(conv, blocks, backs, v)
        yield rows(out)

    in_blocks = _in_blocks(codes.select("conv_id", block_of().alias("block"), "turn", "mark", "codes"), "turn", "mark")
    steps = in_blocks.mapInArrow(matrices, "conv_id long, block long, first array<double>, matrix array<double>")
    steps = written(steps, "block-matrices").repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return steps.mapInArrow(chain, "conv_id long, block long, before int, end int")


def render(lines: list[str], states: list[int], opened: bool) -> str:
    """Canonical text of one piece's lines; ``opened``: a turn is open before."""
    out = []
    for line, s in zip(lines, states):
        if s % 2 == 0:
            out += ["<|end|>"] * opened + [f"<|{ROLES[s // 2]}|>"]
            opened = True
            line = line[marker_of(line)[1]:]
        out.append(line)
    return "\n".join(out)


def recover(transcripts: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """(conv_id, turn, n_lines, n_turns, roles, role_of_first, rendered) of every
    piece: the turns that begin in it, the role of its first line, and its part
    of the canonical transcript (pieces joined by newlines, ``<|end|>`` last).
    ``labelled``: pieces to learn from, in the same form with ``role``."""
    codes = written(pieces(transcripts), "pieces")
    model = fit(codes if labelled is None else pieces(labelled))
    ends = written(block_ends(codes, model), "block-ends")
    rows = _placed(transcripts).withColumn("block", block_of())
    rows = rows.select("conv_id", "block", "turn", "mark", "text").join(ends, ["conv_id", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "turn", "n_lines", "n_turns", "roles", "role_of_first", "rendered"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        out = []

        def packed():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 7, kinds)], names)

        for (conv, _), block in _by_block(batches, 7):
            before, end = block[0][5], block[0][6]
            line = [observations(r[4]) for r in block]
            states, at = model.decode([c for x in line for c in x], before, end), 0
            for (_, _, turn, _, text, _, _), x in zip(block, line):
                mine = states[at : at + len(x)]
                begun = [ROLES[s // 2] for s in mine if s % 2 == 0]
                out.append((conv, turn, len(x), len(begun), ",".join(begun), ROLES[mine[0] // 2],
                            render((text or "").split("\n"), mine, before >= 0 or at > 0)))
                at += len(x)
            if len(out) > 2_000:
                yield packed()
                out.clear()
        yield packed()

    return rows.select("conv_id", "block", "turn", "mark", "text", "before", "end").sortWithinPartitions(
        "conv_id", "block", "turn", "mark"
    ).mapInArrow(
        run, "conv_id long, turn long, n_lines long, n_turns long, roles string, role_of_first string, rendered string"
    )


#: How transcripts in the wild mark their speakers; the last style not at all,
#: with a blank line between turns.
STYLES: tuple[dict[str, str], ...] = (
    {"system": "System: ", "user": "User: ", "assistant": "Assistant: "},
    {"system": "[system]\n", "user": "[human]\n", "assistant": "[AI]\n"},
    {"system": "### Instruction:\n", "user": "### Question:\n", "assistant": "### Answer:\n"},
    {"system": "\n", "user": "\n", "assistant": "\n"},
)


def as_transcript(conversations: DataFrame) -> DataFrame:
    """The conversations as raw logs: each in one style, by its id."""
    style = F.crc32(F.col("conv_id").cast("string")) % len(STYLES)
    marks = F.element_at(F.array(*(
        F.create_map(*(F.lit(x) for kv in s.items() for x in kv)) for s in STYLES)), style.cast("int") + 1)
    mark = F.coalesce(F.element_at(marks, F.col("role")), F.lit(""))
    return conversations.select(
        "conv_id", "turn", "role", F.concat(mark, F.coalesce("text", F.lit(""))).alias("text")
    )


def formatted(conversations: DataFrame) -> DataFrame:
    """Logs made of the conversations, their roles recovered by a model that
    learns from the conversations which are not held out."""
    logs = as_transcript(conversations)
    held = F.crc32(F.col("conv_id").cast("string")) % 5 == 0
    return recover(logs, logs.filter(~held)).withColumn("held_out", held)
