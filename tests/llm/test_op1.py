from __future__ import annotations

import zlib

import numpy as np
import pytest

from martlake.llm import chat_hmm
from martlake.llm.chat_hmm import ROLES, as_transcript, fit, formatted, marker_of, observations, pieces, recover
from martlake.llm.queries import QUERIES
from tests.conftest import SF01


def whole_viterbi(model, codes):
    """Plain Viterbi over all lines of a conversation."""
    v, back = model.start + model.emit[:, codes[0]], []
    for c in codes[1:]:
        all_ = v[:, None] + model.step
        back.append(all_.argmax(0))
        v = all_.max(0) + model.emit[:, c]
    states = [int(v.argmax())]
    for b in reversed(back):
        states.append(int(b[states[-1]]))
    return states[::-1], v.max()


def path_weight(model, codes, states):
    w = model.start[states[0]] + model.emit[states[0], codes[0]]
    for a, b, c in zip(states, states[1:], codes[1:]):
        w += model.step[a, b] + model.emit[b, c]
    return w


def test_roles_of_the_whole_table(spark):
    truth = {(r.conv_id, r.turn): r.role for r in spark.read.parquet(f"{SF01}/conversations.parquet").collect()}
    got = QUERIES["op1_chat_format"](spark, SF01).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r.held_out]
    right = [r.roles == truth[r.conv_id, r.turn] for r in held]
    assert len(right) > 50 and sum(right) / len(right) > 0.9
    marked = [r for r in got if zlib.crc32(str(r.conv_id).encode()) % 4 < 3]
    assert sum(r.roles == truth[r.conv_id, r.turn] for r in marked) / len(marked) > 0.99


@pytest.mark.parametrize("block", [2, 256])
def test_blocks_equal_one_long_path(spark, monkeypatch, block):
    conv = spark.read.parquet(f"{SF01}/conversations.parquet").filter("conv_id < 40")
    long = conv.selectExpr("cast(7777 as long) conv_id", "cast(conv_id * 10 + turn as int) turn", "role", "text")
    logs = as_transcript(conv.union(long))
    model = fit(pieces(logs))
    monkeypatch.setattr(chat_hmm, "BLOCK", block)
    rows = {}
    for r in recover(logs, logs).collect():
        rows.setdefault(r.conv_id, []).append(r)
    texts = {}
    for r in logs.collect():
        texts.setdefault(r.conv_id, []).append((r.turn, r.text))
    assert rows.keys() == texts.keys()
    for c, turns in texts.items():
        lines = [x for _, t in sorted(turns) for x in t.split("\n")]
        codes = [o for _, t in sorted(turns) for o in observations(t)]
        states, weight = whole_viterbi(model, codes)
        got = sorted(rows[c], key=lambda r: r.turn)
        assert "\n".join(r.rendered for r in got) == chat_hmm.render(lines, states, False)
        assert np.isclose(path_weight(model, codes, states), weight)


def test_markers():
    cases = {
        "User: hi": (2, 6), "  assistant: x": (3, 13), "### Question:": (2, 13), "[system]": (1, 8), "[AI] yes": (3, 5),
        "**Human:** a": (2, 11), "<|assistant|>": (3, 13), "User hi": (0, 0), "A la fin": (0, 0), "": (0, 0), "# Question of": (0, 0),
        "Systematic: x": (0, 0), "Q: why": (2, 3),
    }
    assert {k: marker_of(k) for k in cases} == cases


def test_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, None, ""), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"), (None, 0, "user", "x"),
            (2, None, "user", "x"), (3, 5, "robot", "Bot: y\n\n\nUser: z"), (4, 0, "user", "\x00 ß" * 2000)]
    conv = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").selectExpr("*", "1 block", "2 codes")
    got = formatted(conv).collect()
    assert sorted((r.conv_id, r.turn) for r in got) == [(1, 0), (1, 1), (1, 1), (1, 1), (3, 5), (4, 0)]
    three = [r for r in got if r.conv_id == 3][0]
    assert three.roles.endswith("user") and three.n_lines == 4
    assert formatted(conv.limit(0)).count() == 0
    assert set(ROLES) >= {r.role_of_first for r in got}
