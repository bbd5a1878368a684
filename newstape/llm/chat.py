"""Chat formatting by columnar byte assembly.

A batch of turns becomes one Arrow buffer: the lengths of all segments (marks, roles,
texts with escapes) are added up, every segment gets its offset, and numpy scatters
marks and contents into a buffer allocated once.  No string is built per turn.

Template of a turn: ``### role`` line, text, ``</turn>`` and a line break.  Inside texts
a backslash goes before each backslash, before ``###`` and before ``</turn>``; inside
roles before each backslash and line break.  Taking one backslash away from each pair
restores the original, so the format is reversible whatever the texts say.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from newstape.llm.common import flat, id_of, longs, rows, text_of

#: fixed values: the template
HEAD, BREAK, TAIL = b"### ", b"\n", b"</turn>\n"
CLOSE = b"</turn>"
LEARNT = "assistant"
SLASH, HASH, LESS, NEWLINE = 0x5C, 0x23, 0x3C, 0x0A
#: source bytes scattered at a time
SPAN = 1 << 22

PIECES = "_id long, _range int, piece int, formatted string, n_turns int, loss_start array<long>, loss_end array<long>"
TURN = re.compile(r"### ((?:[^\\\n]++|\\.)*+)\n((?:[^\\#<]++|\\.|#(?!##)|<(?!/turn>))*+)</turn>\n", re.S)
ESCAPED = re.compile(r"\\(.)", re.S)


def _text_escapes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places in the texts before which a backslash goes."""
    found = np.flatnonzero((data == SLASH) | (data == HASH) | (data == LESS))
    end = offsets[np.searchsorted(offsets, found, side="right")]
    kind = data[found]
    good = kind == SLASH
    for start, word in ((HASH, b"###"), (LESS, CLOSE)):
        whole = (kind == start) & (found + len(word) <= end)
        for k, byte in enumerate(word):
            at = np.minimum(found + k, len(data) - 1)
            whole &= data[at] == byte
        good |= whole
    return found[good]


def _scatter(out: np.ndarray, data: np.ndarray, offsets: np.ndarray, place: np.ndarray, escapes: np.ndarray) -> None:
    """Copy the texts to their places in ``out``, opening a gap with a backslash before each escaped byte."""
    before = np.searchsorted(escapes, offsets[:-1])  # escapes in earlier texts
    for lo in range(0, len(data), SPAN):
        hi = min(lo + SPAN, len(data))
        a, b = np.searchsorted(offsets, lo, "right") - 1, np.searchsorted(offsets, hi, "left")
        size = np.minimum(offsets[a + 1 : b + 1], hi) - np.maximum(offsets[a:b], lo)
        shift = np.repeat(place[a:b] - offsets[a:b] - before[a:b], size)
        target = np.arange(lo, hi) + shift
        some = escapes[np.searchsorted(escapes, lo) : np.searchsorted(escapes, hi)]
        extra = np.zeros(hi - lo, np.int64)
        extra[some - lo] = 1
        target += np.cumsum(extra) + np.searchsorted(escapes, lo)
        out[target] = data[lo:hi]
        out[target[some - lo] - 1] = SLASH


def assemble(roles: pa.Array, values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The formatted bytes of all turns, where each turn begins (and the last ends), and each text's begin and end."""
    role, role_at = flat(roles)
    text, text_at = flat(values)
    role_escapes = np.flatnonzero((role == SLASH) | (role == NEWLINE))
    text_escapes = _text_escapes(text, text_at)
    role_size = np.diff(role_at) + np.diff(np.searchsorted(role_escapes, role_at))
    text_size = np.diff(text_at) + np.diff(np.searchsorted(text_escapes, text_at))
    role_from = len(HEAD)
    turn_at = np.concatenate([[0], np.cumsum(role_from + role_size + len(BREAK) + text_size + len(TAIL))])
    begin = turn_at[:-1]
    text_from = begin + role_from + role_size + len(BREAK)
    text_to = text_from + text_size
    out = np.empty(int(turn_at[-1]), np.uint8)
    for word, place in ((HEAD, begin), (BREAK, text_from - len(BREAK)), (TAIL, text_to)):
        for k, byte in enumerate(word):
            out[place + k] = byte
    _scatter(out, role, role_at, begin + role_from, role_escapes)
    _scatter(out, text, text_at, text_from, text_escapes)
    return out, turn_at, text_from, text_to


def format_conversations(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Formatted conversations in pieces, in the order of ``_id``, ``_range``, ``piece``; see ``PIECES``.

    Turns are range-partitioned by conversation, turn, role and text, so a conversation
    that holds a third of all turns spreads over tasks; its pieces joined in order are
    its text.  ``loss_start`` and ``loss_end`` are code points within the piece: the texts
    of assistant turns, escapes included.  A NULL text or role is empty, a NULL turn
    comes first, rows of one turn go by role and text, repeated rows repeat, and rows
    without a conversation id are one conversation.
    """
    plain = turns.select(
        id_of(id_col).alias("_id"), F.col(turn_col).cast("long").alias("_turn"), text_of(role_col).alias("_role"),
        text_of(text_col).alias("_text"),
    )
    order = ["_id", "_turn", "_role", "_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = TaskContext.get().partitionId()
        last, piece = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = longs(batch.column("_id"))
            out, turn_at, text_from, text_to = assemble(batch.column("_role"), batch.column("_text"))
            new = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
            number = np.zeros(len(new), np.int32)
            if conv[0] == last:
                number[0] = piece + 1
            last, piece = conv[-1], number[-1]
            ends = np.concatenate([new, [len(conv)]])
            places = turn_at[ends]
            letters = np.concatenate([[0], np.cumsum((out & 0xC0) != 0x80, dtype=np.int64)])
            learnt = np.array([r == LEARNT for r in batch.column("_role").to_pylist()])
            at = np.flatnonzero(learnt)
            base = letters[places[np.searchsorted(new, at, "right") - 1]]
            spans = pa.array(np.searchsorted(at, ends), pa.int32())
            yield rows(
                _id=conv[new], _range=np.full(len(new), where, np.int32), piece=number,
                formatted=pa.StringArray.from_buffers(
                    len(new), pa.py_buffer(places.astype(np.int32)), pa.py_buffer(out)
                ),
                n_turns=np.diff(ends).astype(np.int32),
                loss_start=pa.ListArray.from_arrays(spans, pa.array(letters[text_from[at]] - base)),
                loss_end=pa.ListArray.from_arrays(spans, pa.array(letters[text_to[at]] - base)),
            )

    return plain.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, PIECES)


def unescaped(text: str) -> str:
    return ESCAPED.sub(r"\1", text) if "\\" in text else text


def parsed(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted piece."""
    out, at = [], 0
    while at < len(formatted):
        turn = TURN.match(formatted, at)
        if turn is None:
            raise ValueError(f"no turn at {at}")
        out.append((unescaped(turn[1]), unescaped(turn[2])))
        at = turn.end()
    return out
