"""Packing by first-fit decreasing over a tournament tree, in randomised groups of documents.

A document's ids fill whole sequences first; what is left over, less than one sequence,
is dealt at random into groups of bounded size.  A group is packed by itself: its pieces
come longest first, and each goes into the first sequence with room.  The tournament
tree holds the room of every sequence at its leaves and the larger of two rooms above
them, so the first fit is found on one way down.

Small gaps remain.  The emptiest sequences are taken apart again and cut to fill them;
the one sequence of a group that then is not full is cut into parts whose lengths are
powers of two, which need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from newstape.llm.common import id_back, identified, longs, rows, stage
from newstape.llm.tokens import encoder

#: id that ends every document
END = 2
#: documents a group has on average
GROUP = 4096
#: texts encoded at a time, and words a worker keeps the ids of (about 200 bytes each)
TEXTS, WORDS = 500, 400_000


class Tournament:
    """The room of a row of sequences; finds the first with enough."""

    def __init__(self, sequences: int, capacity: int):
        self.leaves = 1 << max(0, sequences - 1).bit_length()
        self.best = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """Put ``size`` into the first sequence with room for it; its number."""
        best, leaves = self.best, self.leaves
        at = 1
        while at < leaves:
            at *= 2
            if best[at] < size:
                at += 1
        found = at - leaves
        best[at] -= size
        while at > 1:
            at >>= 1
            larger = max(best[2 * at], best[2 * at + 1])
            if best[at] == larger:
                break
            best[at] = larger
        return found


def first_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Sequences as lists of places in ``lengths`` (each at most ``capacity``), by first-fit decreasing."""
    # of any two neighbours one is over half full, so twice the volume is enough
    most = min(len(lengths), 2 * int(lengths.sum()) // capacity + 2)
    tree = Tournament(most, capacity)
    out: list[list[int]] = [[] for _ in range(most)]
    for k in np.argsort(-lengths, kind="stable").tolist():
        out[tree.place(int(lengths[k]))].append(k)
    return [s for s in out if s]


def padding(length: int, capacity: int) -> int:
    return 0 if length & (length - 1) == 0 else capacity - length


Part = tuple[int, int, int]  # place of the piece, begin in it, length


def completed(sequences: list[list[int]], lengths: np.ndarray, capacity: int, least: int = 1) -> list[list[Part]]:
    """The sequences with their gaps of ``least`` or more filled from the emptiest ones, as parts of pieces."""
    whole = [[(k, 0, int(lengths[k])) for k in s] for s in sequences]
    whole.sort(key=lambda s: -sum(n for _, _, n in s))
    room = [capacity - sum(n for _, _, n in s) for s in whole]
    # a gap is filled from the emptiest sequence, and that one is then a little emptier
    low, high = 0, len(whole) - 1
    while low < high:
        if room[low] < least:
            low += 1
            continue
        k, begin, n = whole[high].pop()
        moved = min(n, room[low])
        whole[low].append((k, begin + n - moved, moved))
        room[low] -= moved
        room[high] += moved
        if moved < n:
            whole[high].append((k, begin, n - moved))
        if not whole[high]:
            high -= 1
    out = [s for s in whole[: high + 1] if s]
    if out and padding(capacity - room[high], capacity) >= least:
        out[-1:] = powers(out[-1], capacity - room[high])
    return out


def powers(parts: list[Part], length: int) -> list[list[Part]]:
    """Parts of ``length`` in all, cut into sequences whose lengths are powers of two, the longest first."""
    out = []
    parts = parts[::-1]
    while length:
        free = 1 << (length.bit_length() - 1)
        length -= free
        held = []
        while free:
            k, begin, n = parts.pop()
            took = min(n, free)
            held.append((k, begin, took))
            free -= took
            if took < n:
                parts.append((k, begin + took, n - took))
        out.append(held)
    return out


PIECES = "_id long, start long, length long, doc_tokens long, ids binary, sequence_id long, salt long"
PACKED = "_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _narrow(ids: np.ndarray) -> tuple[bytes, int]:
    """The ids with the end id as bytes, and bytes an id: two where that is enough, else four."""
    size = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    return ids.astype(f"<u{size}").tobytes() + END.to_bytes(size, "little"), size


def _wide(raw: bytes, length: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // length}").astype("<u4", copy=False)


def pieces(
    docs: DataFrame, capacity: int, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Token ids of every document and the end id: full sequences with a number, what is left over with a salt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, WORDS).encode
        part = TaskContext.get().partitionId()
        random = np.random.default_rng(part)
        full = 0  # sequences of one document; their numbers are negative, those of groups are not
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            for low in range(0, len(texts), TEXTS):
                owner, start, length, total, held, sequence = [], [], [], [], [], []
                for i, ids in enumerate(encode(texts[low : low + TEXTS]), low):
                    raw, size = _narrow(ids)
                    n = len(ids) + 1
                    for at in range(0, n, capacity):
                        owner.append(i)
                        start.append(at)
                        length.append(min(capacity, n - at))
                        total.append(n)
                        held.append(raw[at * size : (at + capacity) * size])
                        whole = at + capacity <= n
                        full += whole
                        sequence.append(-(part << 36) - full if whole else None)
                yield rows(
                    _id=batch.column("_id").take(pa.array(owner, pa.int32())), start=pa.array(start, pa.int64()),
                    length=pa.array(length, pa.int64()), doc_tokens=pa.array(total, pa.int64()), ids=pa.array(held, pa.binary()),
                    sequence_id=pa.array(sequence, pa.int64()), salt=random.integers(0, 2**40, len(owner)),
                )

    return identified(docs, id_col, text_col).mapInArrow(run, PIECES)


def _rows(some: pa.RecordBatch | pa.Table, parts: list[tuple[int, int, int, int, int]]) -> pa.RecordBatch:
    """Rows of (piece, begin in it, length, sequence, offset)."""
    pick, begin, length, sequence, offset = (np.array(x, np.int64) for x in zip(*parts))
    raw = some.column("ids").to_pylist()
    column = {c: longs(some.column(c))[pick] for c in ("_id", "start", "length", "doc_tokens")}
    parts = zip(pick.tolist(), column["length"].tolist(), begin.tolist(), length.tolist())
    ids = [_wide(raw[k], whole)[a : a + n].tobytes() for k, whole, a, n in parts]
    return rows(
        _id=column["_id"], start=column["start"] + begin, length=length, ids=pa.array(ids, pa.binary()),
        doc_tokens=column["doc_tokens"], sequence_id=sequence, offset=offset,
    )


def packed(
    docs: DataFrame, capacity: int = 4096, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text",
    group: int = GROUP, least: int = 1,
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids``, ``doc_tokens``, ``sequence_id``, ``offset``.

    ``ids`` are the piece's token ids as little-endian 32-bit numbers; ``start`` says how
    many ids of its document come before it.  A sequence is filled without gaps from offset
    0.  Gaps of ``least`` ids or more are filled with parts cut from other documents, so
    no sequence is padded by more than ``least - 1``; with 1 there is no padding.  NULL and
    empty texts are the end id alone.  Repeated rows are packed as often as they occur.
    An empty table has no rows.
    """
    # written, so that what goes to which group stays as it is
    cut = stage(pieces(docs, capacity, tokenizer, id_col, text_col), "pieces")
    groups = max(1, -(-cut.where("sequence_id IS NULL").count() // group))

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sequence = longs(batch.column("sequence_id")).tolist()
                yield _rows(batch, [(k, 0, capacity, s, 0) for k, s in enumerate(sequence)])

    def fill(some: pa.Table) -> pa.Table:
        some = some.combine_chunks()
        sizes = longs(some.column("length"))
        base = some.column("_group")[0].as_py() << 32
        parts = []
        for number, sequence in enumerate(completed(first_fit(sizes, capacity), sizes, capacity, least)):
            at = 0
            for k, begin, n in sequence:
                parts.append((k, begin, n, base + number, at))
                at += n
        return pa.Table.from_batches([_rows(some, parts)])

    full = cut.where("sequence_id IS NOT NULL").mapInArrow(alone, PACKED)
    rest = cut.where("sequence_id IS NULL").withColumn("_group", F.pmod("salt", F.lit(groups)))
    out = full.unionByName(rest.groupBy("_group").applyInArrow(fill, PACKED))
    return out.select(id_back().alias("doc_id"), *[c.split()[0] for c in PACKED.split(", ")[1:]])
