"""Best-fit packing of token pieces into fixed-length sequences by bin completion.

Pieces are dealt at random into blocks of bounded size; a block is packed by itself,
so a task holds some ten thousand lengths however large the corpus is.  A block works on
its histogram of lengths: the largest piece left opens a sequence, and the sequence is
completed by an undominated filling, least waste first.  Best-fit decreasing gives the
first incumbent; a branch is cut as soon as its waste exceeds what a better solution
than the incumbent may have, and the search ends at the lower bound.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from newstape.llm.common import id_back, identified, rows, stage
from newstape.llm.tokens import encoder

#: id that ends every document
END = 0
#: pieces a block has on average, and words a worker keeps the ids of (about 200 bytes each)
BLOCK, WORDS = 20_000, 400_000
#: fillings tried per sequence, pieces tried as the first of its last three, and search nodes beyond the first descent;
#: None: no bound
FILLINGS, FIRSTS, NODES = 4, 24, 4000


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs: the best of the volume bounds over all thresholds."""
    counts = np.bincount(lengths, minlength=capacity + 1)
    volume = counts * np.arange(capacity + 1)
    number, amount = np.cumsum(counts), np.cumsum(volume)
    best = -(-int(amount[-1]) // capacity)
    for k in range(1, capacity // 2 + 1):
        big = number[-1] - number[capacity - k]  # over capacity - k: nothing of size >= k joins them
        half = number[capacity - k] - number[capacity // 2]
        free = half * capacity - (amount[capacity - k] - amount[capacity // 2])
        small = amount[capacity // 2] - amount[k - 1]
        best = max(best, int(big + half + max(0, -(-int(small - free) // capacity))))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing over lengths; sequences are lists of lengths."""
    rooms: dict[int, list[int]] = defaultdict(list)
    free = np.zeros(capacity + 1, bool)
    out: list[list[int]] = []
    for n in np.sort(lengths)[::-1].tolist():
        fits = np.flatnonzero(free[n:])
        if len(fits):
            room = n + int(fits[0])
            at = rooms[room].pop()
            free[room] = bool(rooms[room])
        else:
            room, at = capacity, len(out)
            out.append([])
        out[at].append(n)
        if room > n:
            rooms[room - n].append(at)
            free[room - n] = True
    return out


class _Left:
    """Lengths not packed yet, as a histogram."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.counts = np.bincount(lengths, minlength=capacity + 1)
        self.has = self.counts > 0
        self.places = np.arange(capacity + 1)

    def take(self, filling: tuple[int, ...]) -> None:
        for n in filling:
            self.counts[n] -= 1
            self.has[n] = self.counts[n] > 0

    def give(self, filling: tuple[int, ...]) -> None:
        for n in filling:
            self.counts[n] += 1
            self.has[n] = True

    def largest(self, upto: int) -> int:
        found = np.flatnonzero(self.has[: upto + 1])
        return int(found[-1]) if len(found) else 0

    def two(self, room: int) -> tuple[int, ...]:
        """The fullest filling of at most two pieces; of equals the one with the larger piece."""
        sizes = np.flatnonzero(self.has[: room + 1])
        if not len(sizes):
            return ()
        below = np.maximum.accumulate(np.where(self.has[: room + 1], self.places[: room + 1], 0))
        if sizes[-1] == room:
            return (room,)
        second = below[np.minimum(room - sizes, sizes)]
        twin = (second == sizes) & (self.counts[sizes] < 2)
        second = np.where(twin, below[sizes - 1], second)
        sums = sizes + second
        best = len(sums) - 1 - int(np.argmax(sums[::-1]))
        return (int(sizes[best]),) + ((int(second[best]),) if second[best] else ())

    def every(self, room: int, most: int | None = None) -> list[tuple[int, ...]]:
        """All fillings of a room that leave no space for another piece, by sum of lengths."""
        sizes = np.flatnonzero(self.has[: min(room, most or room) + 1])[::-1].tolist()
        out = []
        for n in sizes:
            self.take((n,))
            out += [(n, *rest) for rest in self.every(room - n, n) or [()]]
            self.give((n,))
        # a filling is whole if nothing larger that is left would fit either
        return [f for f in out if most is not None or not self._fits(f, room)]

    def _fits(self, filling: tuple[int, ...], room: int) -> bool:
        self.take(filling)
        free = self.largest(room - sum(filling))
        self.give(filling)
        return bool(free)

    def fillings(self, room: int, many: int | None, firsts: int | None = FIRSTS) -> list[tuple[int, ...]]:
        """Undominated fillings of a room, least waste first.

        Without bounds these are all whole fillings.

        A filling of fewer pieces with the same sum dominates: it leaves the smaller
        pieces, which fit anywhere the larger one does.  While much room is left the
        largest fitting pieces go in; the last pieces are chosen together.
        """
        if many is None:
            every = set(self.every(room)) or {()}
            return sorted(every, key=lambda f: (room - sum(f), len(f), [-x for x in f]))
        head: list[int] = []
        while True:
            top = self.largest(room)
            if not top or room <= 3 * top:
                break
            self.take((top,))
            head.append(top)
            room -= top
        found: dict[tuple[int, ...], int] = {}
        plain = self.two(room)
        found[plain] = room - sum(plain)
        if found[plain]:
            sizes = np.flatnonzero(self.has[: room + 1])[::-1][:firsts].tolist()
            for first in sizes:
                self.take((first,))
                rest = self.two(room - first)
                self.give((first,))
                filling = tuple(sorted((first, *rest), reverse=True))
                found.setdefault(filling, room - sum(filling))
                if found[filling] == 0 and len(found) >= many:
                    break
        self.give(tuple(head))
        kept: dict[int, tuple[int, ...]] = {}
        for filling in sorted(found, key=lambda f: (found[f], len(f), [-x for x in f])):
            kept.setdefault(found[filling], filling)  # one per sum: the fewest, largest pieces dominate
        return [tuple(head) + f for f in list(kept.values())[:many]]


def pack(
    lengths: np.ndarray, capacity: int = 2048, nodes: int | None = NODES, fillings: int | None = FILLINGS, firsts: int | None = FIRSTS
) -> list[list[int]]:
    """Few sequences of at most ``capacity`` that hold every length (1 to capacity), as lists of lengths.

    The bounds keep the search to moments; with ``nodes`` and ``fillings`` None it ends at
    the fewest sequences there can be, after a time that grows exponentially.
    """
    lengths = np.asarray(lengths, np.int64)
    if not len(lengths):
        return []
    best = best_fit(lengths, capacity)
    bound = lower_bound(lengths, capacity)
    if len(best) == bound:
        return best
    total = int(lengths.sum())
    left = _Left(lengths, capacity)
    remaining = len(lengths)
    chosen: list[tuple[int, ...]] = []
    choices: list[list[tuple[int, ...]]] = []
    waste, spent = 0, 0
    allowed = (len(best) - 1) * capacity - total
    while True:
        dead = waste > allowed
        if not remaining and not dead:
            best = [list(c) for c in chosen]
            if len(best) == bound:
                return best
            allowed = (len(best) - 1) * capacity - total
            dead = True
        if not dead and len(choices) == len(chosen):
            top = left.largest(capacity)
            left.take((top,))
            options = [(top, *f) for f in left.fillings(capacity - top, fillings, firsts)] if top < capacity else [(top,)]
            left.give((top,))
            choices.append(options[::-1])
        if dead or not choices[-1]:
            if not dead:
                choices.pop()
            if not chosen or (nodes is not None and spent >= nodes):
                return best
            spent += 1
            undone = chosen.pop()
            del choices[len(chosen) + 1 :]
            left.give(undone)
            remaining += len(undone)
            waste -= capacity - sum(undone)
            continue
        filling = choices[-1].pop()
        left.take(filling)
        remaining -= len(filling)
        waste += capacity - sum(filling)
        chosen.append(filling)


PIECES = "_id long, _h long, piece int, start long, length long, ids_crc32 long, salt long"


def pieces(
    docs: DataFrame, capacity: int = 2048, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Token pieces of every document: its ids, then the end id, cut only where longer than ``capacity``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, WORDS).encode
        random = np.random.default_rng(TaskContext.get().partitionId())
        for batch in batches:
            owner, piece, start, length, crc = [], [], [], [], []
            texts = batch.column("_text").to_pylist()
            for lo in range(0, len(texts), 500):
                for i, ids in enumerate(encode(texts[lo : lo + 500]), lo):
                    raw = ids.tobytes() + b"\0\0\0\0"
                    for k, at in enumerate(range(0, len(ids) + 1, capacity)):
                        n = min(capacity, len(ids) + 1 - at)
                        owner.append(i)
                        piece.append(k)
                        start.append(at)
                        length.append(n)
                        crc.append(zlib.crc32(raw[4 * at : 4 * (at + n)]))
            pick = pa.array(owner, pa.int32())
            if owner:
                yield rows(
                    _id=batch.column("_id").take(pick), _h=batch.column("_h").take(pick),
                    piece=pa.array(piece, pa.int32()), start=pa.array(start, pa.int64()),
                    length=pa.array(length, pa.int64()), ids_crc32=pa.array(crc, pa.int64()),
                    salt=random.integers(0, 2**40, len(owner)),
                )

    return identified(docs, id_col, text_col).mapInArrow(run, PIECES)


PACKED = "_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def packed(
    docs: DataFrame, capacity: int = 2048, tokenizer: str | None = None, id_col: str = "doc_id",
    text_col: str = "text", block: int = BLOCK,
) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    NULL and empty texts are the end id alone.  Repeated rows are packed as often as
    they occur.  A sequence is filled without gaps from offset 0.
    """
    cut = stage(pieces(docs, capacity, tokenizer, id_col, text_col), "pieces")  # fixes what is dealt to which block
    blocks = max(1, -(-cut.count() // block))

    def fill(some: pd.DataFrame) -> pd.DataFrame:
        some = some.sort_values(["length", "_id", "_h", "piece"], kind="stable").reset_index(drop=True)
        length = some["length"].to_numpy()
        heads = np.searchsorted(length, np.arange(capacity + 2))
        sequence = np.empty(len(some), np.int64)
        offset = np.empty(len(some), np.int64)
        base = int(some["_block"].iloc[0]) << 32
        for k, lengths in enumerate(pack(length, capacity)):
            at = 0
            for n in lengths:
                row = heads[n]
                heads[n] += 1
                sequence[row], offset[row] = base + k, at
                at += n
        out = some[["_id", "piece", "start", "length", "ids_crc32"]]
        return out.assign(sequence_id=sequence, offset=offset)

    dealt = cut.withColumn("_block", F.pmod("salt", F.lit(blocks)))
    out = dealt.groupBy("_block").applyInPandas(fill, PACKED)
    return out.select(id_back().alias("doc_id"), *[c.split()[0] for c in PACKED.split(", ")[1:]])
