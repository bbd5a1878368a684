"""Suffix-array dedup: a run-length compressed index of what may repeat, long matches streamed from it.

A string of ``length`` bytes that occurs twice has, at both places, its smallest k-gram
hash at the same place (its anchor).  So a text is cut into overlapping segments, one per
anchor, that hold the windows with that anchor, and only segments whose anchors are equal
can share a window.  Equal segments are one row with a count; what is left of anchors
with several different segments goes into blocks, and each block is indexed:

* its suffixes are sorted by prefix doubling, up to more bytes than a segment has,
* the Burrows-Wheeler transform is cut into runs, and the suffix array is kept at the
  run ends only,
* inside a run the partner of a suffix moves in step with it and the match shrinks byte
  by byte, so the matching statistics of all places follow from those at the run ends:
  each match of ``length`` or more there is marked once, as a whole, on both sides.

Anchors with very many different segments (the edges of a passage that a third of all
documents share) would be too much for a block.  Their windows are hashed and counted
instead, which splits over tasks at any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newstape.llm.common import flat, identified, longs, mapped, matched, neutral, rows, stage, texts, tidy, unstage
from newstape.llm.decontam import mix

LENGTH, GRAM = 200, 40
#: bytes whose anchors are found at a time
SPAN = 1 << 20
#: bytes indexed at a time, and segments of one anchor that a block takes
BLOCK, MANY = 1 << 20, 4096
#: ends every segment in a block; no UTF-8 text holds it
END = 0xFF
_M = np.uint64(0xD6E8FEB86659FD93 | 1)
_PLACE = np.uint64((1 << 21) - 1)

_powers: list[np.ndarray] = []


def _power_tables() -> tuple[np.ndarray, np.ndarray]:
    if not _powers:
        n = SPAN + 4 * LENGTH + 2
        up, down = np.full(n, _M, np.uint64), np.full(n, np.uint64(pow(int(_M), -1, 1 << 64)), np.uint64)
        up[0] = down[0] = 1
        _powers[:] = [np.cumprod(up), np.cumprod(down)]
    return _powers[0], _powers[1]


class Hashes:
    """Hashes of any substring of a span, from sums over its prefixes."""

    def __init__(self, data: np.ndarray):
        up, self.down = _power_tables()
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def all(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return (self.sums[size:] - self.sums[:-size]) * self.down[:n]


def _span_segments(data: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor hash, segment hash, start and size of each segment; ``valid``: where a window may start."""
    hashes = Hashes(data)
    grams = hashes.all(GRAM)
    low = (mix(grams) & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    width, reach = LENGTH - GRAM + 1, 1
    while 2 * reach <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if width > reach:
        low = np.minimum(low[: len(low) - (width - reach)], low[width - reach :])
    anchor = (low & _PLACE).astype(np.int64)  # of the window that starts here
    starts = np.flatnonzero(valid[: len(anchor)])
    if not len(starts):
        none = np.empty(0, np.int64)
        return none, none, none, none
    cut = np.concatenate([[True], (starts[1:] != starts[:-1] + 1) | (anchor[starts[1:]] != anchor[starts[:-1]])])
    first = starts[cut]
    last = starts[np.concatenate([np.flatnonzero(cut)[1:] - 1, [len(starts) - 1]])]
    size = last - first + LENGTH
    key = mix(grams[anchor[first]] ^ np.uint64(0x51ED270B7A3F8A11))
    whole = mix(hashes.of(first, first + size) + size.astype(np.uint64))
    return key.view(np.int64), whole.view(np.int64), first, size


def segments_of(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Segments of texts end to end: anchor, segment hash, text number, start in the text, size."""
    sizes = np.diff(offsets)
    for lo in range(0, max(len(data) - LENGTH + 1, 0), SPAN):
        hi = min(lo + SPAN + LENGTH - 1, len(data))
        if hi - lo < LENGTH:
            break
        a = np.searchsorted(offsets, lo, "right") - 1
        b = np.searchsorted(offsets, hi, "left")
        valid = np.zeros(hi - lo, bool)
        for k in range(a, b):
            if sizes[k] >= LENGTH:
                valid[max(offsets[k], lo) - lo : max(0, min(offsets[k + 1] - LENGTH + 1, lo + SPAN) - lo)] = True
        key, whole, first, size = _span_segments(data[lo:hi], valid)
        if len(key):
            text = np.searchsorted(offsets, first + lo, "right") - 1
            yield key, whole, text, first + lo - offsets[text], size


SEGMENTS = "key long, seg long, _id long, _h long, start long, size int"


def segments(docs: DataFrame) -> DataFrame:
    """A row per segment of identified documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column("_text"))
            for key, seg, text, start, size in segments_of(data, offsets):
                pick = pa.array(text)
                yield rows(key=key, seg=seg, _id=batch.column("_id").take(pick), _h=batch.column("_h").take(pick),
                           start=start, size=size.astype(np.int32))

    return docs.mapInArrow(run, SEGMENTS)


class RunIndex:
    """The runs of a Burrows-Wheeler transform and the suffix array at the run ends.

    ``starts[k]`` is the place in the text of the suffix that begins run k in suffix
    order, ``before[k]`` that of the suffix just above it, which ends run k - 1.
    """

    def __init__(self, text: np.ndarray, longest: int):
        n = len(text)
        padded = np.concatenate([text, np.full(16, END, np.uint8)])
        eight = np.zeros(n, np.uint64)
        for k in range(8):
            eight = (eight << np.uint64(8)) | padded[k : n + k].astype(np.uint64)
        order = np.argsort(eight)
        rank = self._ranks(order, eight[order])
        self.levels = [rank]
        reach = 8
        while reach < longest:
            ahead = np.zeros(n, np.int64)
            ahead[: n - reach] = rank[reach:] + 1 if n > reach else 0
            pair = rank * np.int64(n + 1) + ahead
            order = np.argsort(pair)
            rank = self._ranks(order, pair[order])
            self.levels.append(rank)
            reach *= 2
        previous = np.where(order > 0, text[order - 1], END)
        # a run also ends where a text begins: what stands before a segment is no character of it
        change = (previous[1:] != previous[:-1]) | (previous[1:] == END)
        heads = np.flatnonzero(change) + 1
        self.n_runs = len(heads) + 1
        self.starts, self.before = order[heads], order[heads - 1]
        self.size = n

    @staticmethod
    def _ranks(order: np.ndarray, keys: np.ndarray) -> np.ndarray:
        rank = np.empty(len(order), np.int64)
        step = np.concatenate([[0], (keys[1:] != keys[:-1]).astype(np.int64)])
        rank[order] = np.cumsum(step)
        return rank

    def match(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the match of two places, in steps of eight bytes, a lower bound of up to 8 bytes less."""
        total = np.zeros(len(a), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            rank, reach = self.levels[level], 8 << level
            again = np.ones(len(a), bool)
            while again.any():
                x, y = np.minimum(a + total, self.size - 1), np.minimum(b + total, self.size - 1)
                again &= (a + total < self.size) & (b + total < self.size) & (rank[x] == rank[y])
                total[again] += reach
                if level < len(self.levels) - 1:
                    break
        return total


def long_matches(text: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the matches of ``length`` or more between segments; ``ends[i]``: end of i's segment."""
    index = RunIndex(text, int((ends - np.arange(len(text))).max()) + 1)
    a, b = index.starts, index.before
    room = np.minimum(ends[a] - a, ends[b] - b)
    fits = room >= length
    a, b, room = a[fits], b[fits], room[fits]
    found = np.minimum(index.match(a, b), room)
    near = found + 8 > length  # may reach the length with the bytes not compared yet
    a, b, room, found = a[near], b[near], room[near], found[near]
    for _ in range(8):
        more = found < room
        x, y = np.minimum(a + found, index.size - 1), np.minimum(b + found, index.size - 1)
        found += more & (text[x] == text[y])
    good = found >= length
    a, b, found = a[good], b[good], found[good]
    return np.concatenate([a, b]), np.concatenate([a + found, b + found])


def union(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals joined where they overlap or touch."""
    if not len(begin):
        return begin, end
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], begin[1:] > end[:-1]])
    return begin[new], end[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(end) - 1]])]


def _contents(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The bytes of the segments asked for, of documents that come with their list of segments."""
    asked = batch.column("asked")
    owner = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(asked.offsets)))
    fields = asked.flatten()
    column = {name: longs(fields.field(name)) for name in ("key", "seg", "start", "size", "n", "many")}
    bodies = texts(batch.column("_text"))
    for lo in range(0, len(owner), 20_000):
        some = slice(lo, lo + 20_000)
        cut = [bodies[o][a : a + n] for o, a, n in zip(owner[some], column["start"][some], column["size"][some])]
        pick = pa.array(owner[some])
        yield rows(
            key=column["key"][some], seg=column["seg"][some], _id=batch.column("_id").take(pick),
            _h=batch.column("_h").take(pick), start=column["start"][some], n=column["n"][some],
            many=column["many"][some], body=pa.array(cut, pa.binary()),
        )


CONTENTS = "key long, seg long, _id long, _h long, start long, n long, many boolean, body binary"
MARKS = "_id long, _h long, begin long, end long"


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks on single segments; rows come sorted by anchor, and an anchor's segments go into one block."""

    def marks(held: list[tuple]) -> pa.RecordBatch | None:
        keys, ids, hashes, starts, counts, bodies = zip(*held)
        size = np.array([len(b) for b in bodies])
        text = np.frombuffer(bytes([END]).join(bodies) + bytes([END]), np.uint8)
        first = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
        ends = np.repeat(first + size, size + 1)
        begin, end = long_matches(text, ends)
        which = np.searchsorted(first, begin, "right") - 1
        single = np.array(counts)[which] == 1  # the others are repeated as a whole
        begin, end, which = begin[single], end[single], which[single]
        if not len(begin):
            return None
        # joined within each segment: segments lie apart in the text, so matches of two never touch
        begin, end = union(begin, end)
        which = np.searchsorted(first, begin, "right") - 1
        shift = np.array(starts)[which] - first[which]
        return rows(_id=np.array(ids)[which], _h=np.array(hashes)[which], begin=begin + shift, end=end + shift)

    held: list[tuple] = []
    size = 0
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("key", "_id", "_h", "start", "n", "body")]
        for row in zip(*columns):
            if size >= BLOCK and row[0] != held[-1][0]:
                out = marks(held)
                held, size = [], 0
                if out is not None:
                    yield out
            held.append(row)
            size += len(row[5]) + 1
    if held:
        out = marks(held)
        if out is not None:
            yield out


def _windows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A hash per window of the segments of crowded anchors."""
    bodies = texts(batch.column("body"))
    owner, hashed, at = [], [], []
    for i, body in enumerate(bodies):
        found = Hashes(np.frombuffer(body, np.uint8)).all(LENGTH)
        owner.append(np.full(len(found), i))
        hashed.append(mix(found))
        at.append(np.arange(len(found)))
    pick = pa.array(np.concatenate(owner))
    yield rows(
        key=batch.column("key").take(pick), window=np.concatenate(hashed).view(np.int64), _id=batch.column("_id").take(pick),
        _h=batch.column("_h").take(pick), begin=np.concatenate(at) + np.asarray(batch.column("start").take(pick)),
        n=batch.column("n").take(pick),
    )


def _each(function):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from function(batch)

    return run


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id``, ``_h`` and ``spans`` (begin, end in bytes, sorted and disjoint) of documents with repeated strings.

    Covered is every byte of a ``LENGTH``-byte string of UTF-8 that also starts anywhere
    else, in the same document or another; matches do not cross documents.  Rows are
    documents: a repeated row repeats its whole text.  NULL and shorter texts have no spans.
    """
    spark = docs.sparkSession
    known = identified(docs, id_col, text_col)
    found = stage(segments(known), "segments")
    # counts are written apart from the joins that use them, so Spark may split a busy anchor in the join
    again = stage(found.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "anchors")
    twice = stage(found.join(again, "key", "left_semi"), "anchored")
    unstage(found)
    tidy(spark)
    one = F.min(F.struct("_id", "_h", "start", "size")).alias("one")
    contents = stage(twice.groupBy("key", "seg").agg(F.count(F.lit(1)).alias("n"), one), "contents")
    crowd = contents.groupBy("key").agg(F.count(F.lit(1)).alias("segs"), F.count_if(F.col("n") == 1).alias("singles"))
    crowd = stage(crowd.where("segs > 1 AND singles > 0").select("key", (F.col("segs") > MANY).alias("many")), "crowds")
    row = F.struct("key", "seg", "one.start", "one.size", "n", "many")
    asked = contents.join(crowd, "key").groupBy(F.col("one._id").alias("_id"), F.col("one._h").alias("_h"))
    asked = asked.agg(F.collect_list(row).alias("asked"))
    # repeated rows hold the same text: one of them is read
    held = known.join(asked, ["_id", "_h"])
    bodies = stage(held.mapInArrow(_each(_contents), CONTENTS), "bodies")
    tidy(spark)

    ordered = bodies.where(~F.col("many")).repartition("key").sortWithinPartitions("key", "seg")
    indexed = ordered.mapInArrow(_indexed, MARKS)

    windows = bodies.where("many").mapInArrow(
        _each(_windows), "key long, window long, _id long, _h long, begin long, n long"
    )
    shared = windows.groupBy("key", "window").agg(F.count(F.lit(1)).alias("segs")).where("segs > 1")
    crowded = windows.where("n = 1").join(shared, ["key", "window"], "left_semi")
    crowded = crowded.select("_id", "_h", "begin", (F.col("begin") + LENGTH).alias("end"))

    copied = twice.join(contents.where("n > 1").select("key", "seg"), ["key", "seg"], "left_semi")
    copied = copied.select("_id", "_h", F.col("start").alias("begin"), (F.col("start") + F.col("size")).alias("end"))

    marks = indexed.unionByName(crowded).unionByName(copied)
    per_doc = marks.groupBy("_id", "_h").agg(F.collect_set(F.struct("begin", "end")).alias("marks"))

    def joined(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = []
        for some in batch.column("marks"):
            begin, end = union(np.asarray(some.values.field("begin")), np.asarray(some.values.field("end")))
            spans.append([{"begin": int(a), "end": int(b)} for a, b in zip(begin, end)])
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        return rows(_id=batch.column("_id"), _h=batch.column("_h"), spans=pa.array(spans, kind))

    return mapped(per_doc, joined, "_id long, _h long, spans array<struct<begin: long, end: long>>")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``_spans`` (what is repeated, see :func:`repeats`) and ``_kept`` (the other bytes).

    ``_kept`` is binary: a span may begin or end inside a character.
    """
    whole = matched(docs, repeats(docs, id_col, text_col), "left", id_col, text_col, keep=True)
    columns = neutral(docs)
    body = columns[docs.columns.index(text_col)]

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept = []
        for text, spans in zip(texts(batch.column(body)), batch.column("spans").to_pylist()):
            text, spans = text or b"", spans or []
            at = [0, *[x for s in spans for x in (s["begin"], s["end"])], len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(at[::2], at[1::2])))
        return rows(**{c: batch.column(c) for c in [*columns, "spans"]}, _kept=pa.array(kept, pa.binary()))

    inputs = whole.select(*columns, "spans")
    schema = ", ".join(f"{c} {t}" for c, t in inputs.dtypes) + ", _kept binary"
    return mapped(inputs, each, schema).toDF(*docs.columns, "_spans", "_kept")
