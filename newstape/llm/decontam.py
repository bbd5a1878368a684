"""Benchmark decontamination: edit distance by CGK embedding and bit sampling.

Texts are word sequences (64-bit hashes of folded words).  The CGK walk reads a
sequence with a random stride: at step j it writes the current word and, by a random
bit of (j, word), stays or moves on.  Two sequences a few edits apart fall into step
again soon, so their walks agree in most places: edit distance has become Hamming
distance.  Sampling a few places of a walk gives a key; many walks with other random
bits give the recall wanted.  Every window that a match could start at is walked, the
keys meet those of the items in an equi-join, and what meets is verified by edit
distance.

Which windows can start a match is decided without loss: an item of n words within e
edits keeps most words and most neighbouring word pairs, so a window with too few
words or pairs of the benchmark holds no match.  Words, pairs and keys of the benchmark
are looked up in tables of a fixed size; a wrong yes costs time, never a result: only a
window whose key is that of an item is taken to have met it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newstape.llm.common import identified, mapped, rows, stage, text_of

#: bits of each bitmap, as a power of two: 2 MB, whatever the benchmark's size
BITMAP = 24
#: slots of the table of keys, 32 MB: 0 for no key, 1 for several keys or items, else a mark of the item; and the
#: upper half of the slot's one key
SLOTS, SEVERAL = 1 << 22, 1
#: places sampled from each walk
PLACES = 2
#: walks of a length class beyond which its recall counts as out of reach, an error
MOST_WALKS = 4096
_M = np.uint64(0x9E3779B97F4A7C15 | 1)
#: bytes hashed at a time
SPAN = 1 << 20

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        inverse = pow(int(_M), -1, 1 << 64)
        size = max(n, SPAN + 1)
        up, down = np.full(size, _M, np.uint64), np.full(size, np.uint64(inverse), np.uint64)
        up[0] = down[0] = 1
        _powers[:] = [np.cumprod(up), np.cumprod(down)]
    return _powers[0], _powers[1]


def _span_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start places of the words in bytes that end with a blank."""
    inside = _WORD[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[::2], edge[1::2]
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def word_hashes(folded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of texts end to end, and the offsets between texts.

    Words are runs of letters, digits and characters beyond ASCII.  Bytes are hashed a
    span at a time, cut between words, so a very long text needs no more room than others.
    """
    data = np.frombuffer(b" ".join(folded) + b" ", np.uint8)
    bounds = np.cumsum([len(t) + 1 for t in folded])
    found, places, at = [], [], 0
    while at < len(data):
        end = min(at + SPAN, len(data))
        while end < len(data):
            blanks = np.flatnonzero(~_WORD[data[at:end]])
            if len(blanks):
                end = at + int(blanks[-1]) + 1
                break
            end = min(end + SPAN, len(data))
        hashes, starts = _span_hashes(data[at:end])
        found.append(hashes)
        places.append(starts + at)
        at = end
    hashes, places = np.concatenate(found), np.concatenate(places)
    return hashes, np.concatenate([[0], np.searchsorted(places, bounds)])


def fold(values: list[str]) -> list[bytes]:
    return [t.lower().encode("utf-8", "surrogatepass") for t in values]


def pairs_of(words: np.ndarray) -> np.ndarray:
    return mix(words[:-1] * np.uint64(3) + words[1:] * _M)


@dataclass(frozen=True)
class LengthClass:
    """Items of ``low`` to ``high`` words; ``edits`` is what the longest of them may have."""

    low: int
    high: int
    edits: int
    walks: int = 1

    @property
    def window(self) -> int:
        return max(1, self.low - self.edits)

    @property
    def salt(self) -> np.uint64:
        """Marks words and pairs of the class's items among those of all items."""
        return np.uint64((self.low * 0x9E3779B97F4A7C15 + 0x1234567) % 2**64)

    @property
    def steps(self) -> int:
        return 2 * self.window


def class_of(n: int, similarity: float) -> LengthClass:
    """The length class of an item; bounds grow by about a seventh."""
    low = 1
    while True:
        high = max(low, int(low * 1.15))
        if n <= high:
            return LengthClass(low, high, int((1 - similarity) * high + 1e-9))
        low = high + 1


@lru_cache(maxsize=4096)
def _randoms(shape: LengthClass, walk: int) -> tuple[np.ndarray, np.ndarray, np.uint64]:
    """An odd factor per step, whose product's top bit is the stride; the sampled steps; the tag of a walk of a class."""
    seed = np.random.default_rng([shape.low, walk, 20])
    sampled = np.sort(seed.choice(shape.steps, min(PLACES, shape.steps), replace=False))
    strides = seed.integers(0, 2**63, shape.steps).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    return strides, sampled, np.uint64(seed.integers(0, 2**63))


def walk_keys(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, shape: LengthClass, walks: list[int]) -> np.ndarray:
    """The keys of walks over the class's window from every start, a row per walk (ends: where each start's text ends)."""
    strides, sampled, tags = (np.stack(x) for x in zip(*[_randoms(shape, w) for w in walks]))
    ends = np.minimum(ends, starts + shape.window)  # an item is followed by nothing, its copy by other words
    place = np.tile(starts, (len(walks), 1))
    out = np.tile(tags[:, None], (1, len(starts)))
    last = len(words) - 1
    for step in range(int(sampled.max()) + 1):
        word = np.where(place < ends, words[np.minimum(place, last)], np.uint64(0))
        here = np.flatnonzero((sampled == step).any(axis=1))
        if len(here):
            out[here] = mix(out[here] * _M + word[here])
        place += ((word * strides[:, step, None]) >> np.uint64(63)).astype(np.int64)
    return out


def window_hashes(words: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of the ``size`` words from every start."""
    lo = int(starts.min())
    some = words[lo : int((starts + size).max())]
    at = starts - lo
    if len(some) > SPAN:  # beyond the tables of powers: word by word
        out = size.astype(np.uint64)
        for k in range(int(size.max())):
            inside = k < size
            out = np.where(inside, out * _M + some[np.minimum(at + k, len(some) - 1)], out)
        return mix(out)
    up, down = _power_tables(len(some) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(some * up[: len(some)])])
    return mix((sums[at + size] - sums[at]) * down[at] + size.astype(np.uint64))


def calibrated(shape: LengthClass, items: list[np.ndarray], recall: float, seed: int = 5) -> LengthClass:
    """Walks needed so that items with all the edits allowed, at random places, still meet in ``recall`` of cases.

    Fails where ``MOST_WALKS`` are not enough.
    """
    if not shape.edits:
        return shape
    random = np.random.default_rng([seed, shape.low])
    left, right = [], []
    for k in range(400):
        item = items[k % len(items)]
        edits = min(shape.edits, len(item) - 1)
        other = item.tolist()
        for _ in range(edits):
            at = int(random.integers(0, len(other)))
            kind = int(random.integers(0, 3)) if len(other) > 1 else 0
            if kind == 2:
                del other[at]
            elif kind == 1:
                other.insert(at, int(random.integers(1, 2**63)))
            else:
                other[at] = int(random.integers(1, 2**63))
        # a match starts at a word that it shares with the item
        shared = set(item.tolist())
        while len(other) > 1 and other[0] not in shared:
            other.pop(0)
        left.append(item)
        right.append(np.array(other, np.uint64))

    def keys(some, walk):
        ends = np.cumsum([len(x) for x in some])
        return walk_keys(np.concatenate(some), np.concatenate([[0], ends[:-1]]), ends, shape, [walk])[0]

    met = np.zeros(len(left), bool)
    for walk in range(MOST_WALKS):
        met |= keys(left, walk) == keys(right, walk)
        if met.mean() >= recall + (1 - recall) / 2:
            return LengthClass(shape.low, shape.high, shape.edits, walk + 1)
    raise ValueError(f"items of {shape.low} words or more with {shape.edits} edits: {MOST_WALKS} walks find {met.mean():.3f} of them, not {recall}")


def edit_distances(items: list[np.ndarray], windows: list[np.ndarray], limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distance of each item to the best prefix of its window (limit + 1 if over the limit) and that prefix's length."""
    n = np.array([len(x) for x in items])
    m = np.array([len(x) for x in windows])
    wide = int(m.max())
    text = np.zeros((len(items), wide), np.uint64)
    valid = np.arange(wide)[None, :] < m[:, None]
    text[valid] = np.concatenate(windows)
    pattern = np.zeros((len(items), int(n.max())), np.uint64)
    pattern[np.arange(pattern.shape[1])[None, :] < n[:, None]] = np.concatenate(items)
    ramp = np.arange(wide + 1, dtype=np.int32)
    row = np.tile(ramp, (len(items), 1))
    final = row.copy()
    for i in range(pattern.shape[1]):
        step = np.minimum(row[:, 1:] + 1, row[:, :-1] + (text != pattern[:, i : i + 1]))
        step = np.concatenate([row[:, :1] + 1, step], axis=1)
        row = np.minimum.accumulate(step - ramp, axis=1) + ramp
        done = n == i + 1
        final[done] = row[done]
    final[:, 1:][~valid] = 1 << 30
    best = final.argmin(axis=1)
    distance = final[np.arange(len(items)), best]
    return np.where(distance <= limits, distance, limits + 1), best


def _bitmap(hashed: DataFrame, column: str) -> np.ndarray:
    """The bitmap of a column of hashes; parts are made in tasks, at most 512 of 4 KB come back."""
    place = F.col(column).bitwiseAND(F.lit((1 << BITMAP) - 1))
    parts = hashed.select(place.alias("place")).distinct().withColumn("part", F.shiftright("place", 15))
    return _assembled(parts, 1 << (BITMAP - 3), 4096)


def _key_table(keyed: DataFrame) -> np.ndarray:
    """Slots of keys: the mark of the item, and the upper half of the key, where a slot has one of each."""
    slot = F.col("key").bitwiseAND(F.lit(SLOTS - 1))
    mark = F.pmod(F.xxhash64("item_id", "words"), F.lit(2**32 - 2)) + 2
    both = F.struct(mark.alias("mark"), F.shiftrightunsigned("key", 32).alias("half"))
    marks = keyed.select(slot.alias("slot"), both.alias("both")).groupBy("slot").agg(
        F.min("both").alias("low"), F.max("both").alias("high")
    )
    one = F.when(F.col("low") == F.col("high"), F.col("low.mark")).otherwise(F.lit(SEVERAL))
    entry = F.struct(F.col("slot").bitwiseAND(F.lit(4095)).alias("at"), one.alias("mark"), F.col("low.half").alias("half"))
    parts = marks.select(F.shiftright("slot", 12).alias("part"), entry.alias("x"))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        packed = []
        for some in batch.column("marks"):
            table = np.zeros((4096, 2), np.uint32)
            for k, name in enumerate(("mark", "half")):
                table[some.values.field("at").to_numpy(), k] = some.values.field(name).to_numpy()
            packed.append(table.tobytes())
        return rows(part=batch.column("part"), bits=pa.array(packed, pa.binary()))

    spread = parts.groupBy("part").agg(F.collect_list("x").alias("marks"))
    return _gathered(mapped(spread, each, "part long, bits binary"), 8 * SLOTS, 32768).view(np.uint32).reshape(SLOTS, 2)


def _gathered(parts: DataFrame, size: int, step: int) -> np.ndarray:
    """Byte strings of a part each, put in their places; at most 1,024 of them come to the driver, one after the other."""
    out = np.zeros(size, np.uint8)
    for part in parts.toLocalIterator():
        at = part["part"] * step
        out[at : at + step] = np.frombuffer(part["bits"], np.uint8)
    return out


def _assembled(parts: DataFrame, size: int, step: int) -> np.ndarray:
    spread = parts.groupBy("part").agg(F.collect_set(F.col("place").bitwiseAND(F.lit((1 << 15) - 1))).alias("bits"))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        packed = []
        for bits in batch.column("bits"):
            flags = np.zeros(1 << 15, bool)
            flags[bits.values.to_numpy()] = True
            packed.append(np.packbits(flags, bitorder="little").tobytes())
        return rows(part=batch.column("part"), bits=pa.array(packed, pa.binary()))

    return _gathered(mapped(spread, each, "part long, bits binary"), size, step)


def _in(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64((1 << BITMAP) - 1)
    return (bitmap[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 != 0


def _starts(spots: np.ndarray, width: int, least: int, n: int) -> np.ndarray:
    """The places from which ``width`` places on hold at least ``least`` of the sorted ``spots``."""
    if least <= 0:
        return np.arange(n)
    if len(spots) < least:
        return np.empty(0, np.int64)
    first, last = spots[: len(spots) - least + 1], spots[least - 1 :]
    close = last - first < width
    # counted from any start after the first of them would leave out, and up to it holds them all
    begin = np.maximum(last[close] - width + 1, 0)
    stop = first[close] + 1
    begin = np.maximum(begin, np.concatenate([[0], stop[:-1]]))  # each start once
    size = np.maximum(stop - begin, 0)
    step = np.cumsum(size)
    return np.repeat(stop - step, size) + np.arange(step[-1] if len(step) else 0)


def _item_rows(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """Items as word hashes; items without a word are left out."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        hashes, offsets = word_hashes(fold(batch.column("_text").to_pylist()))
        keep = np.diff(offsets) > 0
        if not keep.any():
            return None
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(hashes.view(np.int64)))
        return rows(item_id=batch.column("item_id").filter(pa.array(keep)), words=lists.filter(pa.array(keep)))

    named = benchmark.select(F.col(item_col).cast("long").alias("item_id"), text_of(text_col).alias("_text"))
    return mapped(named.distinct(), each, "item_id long, words array<long>")


def _hits(shapes: list[LengthClass], words_in, pairs_in, keys_in):
    """Windows of a batch of texts whose keys may be those of an item, with the words a match could cover."""

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        vocabulary, couples, known = words_in.value, pairs_in.value, keys_in.value
        values = batch.column("_text").to_pylist()
        sizes = np.cumsum([len(t) for t in values])
        cuts = np.searchsorted(sizes, np.arange(1 << 21, sizes[-1], 1 << 21)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)]):
            if lo < hi:
                yield from some(batch.slice(lo, hi - lo), values[lo:hi], vocabulary, couples, known)

    def some(batch, values, vocabulary, couples, known):
        words, offsets = word_hashes(fold(values))
        n = len(words)
        if not n:
            return
        owner = np.repeat(np.arange(len(values)), np.diff(offsets))
        end = offsets[1:][owner]
        has = _in(vocabulary, words)
        seen = np.concatenate([[0], np.cumsum(has)])
        spots = np.flatnonzero(has[:-1] & has[1:] & (owner[1:] == owner[:-1]))
        pairs = pairs_of(words)[spots]
        known_pair = _in(couples, pairs)
        spots, pairs = spots[known_pair], pairs[known_pair]
        for shape in shapes:
            w = shape.window
            at = _starts(spots[_in(couples, pairs ^ shape.salt)], w - 1, w - 1 - 2 * shape.edits, n)
            at = at[_in(vocabulary, words[at] ^ shape.salt)]
            at = at[at + w <= end[at]]
            at = at[seen[at + w] - seen[at] >= w - shape.edits]
            if not len(at):
                continue
            # of equal stretches of a text the first will do: a text may say the same a thousand times
            reach = np.minimum(at + shape.high + shape.edits, end[at])
            stretch = mix(window_hashes(words, at, reach - at) ^ (owner[at].astype(np.uint64) * _M))
            at = at[np.sort(np.unique(stretch, return_index=True)[1])]
            # equal windows walk alike: one of them goes
            _, one, alike = np.unique(window_hashes(words, at, np.full(len(at), w)), return_index=True, return_inverse=True)
            starts = at[one]
            marks = np.zeros((len(starts), shape.walks), np.uint32)
            found, keys = [], []
            every = np.concatenate([
                walk_keys(words, starts[k : k + 10_000], end[starts[k : k + 10_000]], shape, list(range(shape.walks)))
                for k in range(0, len(starts), 10_000)
            ], axis=1)
            for walk, key in enumerate(every):
                mark, half = known[(key & np.uint64(SLOTS - 1)).astype(np.int64)].T
                # where a slot has one key, 54 bits say that it is this one
                mark = np.where((mark == SEVERAL) | (half == (key >> np.uint64(32)).astype(np.uint32)), mark, 0)
                # so a window that has met an item need not meet it again
                new = (mark > 0) & ((mark == SEVERAL) | ~(marks[:, :walk] == mark[:, None]).any(axis=1))
                marks[:, walk] = mark
                hit = np.flatnonzero(new[alike])
                found.append(hit)
                keys.append(key[alike[hit]])
            found, keys = np.concatenate(found), np.concatenate(keys)
            reach = shape.high + shape.edits
            for lo in range(0, len(found), 5000):
                where = at[found[lo : lo + 5000]]
                stop = np.minimum(where + reach, end[where])
                size = stop - where
                step = np.cumsum(size)
                take = np.repeat(stop - step, size) + np.arange(step[-1])
                text = pa.array(owner[where], pa.int32())
                yield rows(
                    _id=batch.column("_id").take(text), _h=batch.column("_h").take(text),
                    key=keys[lo : lo + 5000].view(np.int64), at=where - offsets[owner[where]],
                    window=pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], step]), pa.int32()), pa.array(words[take].view(np.int64))
                    ),
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from each(batch)

    return run


def _verified(similarity: float):
    def each(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        items = [np.asarray(x.values).view(np.uint64) for x in batch.column("words")]
        windows = [np.asarray(x.values).view(np.uint64) for x in batch.column("window")]
        size = np.array([len(x) for x in items])
        limits = ((1 - similarity) * size + 1e-9).astype(np.int64)
        distance = np.empty(len(items), np.int64)
        length = np.empty(len(items), np.int64)
        order = np.argsort(size, kind="stable")
        lo = 0
        while lo < len(order):
            # rows of like length together, a few million cells at a time
            hi = min(len(order), lo + max(1, 2_000_000 // (2 * int(size[order[lo]]) + 64)))
            while hi > lo + 1 and size[order[hi - 1]] > 2 * size[order[lo]] + 16:
                hi = lo + (hi - lo) // 2
            some = order[lo:hi]
            distance[some], length[some] = edit_distances([items[i] for i in some], [windows[i] for i in some], limits[some])
            lo = hi
        good = pa.array(distance <= limits)
        return rows(
            **{c: batch.column(c).filter(good) for c in ("_id", "_h", "item_id", "at")},
            edits=pa.array(distance).filter(good), n_words=pa.array(length).filter(good),
        )

    return each


def contaminated(
    docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, recall: float = 0.99, id_col: str = "doc_id",
    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(``_id``, ``_h``, ``item_id``, ``edits``, ``first_word``, ``n_words``): items found in documents, best place each.

    An item of n words is found where some run of words lies within
    floor((1 - similarity) * n) word insertions, deletions or replacements of it.  Case and
    punctuation do not count.  Items or texts that are NULL or have no words match
    nothing; items too short for any edit must occur exactly.  Repeated items and
    repeated rows count once.
    """
    spark = docs.sparkSession
    items = stage(_item_rows(benchmark, item_col, item_text_col), "items")
    sizes = [r["n"] for r in items.select(F.size("words").alias("n")).distinct().collect()]  # lengths, not items
    classes = sorted({(s.low, s) for s in (class_of(n, similarity) for n in sizes)}, key=lambda x: x[0])
    shapes = []
    for _, shape in classes:
        within = items.where(F.size("words").between(shape.low, shape.high)).orderBy(F.xxhash64("words")).limit(32)
        sample = [np.array(r["words"], np.int64).view(np.uint64) for r in within.collect()]  # to calibrate, at most 32
        shapes.append(calibrated(shape, sample, recall))

    def shape_of(words: np.ndarray) -> LengthClass:
        return next(s for s in shapes if s.low <= len(words) <= s.high)

    def hashed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out_key, out_item = [], []
        lists = [np.asarray(x.values).view(np.uint64) for x in batch.column("words")]
        for i, words in enumerate(lists):
            shape = shape_of(words)
            keys = walk_keys(words, np.array([0]), np.array([len(words)]), shape, list(range(shape.walks)))[:, 0]
            out_key += keys.tolist()
            out_item += [i] * len(keys)
        pick = pa.array(out_item, pa.int32())
        return rows(key=np.array(out_key, np.uint64).view(np.int64), item_id=batch.column("item_id").take(pick),
                    words=batch.column("words").take(pick))

    def worded(batch: pa.RecordBatch) -> pa.RecordBatch:
        """All words, and those a match may start with, salted: with more words lost before it, it would be too far."""
        lists = [np.asarray(x.values).view(np.uint64) for x in batch.column("words")]
        first = [x[: shape_of(x).edits + 1] ^ shape_of(x).salt for x in lists]
        return rows(word=np.concatenate([*lists, *first]).view(np.int64))

    def coupled(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        """All pairs of neighbours, plain and salted."""
        lists = [np.asarray(x.values).view(np.uint64) for x in batch.column("words")]
        both = [y for x in lists if len(x) > 1 for y in (pairs_of(x), pairs_of(x) ^ shape_of(x).salt)]
        return rows(pair=np.concatenate(both).view(np.int64)) if both else None

    keyed = stage(mapped(items, hashed, "key long, item_id long, words array<long>"), "keys")
    # 2, 2 and 32 MB, whatever the size of the benchmark
    tables = [_bitmap(mapped(items, worded, "word long"), "word"), _bitmap(mapped(items, coupled, "pair long"), "pair"), _key_table(keyed)]
    shared = [spark.sparkContext.broadcast(t) for t in tables]
    hits = identified(docs, id_col, text_col).mapInArrow(
        _hits(shapes, *shared), "_id long, _h long, key long, at long, window array<long>"
    )
    # written first: where the items are few enough to be broadcast, a task would keep two Python workers busy
    hits = stage(hits, "hits")
    met = hits.join(keyed, "key").select("_id", "_h", "item_id", "at", "window", "words")
    found = mapped(met, _verified(similarity), "_id long, _h long, item_id long, at long, edits long, n_words long")
    best = found.groupBy("_id", "_h", "item_id").agg(F.min(F.struct("edits", "at", "n_words")).alias("best"))
    return best.select(
        "_id", "_h", "item_id", "best.edits", F.col("best.at").alias("first_word"), F.col("best.n_words").alias("n_words")
    )
