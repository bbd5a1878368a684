"""SimHash near-duplicates by pigeonring filtering.

A fingerprint has four segments of 16 bits on a ring.  If two fingerprints differ in
at most two bits, then from some segment on every chain of l consecutive segments
differs in at most l * 2 / 4 bits: none in the first, at most one in the first two and
in the first three, at most two in all four.  So a pair is a candidate only if, from
one of the four starts, 48 bits agree but for at most one bit, which lies outside the
first 16.  Each fingerprint is indexed under its own 48 bits and probes with each set
bit of the last 32 cleared (of two values that differ in one bit, one has it set).  A
key's fingerprints differ in 16 bits only, so a group never exceeds 65,536, whatever
the size or skew of the corpus.  The last chain is the full check.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from newstape.llm.common import id_back, identified, longs, mapped, rows, stage, texts, unstage
from newstape.llm.components import components, roots

SEED = 42
LIMIT = 2
MASK16, MASK48 = np.uint64(0xFFFF), np.uint64((1 << 48) - 1)
#: a value of 16 bits and all that differ from it in one bit
NEAR = np.array([0] + [1 << b for b in range(16)], np.uint64)


def fingerprint(text: bytes, width: int = 3) -> int:
    """64-bit SimHash of the word shingles of a text, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= width:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = [0, *(ends[: len(words) - width] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())]
    counts = np.zeros(64, np.int64)
    values = np.array(hashes, "<u8")
    for at in range(0, len(values), 65_536):
        some = values[at : at + 65_536].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    over = 2 * counts > len(values)
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id``, ``_h`` and ``fp`` (64 bits as a long) of every row."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        known: dict[bytes, int] = {}
        out = np.empty(batch.num_rows, np.uint64)
        for i, text in enumerate(texts(batch.column("_text"))):
            if text not in known:
                known[text] = fingerprint(text, width)
            out[i] = known[text]
        return rows(_id=batch.column("_id"), _h=batch.column("_h"), fp=out.view(np.int64))

    return mapped(identified(docs, id_col, text_col), each, "_id long, _h long, fp long")


def _keys(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Index and probe rows of distinct fingerprints."""
    fp = longs(batch.column("fp")).astype(np.int64).view(np.uint64)
    keys, values, probes = [], [], []
    for start in range(4):
        turn = np.uint64(16 * start)
        ring = (fp << turn) | (fp >> np.uint64(64 - 16 * start)) if start else fp
        head = ring >> np.uint64(16)
        tag = np.uint64(start) << np.uint64(48)
        keys.append(head | tag)
        values.append(fp)
        probes.append(np.zeros(len(fp), bool))
        for bit in range(32):
            one = np.uint64(1 << bit)
            has = (head & one) != 0
            keys.append((head[has] ^ one) | tag)
            values.append(fp[has])
            probes.append(np.ones(int(has.sum()), bool))
    return rows(
        key=np.concatenate(keys).view(np.int64), fp=np.concatenate(values).view(np.int64), probe=np.concatenate(probes)
    )


def _pairs(key: np.ndarray, fp: np.ndarray, probe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among complete, sorted groups of one key, enough to connect all that are linked.

    Index rows of a key differ in 16 bits at most.  Those within one bit of a common
    value lie within two bits of each other, so each links to the first of them; a probe
    differs in one bit already and links to the index rows within one bit more.
    """
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    group = np.cumsum(new) - 1
    size = np.bincount(group)
    index = np.bincount(group, weights=~probe)
    good = ((size > 1) & (index > 0))[group]
    if not good.any():
        none = np.empty(0, np.uint64)
        return none, none
    group, fp, probe, key = group[good], fp[good], probe[good], key[good]
    start = (key >> np.int64(48)).astype(np.uint64)
    # the fourth segment from the start on
    last = (fp >> (np.uint64(48) - ((start + np.uint64(3)) & np.uint64(3)) * np.uint64(16))) & MASK16
    cell = group.astype(np.uint64) << np.uint64(16)

    own, own_cell, own_last = fp[~probe], cell[~probe], last[~probe]
    around = (own_cell[:, None] | (own_last[:, None] ^ NEAR[None, :])).ravel()
    who = np.repeat(np.arange(len(own)), len(NEAR))
    order = np.argsort(around, kind="stable")
    around, who = around[order], who[order]
    fresh = np.ones(len(around), bool)
    fresh[1:] = around[1:] != around[:-1]
    leader = who[np.maximum.accumulate(np.where(fresh, np.arange(len(around)), 0))]
    u, v = own[who], own[leader]

    exact = own_cell | own_last
    by = np.argsort(exact)
    wanted = (cell[probe][:, None] | (last[probe][:, None] ^ NEAR[None, :])).ravel()
    at = np.minimum(np.searchsorted(exact[by], wanted), max(len(by) - 1, 0))
    hit = exact[by][at] == wanted
    pu, pv = np.repeat(fp[probe], len(NEAR))[hit], own[by][at][hit]
    u, v = np.concatenate([u, pu]), np.concatenate([v, pv])
    near = (u != v) & (np.bitwise_count(u ^ v) <= LIMIT)  # the whole ring
    return u[near], v[near]


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams rows sorted by key; the last, perhaps unfinished key waits for the next batch."""
    held: list[np.ndarray] | None = None

    def emit(key, fp, probe):
        u, v = _pairs(key, fp.view(np.uint64), probe)
        if len(u):
            nodes, top = roots(u.view(np.int64), v.view(np.int64))
            keep = nodes != top
            yield rows(u=nodes[keep], v=top[keep])

    for batch in batches:
        block = [longs(batch.column(n)) for n in ("key", "fp", "probe")]
        if held is not None:
            block = [np.concatenate(x) for x in zip(held, block)]
        cut = np.searchsorted(block[0], block[0][-1])
        if cut:
            yield from emit(*[x[:cut] for x in block])
        held = [x[cut:] for x in block]
    if held is not None and len(held[0]):
        yield from emit(*held)


def links(prints: DataFrame) -> DataFrame:
    """(u, v) links between the distinct fingerprints of ``prints`` (fp), enough to connect every component."""
    distinct = prints.select("fp").distinct()
    keyed = mapped(distinct, _keys, "key long, fp long, probe boolean")
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_linked, "u long, v long")


def near_duplicates(
    docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``_h``, ``fp``, ``root`` and ``component_id`` for every row of ``docs``.

    Texts are compared by the SimHash of their ``width``-word shingles; a text of fewer
    words is one shingle, and one of no words (NULL too) has fingerprint zero.
    Fingerprints link at two or fewer differing bits; ``root`` is the component's smallest
    fingerprint.  ``component_id`` is the smallest id
    reachable by links; NULL ids are linked too but never name a component, unless it
    has no other.  Repeated rows get equal answers; equal texts are one node.
    """
    prints = stage(fingerprints(docs, width, id_col, text_col), "prints")
    nodes = prints.groupBy("fp").agg(F.min(id_back()).alias("low"))
    # written first: a task that found links and shrank them in one go would keep two Python workers busy
    linked = stage(links(prints), "linked")
    found = components(linked).select(F.col("node").alias("fp"), "root")
    unstage(linked)
    rooted = nodes.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = stage(rooted.join(lows, "root").select("fp", "root", "component_id"), "named")
    return prints.join(named, "fp").select(id_back().alias("doc_id"), "_h", "fp", "root", "component_id")
