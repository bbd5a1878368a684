"""Line deduplication: range partitions of line hashes, streamed in order, keep bitmaps as the answer.

A line's hash travels with its document and position.  Hashes are range-partitioned
together with document and position, so a line that stands in a third of all
documents is spread over many ranges; inside a range the rows are sorted and
streamed once.  A run of equal hashes begins with its largest document, the one
that keeps the line.  Only the first and the last run of a range can go on in
another range: each leaves one summary row, and the rows that depend on it wait for
the few summaries to be added up.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from newstape.llm.common import identified, longs, mapped, matched, neutral, rows, stage, texts

#: fixed values: what is stripped at both ends of a line
BLANKS = b" \t\n\x0b\x0c\r"

LINE = "k1 long, k2 long, _id long, _h long, pos int, n_lines int"
SEEN = LINE + ", kind int, n_docs long, first_id long, last_id long, range int"
DROP, WAIT, SUMMARY = 0, 1, 2


def line_hashes(docs: DataFrame, min_chars: int, id_col: str, text_col: str) -> DataFrame:
    """A row per line of at least ``min_chars`` code points: 128-bit hash of its key, document, position."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        digest, owner, at, count = [], [], [], []
        for i, text in enumerate(texts(batch.column("_text"))):
            lines = text.split(b"\n")
            for k, line in enumerate(lines):
                if len(line) < min_chars:
                    continue
                key = line.strip(BLANKS).lower()
                if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars):
                    digest.append(xxhash.xxh3_128_digest(key))
                    owner.append(i)
                    at.append(k)
                    count.append(len(lines))
        if not digest:
            return None
        halves = np.frombuffer(b"".join(digest), np.int64).reshape(-1, 2)
        pick = pa.array(owner, pa.int32())
        return rows(
            k1=halves[:, 0].copy(), k2=halves[:, 1].copy(), _id=pc.take(batch.column("_id"), pick),
            _h=pc.take(batch.column("_h"), pick), pos=pa.array(at, pa.int32()), n_lines=pa.array(count, pa.int32()),
        )

    return mapped(identified(docs, id_col, text_col), each, LINE)


def _ranges(min_docs: int):
    """The streaming pass over one sorted range; see :func:`line_bitmaps`."""

    def out(block: dict, kind: np.ndarray) -> pa.RecordBatch:
        n = len(kind)
        zero = np.zeros(n, np.int64)
        return rows(
            **block, kind=kind.astype(np.int32), n_docs=zero, first_id=zero, last_id=zero,
            range=np.zeros(n, np.int32),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["k1", "k2", "_id", "_h", "pos", "n_lines"]
        where = TaskContext.get().partitionId()
        held: dict | None = None  # rows of the run that is still open and undecided
        state: list | None = None  # open run: k1, k2, documents so far, first id, last id, is the range's first
        summaries: list[list] = []

        for batch in batches:
            if not batch.num_rows:
                continue
            block = {n: longs(batch.column(n)) for n in names}
            if held is not None:
                block = {n: np.concatenate([held[n], block[n]]) for n in names}
            again = len(held["k1"]) if held is not None else 0
            n = len(block["k1"])
            new_key = np.ones(n, bool)
            new_key[1:] = (block["k1"][1:] != block["k1"][:-1]) | (block["k2"][1:] != block["k2"][:-1])
            goes_on = state is not None and block["k1"][0] == state[0] and block["k2"][0] == state[1]
            new_doc = new_key.copy()
            new_doc[1:] |= block["_id"][1:] != block["_id"][:-1]
            starts = np.flatnonzero(new_key)
            run_of = np.cumsum(new_key) - 1
            counted = np.add.reduceat(new_doc.astype(np.int64), starts)
            first = block["_id"][starts].copy()
            last = block["_id"][np.append(starts[1:], n) - 1]
            of_range = np.zeros(len(starts), bool)
            if state is None:
                of_range[0] = True
            elif goes_on:
                if not again:  # its earlier rows have left already
                    counted[0] += state[2] - (block["_id"][0] == state[4])
                    first[0] = state[3]
                of_range[0] = state[5]
            elif state[5]:
                summaries.append(state)
            # all but the last run are complete; the last one is decided as soon as it has enough documents
            closed = np.ones(len(starts), bool)
            closed[-1] = counted[-1] >= min_docs
            wait = of_range  # may go on in the range before: its rows wait for the summaries
            drop = (counted >= min_docs)[run_of] & (block["_id"] != first[run_of]) & ~wait[run_of]
            emit = drop | wait[run_of]
            kind = np.where(wait[run_of], WAIT, DROP)
            if emit.any():
                yield out({k: x[emit] for k, x in block.items()}, kind[emit])
            state = [block["k1"][-1], block["k2"][-1], int(counted[-1]), first[-1], last[-1], bool(of_range[-1])]
            if len(starts) > 1 and of_range[0]:
                summaries.append([block["k1"][0], block["k2"][0], int(counted[0]), first[0], last[0], True])
            # an undecided last run stays; the range's first run has been passed on as waiting rows
            stays = not closed[-1] and not of_range[-1]
            held = {k: x[starts[-1] :] for k, x in block.items()} if stays else None
        if held is not None:
            yield out(held, np.full(len(held["k1"]), WAIT))
        if state is not None:
            summaries.append(state)
        if summaries:
            k1, k2, n_docs, first_id, last_id, _ = zip(*summaries)
            zero = np.zeros(len(k1), np.int64)
            yield rows(
                k1=pa.array(k1, pa.int64()), k2=pa.array(k2, pa.int64()), _id=zero, _h=zero,
                pos=zero.astype(np.int32), n_lines=zero.astype(np.int32),
                kind=np.full(len(k1), SUMMARY, np.int32), n_docs=pa.array(n_docs, pa.int64()),
                first_id=pa.array(first_id, pa.int64()), last_id=pa.array(last_id, pa.int64()),
                range=np.full(len(k1), where, np.int32),
            )

    return run


def line_bitmaps(
    docs: DataFrame, min_chars: int = 40, min_docs: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Keep bitmaps of the documents that lose lines.

    A line's key is the line without blanks at both ends, A-Z in lower case.  Keys of
    at least ``min_chars`` code points found in at least ``min_docs`` documents keep
    their lines only in the document with the largest id.  Returns ``_id``, ``_h``
    (see :func:`~newstape.llm.common.identified`), ``n_lines``, ``n_dropped`` and
    ``keep``: one bit per line, first line in the highest bit, zlib-compressed.  A
    document that is not in the result keeps every line.

    NULL text is one empty line.  Rows of one id count as one document; a NULL id is
    one document below all others.  Repeated rows share their bitmap.
    """
    lines = stage(line_hashes(docs, min_chars, id_col, text_col), "lines")
    order = ["k1", "k2", F.desc("_id"), "_h", "pos"]
    dealt = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    seen = stage(dealt.mapInArrow(_ranges(min_docs), SEEN), "seen")

    # at most two rows per range: pieces of runs that may span ranges
    pieces = seen.where(F.col("kind") == SUMMARY)
    by_range = Window.partitionBy("k1", "k2").orderBy("range")
    shared = F.when(F.lag("last_id").over(by_range) == F.col("first_id"), 1).otherwise(0)
    summed = pieces.withColumn("shared", shared).groupBy("k1", "k2").agg(
        (F.sum("n_docs") - F.sum("shared")).alias("docs"), F.max("first_id").alias("keeper")
    ).where(F.col("docs") >= min_docs)
    late = seen.where(F.col("kind") == WAIT).join(F.broadcast(summed), ["k1", "k2"]).where("_id <> keeper")
    columns = ["_id", "_h", "pos", "n_lines"]
    drops = seen.where(F.col("kind") == DROP).select(*columns).unionByName(late.select(*columns))
    per_doc = drops.groupBy("_id", "_h").agg(F.first("n_lines").alias("n_lines"), F.collect_set("pos").alias("dropped"))

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        keeps, counts = [], []
        for n, gone in zip(batch.column("n_lines").to_pylist(), batch.column("dropped")):
            bits = np.ones(n, bool)
            bits[gone.values.to_numpy()] = False
            keeps.append(zlib.compress(np.packbits(bits).tobytes(), 1))
            counts.append(len(gone.values))
        return rows(
            _id=batch.column("_id"), _h=batch.column("_h"), n_lines=pc.cast(batch.column("n_lines"), pa.int64()),
            n_dropped=pa.array(counts, pa.int64()), keep=pa.array(keeps, pa.binary()),
        )

    return mapped(per_doc, pack, "_id long, _h long, n_lines long, n_dropped long, keep binary")


def kept_lines(text: bytes, keep: bytes | None) -> tuple[bytes, int, int]:
    """The remaining text, the number of lines before, and of lines dropped."""
    lines = text.split(b"\n")
    if keep is None:
        return text, len(lines), 0
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines))
    left = [line for line, bit in zip(lines, bits) if bit]
    return b"\n".join(left), len(lines), len(lines) - len(left)


def drop_lines(
    docs: DataFrame, min_chars: int = 40, min_docs: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every row of ``docs``, its text reduced to the lines it keeps, plus ``_n_lines`` and ``_n_dropped``.

    A document whose every line goes has an empty text, and one that loses none is
    unchanged (NULL stays NULL).  See :func:`line_bitmaps` for repeats and ties.
    """
    bitmaps = line_bitmaps(docs, min_chars, min_docs, id_col, text_col).select("_id", "_h", "keep")
    whole = matched(docs, bitmaps, "left", id_col, text_col, keep=True)
    columns = neutral(docs)
    body = columns[docs.columns.index(text_col)]

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        values, before, gone = [], [], []
        for text, keep in zip(texts(batch.column(body)), batch.column("keep").to_pylist()):
            left, n, dropped = kept_lines(text or b"", keep)
            values.append(None if text is None else left.decode())
            before.append(n)
            gone.append(dropped)
        kept = pa.array(values, pa.string())
        return rows(
            **{c: kept if c == body else batch.column(c) for c in columns},
            _n_lines=pa.array(before, pa.int64()), _n_dropped=pa.array(gone, pa.int64()),
        )

    inputs = whole.select(*columns, "keep")
    schema = ", ".join(f"{c} {t}" for c, t in inputs.dtypes if c != "keep") + ", _n_lines long, _n_dropped long"
    return mapped(inputs, each, schema).toDF(*docs.columns, "_n_lines", "_n_dropped")
