"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A document is a sparse vector: its distinct words hashed to buckets with damped,
length-normalised counts, a block of structure statistics, and optional metadata
columns.  The machine adds to a linear score the inner products of low-rank vectors of
every pair of active features.  The sum over pairs is computed in linear time:
half of (square of the sum minus sum of the squares), per latent dimension.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newstape.llm.common import mapped, rows, text_of

BUCKETS = 1 << 15
RANK = 6
#: structure statistics take the first feature slots, hashed words and metadata the rest
STATS = 16
#: entries of a worker's word table; it starts anew when full, results do not depend on it
WORD_TABLE = 100_000

FEATURES = "idx array<int>, val array<float>"


class _Buckets(dict):
    """A worker's table of hashed words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= WORD_TABLE:
            self.clear()
        self[word] = n = STATS + zlib.crc32(word.encode("utf-8", "surrogatepass")) % (BUCKETS - STATS)
        return n


_buckets = _Buckets()


def _kinds() -> np.ndarray:
    """What each byte of UTF-8 counts as: letter (a lead byte above ASCII too), upper case, digit, mark, sentence end."""
    byte = np.arange(256)
    upper = (byte >= 65) & (byte <= 90)
    lower = (byte >= 97) & (byte <= 122)
    digit = (byte >= 48) & (byte <= 57)
    end = np.isin(byte, list(b".!?"))
    common = np.isin(byte, list(b".,;:!?'\"()-"))
    mark = (byte > 32) & (byte < 127) & ~(upper | lower | digit | common)
    return np.stack([upper | lower | (byte >= 192), upper, digit, mark, end], 1).astype(np.int64)


KINDS = _kinds()
BLANK = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
WORDY = KINDS[:, 0].astype(bool) | KINDS[:, 2].astype(bool) | (np.arange(256) >= 128)


def statistics(text: str, words: list[str], counts: dict[str, int]) -> list[float]:
    """Structure of a text as ``STATS`` numbers of about unit size; an empty text has its own flag."""
    m = len(words)
    if not m:
        return [1.0, 1.0] + [0.0] * (STATS - 2)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    n = len(data)
    letters, upper, digits, marks, ends = (np.bincount(data, minlength=256) @ KINDS).tolist()
    closed = int((WORDY[data[:-1]] & BLANK[data[1:]]).sum())  # words that end in a letter or digit
    lines = text.split("\n")
    return [
        1.0,
        0.0,
        np.log1p(n) / 10,
        np.log1p(m) / 8,
        np.log1p(len(lines)) / 5,
        min(n / m / 10, 4.0),
        len(counts) / m,
        max(counts.values()) / m,
        len(set(lines)) / len(lines),
        upper / max(letters, 1),
        digits / n * 5,
        min(marks / m, 4.0),
        min(ends / m * 4, 4.0),
        closed / m,
        float(m < 20),
        np.log1p(len(counts)) / 8,
    ]


def features(text: str, metadata: tuple = ()) -> tuple[np.ndarray, np.ndarray]:
    """Feature slots and values of one document; ``metadata`` holds (name, value) pairs, NULL values left out."""
    words = text.split()
    counts = Counter(words)
    slots = np.fromiter(map(_buckets.__getitem__, counts), np.int64, len(counts))
    value = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
    if len(value):
        value *= 1.5 / np.sqrt((value**2).sum())
    extra = [_buckets[f"\0{name}={x}"] for name, x in metadata if x is not None]
    idx = np.concatenate([np.arange(STATS), slots, np.array(extra, np.int64)])
    val = np.concatenate([statistics(text, words, counts), value, np.full(len(extra), 0.3)])
    return idx.astype(np.int32), val.astype(np.float32)


@dataclass
class Machine:
    """Weights; ``shift`` and ``scale`` calibrate the raw score to a probability of label 1."""

    bias: float
    w: np.ndarray
    v: np.ndarray
    shift: float = 0.0
    scale: float = 1.0

    def raw(self, idx: np.ndarray, val: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Scores of documents whose features lie end to end, each beginning at its start (none is empty)."""
        linear = np.add.reduceat(self.w[idx] * val, starts)
        part = self.v[idx] * val[:, None]
        total = np.add.reduceat(part, starts)
        squares = np.add.reduceat(part**2, starts)
        return self.bias + linear + 0.5 * (total**2 - squares).sum(axis=1)

    def score(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * raw + self.shift, -30, 30)))


def fit(
    idx: list[np.ndarray], val: list[np.ndarray], label: np.ndarray, epochs: int = 12, rate: float = 0.1,
    decay: float = 1e-4, seed: int = 7,
) -> Machine:
    """Adagrad on the log loss over mini-batches, then Platt calibration on every fifth document, held back.

    Without rows, or with one class only, the score is that class's smoothed share.
    """
    random = np.random.default_rng(seed)
    share = (label.sum() + 1) / (len(label) + 2)
    model = Machine(float(np.log(share / (1 - share))), np.zeros(BUCKETS, np.float32),
                    random.normal(0, 0.02, (BUCKETS, RANK)).astype(np.float32))
    if len(set(label.tolist())) < 2:
        model.v[:] = 0
        return model
    order = random.permutation(len(label))
    held, used = order[::5], np.delete(order, slice(None, None, 5))
    if len(set(label[held].tolist())) < 2 or len(set(label[used].tolist())) < 2:
        held = used = order

    def packed(some):
        sizes = np.array([len(idx[i]) for i in some])
        return (np.concatenate([idx[i] for i in some]), np.concatenate([val[i] for i in some]),
                np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)

    gw, gv, gb = np.full(BUCKETS, 1e-3), np.full((BUCKETS, RANK), 1e-3), 1e-3
    for _ in range(epochs):
        random.shuffle(used)
        for at in range(0, len(used), 64):
            some = used[at : at + 64]
            i, x, starts, sizes = packed(some)
            part = model.v[i] * x[:, None]
            total = np.add.reduceat(part, starts)
            raw = model.bias + np.add.reduceat(model.w[i] * x, starts) + 0.5 * (
                total**2 - np.add.reduceat(part**2, starts)).sum(axis=1)
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - label[some]) / len(some)
            e = np.repeat(error, sizes)
            slots, back = np.unique(i, return_inverse=True)
            dw = np.bincount(back, e * x, len(slots)) + decay * model.w[slots]
            whole = np.repeat(total, sizes, axis=0)
            d = (e * x)[:, None] * (whole - part)
            dv = np.stack([np.bincount(back, d[:, k], len(slots)) for k in range(RANK)], 1) + decay * model.v[slots]
            gw[slots] += dw**2
            gv[slots] += dv**2
            gb += error.sum() ** 2
            model.w[slots] -= (rate * dw / np.sqrt(gw[slots])).astype(np.float32)
            model.v[slots] -= (rate * dv / np.sqrt(gv[slots])).astype(np.float32)
            model.bias -= rate * error.sum() / np.sqrt(gb)
    i, x, starts, _ = packed(held)
    raw, y = model.raw(i, x, starts), label[held].astype(float)
    a, b = 1.0, 0.0
    for _ in range(300):  # a small logistic regression on one input, damped towards (1, 0)
        p = 1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30)))
        a -= 0.05 * (((p - y) * raw).mean() + 0.01 * (a - 1))
        b -= 0.05 * ((p - y).mean() + 0.01 * b)
    model.scale, model.shift = max(a, 0.05), b
    return model


def remainder(id_col: str = "doc_id", folds: int = 5):
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def featurised(docs: DataFrame, carry: list[str], text_col: str, metadata: tuple[str, ...]) -> DataFrame:
    named = docs.select(*carry, text_of(text_col).alias("_text"), *[F.col(c).cast("string").alias(f"_m_{c}") for c in metadata])

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        metas = zip(*[batch.column(f"_m_{c}").to_pylist() for c in metadata]) if metadata else [()] * batch.num_rows
        found = [features(t, tuple(zip(metadata, m))) for t, m in zip(batch.column("_text").to_pylist(), metas)]
        return rows(
            **{c: batch.column(c) for c in carry},
            idx=pa.array([f[0] for f in found], pa.list_(pa.int32())),
            val=pa.array([f[1] for f in found], pa.list_(pa.float32())),
        )

    types = dict(named.dtypes)
    return mapped(named, each, ", ".join(f"{c} {types[c]}" for c in carry) + ", " + FEATURES)


def train(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
    metadata: tuple[str, ...] = (), max_rows: int = 6000, folds: int = 5,
) -> Machine:
    """Fit on labelled rows whose id is in a training fold, ``max_rows`` of them at most.

    The bound is the documented size of the training sample: of the different (id, label)
    pairs those with the lowest hashes are taken, then of the different texts that have
    them, so the sample is the same on every run and spread over the whole table, and ids
    or rows that repeat, however often, cannot make it larger.  Only the sample's features
    reach the driver.  Rows with a NULL id or label teach nothing; equal rows count once.
    """
    usable = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (remainder(id_col, folds) != 0))
    usable = usable.select(F.col(id_col).cast("long").alias("_id"), (F.col(label_col) == 1).cast("int").alias("_label"))
    sample = F.broadcast(usable.distinct().orderBy(F.xxhash64("_id"), "_id", "_label").limit(max_rows))
    text = text_of(text_col)
    plain = docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(text, *metadata).alias("_h"), text.alias("text"), *metadata)
    keys = ["_id", "_label", "_h"]
    found = plain.join(sample, "_id")
    few = F.broadcast(found.select(*keys).distinct().orderBy(F.xxhash64("_id", "_h"), *keys).limit(max_rows))
    found = featurised(found.join(few, keys).dropDuplicates(keys), keys, "text", metadata).toArrow()
    found = found.sort_by([(c, "ascending") for c in keys])
    idx = [np.asarray(x.values) for x in found.column("idx")]
    val = [np.asarray(x.values) for x in found.column("val")]
    return fit(idx, val, found.column("_label").to_numpy().astype(np.int64))


def score(
    docs: DataFrame, model: Machine, text_col: str = "text", metadata: tuple[str, ...] = ()
) -> DataFrame:
    """``docs`` plus ``_score``, the probability of label 1, from the whole text.

    NULL text counts as empty; an empty text is scored by its structure alone.  Equal
    texts and metadata score equally.  Columns of ``docs`` pass through, whatever they are called.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size: BUCKETS * (RANK + 1) floats
    columns = [f"_c{k}" for k in range(len(docs.columns))]
    renamed = docs.toDF(*columns)
    at = {c: columns[k] for k, c in enumerate(docs.columns)}
    inputs = renamed.select(
        *columns, text_of(at[text_col]).alias("_text"),
        *[F.col(at[c]).cast("string").alias(f"_m_{c}") for c in metadata],
    )

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        machine = shared.value
        metas = zip(*[batch.column(f"_m_{c}").to_pylist() for c in metadata]) if metadata else [()] * batch.num_rows
        out, some = [], []

        def flush():
            if some:
                sizes = [len(i) for i, _ in some]
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                raw = machine.raw(np.concatenate([i for i, _ in some]), np.concatenate([x for _, x in some]), starts)
                out.append(machine.score(raw))
                some.clear()

        held = 0
        for text, meta in zip(batch.column("_text").to_pylist(), metas):
            some.append(features(text, tuple(zip(metadata, meta))))
            held += len(some[-1][0])
            if held > 200_000:
                flush()
                held = 0
        flush()
        return rows(**{c: batch.column(c) for c in columns}, _score=np.concatenate(out).astype(np.float64))

    schema = ", ".join(f"{c} {t}" for c, t in inputs.dtypes if c in columns)
    return mapped(inputs, each, schema + ", _score double").toDF(*docs.columns, "_score")
