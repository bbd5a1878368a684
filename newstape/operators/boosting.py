"""Gradient boosting of decision trees over histograms, with a softmax over all classes.

Features are binned once at quantiles, one byte each; missing values (NULL, NaN,
infinite) have a bin of their own, and every split learns which side they go to.  Rows
lie in blocks, a written table.  A round grows one tree per class, level by level: one
pass over the blocks sums the gradients and hessians by node, feature and bin for all
classes; a task, whose input is these sums and so of fixed size, picks the splits, and the
driver sees only the splits.  Of two siblings the lighter one is summed, the other is what
remains of their parent.  The sums are whole
numbers, so they do not depend on the order of blocks or on retries.  Margins are written
with the blocks every few rounds; between, tasks add the newest trees.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession, functions as F

from newstape.errors import DataPreparationError
from newstape.session import fresh_path, remove

#: rows of a block, and of a partition of many
BLOCK, PARTITION = 8_192, 262_144
#: the bin of missing values
MISSING = 255
#: rounds whose trees tasks add up before margins are written again
ROUNDS = 25
#: gradients and hessians are summed in units of one in so many
UNIT = float(1 << 24)
#: rounds without a better held-out loss after which training stops, where rows are held back
PATIENCE = 10


def finite(name: str):
    """A feature column where everything missing is NULL."""
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value) & ~value.isin(float("inf"), float("-inf")), value)


def quantile_cuts(rows: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """Up to ``bins - 1`` cuts of each feature; bin k holds values from cut k - 1 up to below cut k."""
    shares = [k / bins for k in range(1, bins)]
    found = rows.select(*[finite(c).alias(c) for c in features]).approxQuantile(list(features), shares, 0.25 / bins)
    return [np.unique(np.array(cuts, np.float64)) for cuts in found]


def binned(values: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Bins of a matrix of values (NaN where missing)."""
    out = np.empty(values.shape, np.uint8)
    for f, edges in enumerate(cuts):
        out[:, f] = np.searchsorted(edges, values[:, f], "right")
    out[~np.isfinite(values)] = MISSING
    return out


@dataclass
class Trees:
    """Binary trees of equal depth: node k has the children 2k + 1 (left) and 2k + 2; a first axis numbers the trees."""

    feature: np.ndarray  # -1 where a node is not split
    cut: np.ndarray  # bins up to this one go left
    missing_left: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, number: int, depth: int) -> "Trees":
        shape = (number, (2 << depth) - 1)
        return cls(np.full(shape, -1, np.int16), np.zeros(shape, np.uint8), np.zeros(shape, bool), np.zeros(shape), np.zeros(shape))

    def __len__(self) -> int:
        return len(self.feature)

    @classmethod
    def joined(cls, parts: Sequence["Trees"]) -> "Trees":
        return cls(*(np.concatenate([getattr(p, c) for p in parts]) for c in ("feature", "cut", "missing_left", "value", "gain")))

    def node(self, tree: int, x: np.ndarray) -> np.ndarray:
        """The node where each row of bins ends."""
        feature, cut, left = self.feature[tree], self.cut[tree], self.missing_left[tree]
        at = np.zeros(len(x), np.int64)
        each = np.arange(len(x))
        for _ in range((len(feature) + 1).bit_length() - 2):
            f = feature[at]
            if (f < 0).all():
                break
            bins = x[each, f]
            goes_left = np.where(bins == MISSING, left[at], bins <= cut[at])
            at = np.where(f < 0, at, 2 * at + 2 - goes_left)
        return at

    def part(self, first: int) -> "Trees":
        return Trees(self.feature[first:], self.cut[first:], self.missing_left[first:], self.value[first:], self.gain[first:])

    def add(self, margin: np.ndarray, x: np.ndarray) -> None:
        """Add what the trees say to the margins; trees of the classes take turns."""
        for tree in range(len(self)):
            margin[:, tree % margin.shape[1]] += self.value[tree][self.node(tree, x)]


def softmax(margin: np.ndarray) -> np.ndarray:
    e = np.exp(margin - margin.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def drawn(block: int, n: int, seed: int, turn: int) -> np.ndarray:
    """A number in [0, 1) per row of a block and turn, the same on every retry."""
    key = np.uint64((block * 0x9E3779B97F4A7C15 + seed * 0xD1B54A32D192ED03 + turn * 0x8CB92BA72F3D8DD7) % (1 << 64))
    return (_mixed(np.arange(n, dtype=np.uint64) + key) >> np.uint64(11)) / float(1 << 53)


BLOCKS = "block long, n int, x binary, y binary, margin binary"


def blocks_of(rows: DataFrame, features: Sequence[str], label: str, cuts: Sequence[np.ndarray], classes: int) -> DataFrame:
    """Rows with a class number as blocks of bins, classes and zero margins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        held, n = [], 0

        def out():
            x, y = (np.concatenate(p) for p in zip(*held))
            columns = [[(part << 32) + number], [len(x)], [x.tobytes()], [y.tobytes()], [np.zeros((len(x), classes)).tobytes()]]
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["block", "n", "x", "y", "margin"])

        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK):
                some = batch.slice(low, BLOCK)
                values = np.stack([some.column(f"f{k}").to_numpy(zero_copy_only=False) for k in range(len(cuts))], 1)
                held.append((binned(values.astype(np.float64), cuts), some.column("y").to_numpy(zero_copy_only=False).astype(np.uint8)))
                n += some.num_rows
                if n >= BLOCK:
                    yield out()
                    held, n, number = [], 0, number + 1
        if held:
            yield out()

    inputs = rows.select(*[finite(c).alias(f"f{k}") for k, c in enumerate(features)], F.col(label).alias("y"))
    n = rows.count()
    # a histogram comes from every partition, so small inputs have few
    return inputs.repartition(max(1, min(4, -(-n // BLOCK)), -(-n // PARTITION))).mapInArrow(run, BLOCKS)


def _unpacked(row, classes: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    x = np.frombuffer(row.x, np.uint8).reshape(row.n, -1)
    return row.block, x, np.frombuffer(row.y, np.uint8), np.frombuffer(row.margin).reshape(row.n, classes)


def _written(blocks: DataFrame, newest: Trees | None, classes: int) -> tuple[DataFrame, str]:
    """The blocks with the newest trees added to their margins, as a table of its own."""
    spark = blocks.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for n, x, margin in zip(*(batch.column(c).to_pylist() for c in ("n", "x", "margin"))):
                margin = np.frombuffer(margin).reshape(n, classes).copy()
                newest.add(margin, np.frombuffer(x, np.uint8).reshape(n, -1))
                out.append(margin.tobytes())
            at = batch.schema.get_field_index("margin")
            yield batch.set_column(at, "margin", pa.array(out, pa.binary()))

    path = fresh_path(spark, "blocks")
    (blocks.mapInArrow(run, BLOCKS) if newest else blocks).write.parquet(path)
    return spark.read.schema(BLOCKS).parquet(path), path


@dataclass
class Settings:
    trees: int = 300
    depth: int = 6
    learning_rate: float = 0.05
    row_share: float = 0.8
    feature_share: float = 0.8
    bins: int = 64
    l2: float = 1.0
    min_child_weight: float = 1.0
    seed: int = 42
    validation_share: float = 0.0
    validation_tolerance: float = 0.0


def best_splits(sums: np.ndarray, s: Settings) -> tuple[np.ndarray, ...]:
    """Of each node: gain, feature, cut, and whether missing values go left.

    ``sums``: gradients and hessians by (node, feature, bin, 2), missing values in the last
    bin.  Of equal gains the first feature, missing values right, and the lowest cut win.
    """
    seen, lost = sums[:, :, :-1], sums[:, :, -1:]
    left = np.cumsum(seen, 2)
    whole = left[:, :, -1:] + lost
    both = np.stack([left, left + lost], 2)  # missing right, missing left
    rest = whole[:, :, None] - both
    score = lambda p: p[..., 0] ** 2 / (p[..., 1] + s.l2)
    gain = score(both) + score(rest) - score(whole[:, :, None])
    gain = np.where((both[..., 1] >= s.min_child_weight) & (rest[..., 1] >= s.min_child_weight), gain, -np.inf)
    n, features, sides, bins = gain.shape
    gain = gain.reshape(n, -1)
    best = gain.argmax(1)
    feature, rest_of = np.divmod(best, sides * bins)
    side, cut = np.divmod(rest_of, bins)
    return gain[np.arange(n), best], feature, cut, side == 1


#: margins that this worker has brought up to date: block -> (rounds added, margins); of one written table at a time
_margins: dict = {}


def _margin(table: str, block: int, margin: np.ndarray, x: np.ndarray, newest: Trees | None) -> np.ndarray:
    """The margins of a block with the newest trees; only those are added that this worker has not added before."""
    if _margins.get("table") != table or len(_margins) > 256:
        _margins.clear()
        _margins["table"] = table
    added, held = _margins.get(block, (0, margin))
    if newest and len(newest) > added:
        held = held.copy()
        newest.part(added).add(held, x)
        _margins[block] = (len(newest), held)
    elif added > (len(newest) if newest else 0):  # a task of an earlier round that runs again
        held = margin.copy()
        if newest:
            newest.add(held, x)
    return held


def level_splits(blocks, table: str, newest: Trees | None, growing: Trees, wanted: np.ndarray, chosen: np.ndarray, turn: int, s: Settings, parents):
    """A persisted row with the sums of a level over all rows, for the level below, and what was picked from them.

    The sums are by (class, node, chosen feature, bin), in whole numbers.  Picked are, of each
    class, the root's gradient and hessian and, of each node that is split, its place in
    the level, gain, feature, cut, whether missing values go left, and both of either
    child; and the held-out loss.  ``wanted``: for each class and node of the level, its place among
    the sums, or -1; ``chosen``: the features of each class; ``parents``: the row of the level above.
    """
    classes, nodes = wanted.shape
    first, places = nodes - 1, int(wanted.max()) + 1
    features, width = chosen.shape[1], s.bins + 1

    def of_block(row) -> tuple[np.ndarray, np.ndarray]:
        block, x, y, margin = _unpacked(row, classes)
        p = softmax(_margin(table, block, margin, x, newest))
        loss = np.zeros(2)
        keep = drawn(block, len(x), s.seed, turn + 1) < s.row_share
        if s.validation_share:
            held = drawn(block, len(x), s.seed, 0) < s.validation_share
            loss[:] = -np.log(np.maximum(p[held, y[held]], 1e-16)).sum(), held.sum()
            keep &= ~held
        x, y, p = x[keep], y[keep], p[keep]
        out = np.zeros((classes, places * features * width, 2), np.int64)
        for c in range(classes):
            at = growing.node(c, x) - first
            place = np.where(at < 0, -1, wanted[c][np.maximum(at, 0)])  # rows that end above this level have none
            here = np.flatnonzero(place >= 0)
            g = np.rint((p[here, c] - (y[here] == c)) * UNIT)
            h = np.rint(np.maximum(2 * p[here, c] * (1 - p[here, c]), 1e-16) * UNIT)
            slot = np.minimum(x[here][:, chosen[c]], s.bins).astype(np.int32)  # missing values are in the last bin
            slot += np.arange(features, dtype=np.int32) * width + place[here, None].astype(np.int32) * (features * width)
            slot = slot.ravel()
            for k, w in enumerate((g, h)):
                out[c, :, k] = np.bincount(slot, np.repeat(w, features), out.shape[1])
        return out, loss

    def of_blocks(rows) -> Iterator[tuple]:
        sums = loss = None
        for row in rows:
            one = of_block(row)
            sums, loss = one if sums is None else (sums + one[0], loss + one[1])
        if sums is not None:
            yield 0, (sums, loss, None)

    def join(a, b):
        both = lambda x, y: y if x is None else x if y is None else x + y
        return tuple(both(x, y) for x, y in zip(a, b))

    def finished(found) -> tuple[np.ndarray, np.ndarray]:
        """The sums of all nodes whose parent was split: of two siblings one was summed."""
        summed, loss, above = found[1]
        summed = summed.reshape(classes, places, features, width, 2)
        sums = np.zeros((classes, nodes, features, width, 2), np.int64)
        for c in range(classes):
            for k in np.flatnonzero(wanted[c] >= 0).tolist():
                sums[c, k] = summed[c, wanted[c, k]]
                if above is not None:
                    sums[c, k ^ 1] = above[c, k >> 1] - sums[c, k]
        return sums, loss

    def picked(whole) -> tuple[list, np.ndarray]:
        out = []
        for sums in whole[0]:
            exact = sums / UNIT
            gain, feature, cut, missing_left = best_splits(exact, s)
            splits = []
            for k in np.flatnonzero(gain > 1e-6).tolist():
                mine = exact[k, feature[k]]
                left = mine[: cut[k] + 1].sum(0) + missing_left[k] * mine[-1]
                splits.append((k, float(gain[k]), int(feature[k]), int(cut[k]), bool(missing_left[k]), left, mine.sum(0) - left))
            out.append((exact[0, 0].sum(0), splits))
        return out, whole[1]

    rows = blocks.mapPartitions(of_blocks)
    if parents is not None:
        rows = rows.union(parents.map(lambda whole: (0, (None, None, whole[0]))))
    whole = rows.reduceByKey(join, 1).map(finished).persist(StorageLevel.MEMORY_AND_DISK)
    return whole, whole.map(picked).collect()[0]


def grow(rows: DataFrame, features: Sequence[str], label: str, classes: int, s: Settings) -> tuple[Trees, list[np.ndarray]]:
    """All trees (those of a round next to each other, one per class) and the cuts of the features.

    ``label`` holds class numbers from 0; rows without one are left out.
    """
    if not 2 <= s.bins < MISSING:
        raise ValueError(f"2 to {MISSING - 1} bins")
    rows = rows.where(F.col(label).isNotNull())
    cuts = quantile_cuts(rows, features, s.bins)
    table, path = _written(blocks_of(rows, features, label, cuts, classes), None, classes)
    if table.isEmpty():
        raise DataPreparationError("no labelled rows to train on")
    random = np.random.default_rng(s.seed)
    some = max(1, round(s.feature_share * len(features)))
    rounds: list[Trees] = []
    kept = best_loss = None
    blocks = table.rdd.persist(StorageLevel.MEMORY_AND_DISK)
    for turn in range(s.trees):
        if turn and turn % ROUNDS == 0:
            blocks.unpersist()
            newer, newer_path = _written(table, Trees.joined(rounds[-ROUNDS:]), classes)
            remove(rows.sparkSession, path)
            table, path = newer, newer_path
            blocks = table.rdd.persist(StorageLevel.MEMORY_AND_DISK)
        newest = Trees.joined(rounds[turn - turn % ROUNDS :]) if turn % ROUNDS else None
        chosen = np.stack([np.sort(random.choice(len(features), some, replace=False)) for _ in range(classes)])
        growing = Trees.empty(classes, s.depth)
        wanted = np.zeros((classes, 1), np.int64)
        parents = None  # sums of the level above
        for level in range(s.depth):
            sums, (found, loss) = level_splits(blocks, path, newest, growing, wanted, chosen, turn, s, parents)
            if parents is not None:
                parents.unpersist()
            parents = sums
            if not level and s.validation_share and loss[1]:
                now = loss[0] / loss[1]
                if best_loss is None or now < best_loss - s.validation_tolerance:
                    best_loss, kept = now, turn
            nodes = 1 << level
            below = np.full((classes, 2 * nodes), -1)
            for c, (root, splits) in enumerate(found):
                if not level:
                    growing.value[c, 0] = _leaf(root, s)
                for number, (k, gain, feature, cut, missing_left, left, right) in enumerate(splits):
                    at = nodes - 1 + k
                    growing.feature[c, at], growing.cut[c, at] = chosen[c, feature], cut
                    growing.missing_left[c, at], growing.gain[c, at] = missing_left, gain
                    growing.value[c, 2 * at + 1], growing.value[c, 2 * at + 2] = _leaf(left, s), _leaf(right, s)
                    below[c, 2 * k + (right[1] < left[1])] = number  # the lighter child
            wanted = below
            if (below < 0).all():
                break
        parents.unpersist()
        if best_loss is not None and turn - kept > PATIENCE:
            break
        rounds.append(growing)
    blocks.unpersist()
    remove(rows.sparkSession, path)
    if best_loss is not None:
        rounds = rounds[: max(1, kept)]
    return Trees.joined(rounds), cuts


def _leaf(sums: np.ndarray, s: Settings) -> float:
    return float(-s.learning_rate * sums[0] / (sums[1] + s.l2))


class _Shared(Params):
    featureNames = Param(Params._dummy(), "featureNames", "feature columns", TypeConverters.toListString)
    labelCol = Param(Params._dummy(), "labelCol", "column of class numbers", TypeConverters.toString)
    probabilityCol = Param(Params._dummy(), "probabilityCol", "column of class probabilities", TypeConverters.toString)
    classCount = Param(Params._dummy(), "classCount", "number of classes", TypeConverters.toInt)


class SoftmaxBooster(Estimator, _Shared, MLWritable, MLReadable):
    """Estimator of :class:`SoftmaxBoosterModel`; ``settings`` holds fields of :class:`Settings` as JSON."""

    settings = Param(Params._dummy(), "settings", "training settings as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featureNames=None, labelCol="label", probabilityCol="probability", classCount=3, settings="{}"):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        for name, value in (("labelCol", labelCol), ("probabilityCol", probabilityCol), ("classCount", classCount), ("settings", settings)):
            self._set(**{name: value})

    def _fit(self, dataset: DataFrame) -> "SoftmaxBoosterModel":
        s = Settings(**json.loads(self.getOrDefault("settings")))
        trees, cuts = grow(dataset, self.getOrDefault("featureNames"), self.getOrDefault("labelCol"), self.getOrDefault("classCount"), s)
        model = SoftmaxBoosterModel(trees, cuts)
        names = ("featureNames", "labelCol", "probabilityCol", "classCount")
        return model._set(**{n: self.getOrDefault(n) for n in names})

    def write(self) -> MLWriter:
        return DefaultParamsWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return DefaultParamsReader(cls)


class SoftmaxBoosterModel(Model, _Shared, MLWritable, MLReadable):
    """Fitted trees; ``transform`` adds an array of class probabilities."""

    def __init__(self, trees: Trees | None = None, cuts: list[np.ndarray] | None = None):
        super().__init__()
        self.trees, self.cuts = trees, cuts

    @property
    def rounds(self) -> int:
        return len(self.trees) // self.getOrDefault("classCount")

    @property
    def importances(self) -> np.ndarray:
        """Mean gain of a feature's splits, as a share of the sum over the features."""
        split = self.trees.feature >= 0
        at, gain = self.trees.feature[split], self.trees.gain[split]
        size = len(self.getOrDefault("featureNames"))
        mean = np.bincount(at, gain, size) / np.maximum(np.bincount(at, minlength=size), 1)
        return mean / (mean.sum() or 1.0)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        classes, names = self.getOrDefault("classCount"), self.getOrDefault("featureNames")
        shared = dataset.sparkSession.sparkContext.broadcast((self.trees, self.cuts))

        @F.pandas_udf("array<double>")
        def probabilities(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            trees, cuts = shared.value
            for columns in batches:
                margin = np.zeros((len(columns[0]), classes))
                trees.add(margin, binned(np.stack([c.to_numpy(np.float64) for c in columns], 1), cuts))
                yield pd.Series(list(softmax(margin)))

        return dataset.withColumn(self.getOrDefault("probabilityCol"), probabilities(*[finite(c) for c in names]))

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


class _ModelWriter(MLWriter):
    """Parameters as Spark ML writes them; the trees and cuts as two small Parquet tables."""

    def __init__(self, model: SoftmaxBoosterModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark = SparkSession.active()
        DefaultParamsWriter.saveMetadata(self.model, path, spark.sparkContext)
        t = self.model.trees
        kinds = {"feature": "array<int>", "cut": "array<int>", "missing_left": "array<boolean>", "value": "array<double>", "gain": "array<double>"}
        trees = [(k, *(getattr(t, c)[k].tolist() for c in kinds)) for k in range(len(t))]
        schema = "tree int, " + ", ".join(f"{c} {k}" for c, k in kinds.items())
        spark.createDataFrame(trees, schema).coalesce(1).write.parquet(f"{path}/trees")
        cuts = [(k, c.tolist()) for k, c in enumerate(self.model.cuts)]
        spark.createDataFrame(cuts, "feature int, cuts array<double>").coalesce(1).write.parquet(f"{path}/cuts")


class _ModelReader(MLReader):
    def load(self, path: str) -> SoftmaxBoosterModel:
        spark = SparkSession.active()
        rows = spark.read.parquet(f"{path}/trees").orderBy("tree").collect()
        column = lambda c, kind: np.array([r[c] for r in rows], kind)
        trees = Trees(column("feature", np.int16), column("cut", np.uint8), column("missing_left", bool), column("value", float), column("gain", float))
        cuts = [np.array(r.cuts, float) for r in spark.read.parquet(f"{path}/cuts").orderBy("feature").collect()]
        model = SoftmaxBoosterModel(trees, cuts)
        metadata = DefaultParamsReader.loadMetadata(path, spark.sparkContext)
        DefaultParamsReader.getAndSetParams(model, metadata)
        model._resetUid(metadata["uid"])
        return model
