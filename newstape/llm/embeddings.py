"""Embedding near-duplicates by an inverted multi-index.

Unit vectors are cut in halves; each half has a codebook of its own and the pairs of
nearest centroids form a product grid of cells.  A vector visits cells in the order of
a lower bound of its distance to anything in them: from each half the distance to the
plane midway between its own centroid and the cell's, the squares added.  The traversal
stops where the bound passes the squared radius of the wanted cosine, which no linked
vector can lie beyond, so target recall 1 is exact; a lower target stops earlier, at
a radius measured on sample pairs.  What is met in a visited cell is verified by cosine.

Equal vectors are one node with a weight.  Cells with many vectors are split, and a
visitor goes to each split, so no task holds more than a block of a cell.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newstape.llm.common import longs, mapped, rows, stage
from newstape.llm.components import components, roots

#: vectors the codebooks are fitted on, at most, and bytes of them that come to the driver
SAMPLE, SAMPLE_BYTES = 4096, 32 << 20
#: vectors of a cell that one split holds, about
SPLIT = 1024
FEWEST = 4


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one in double precision; none is zero."""
    v = vectors.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def k_means(points: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    random = np.random.default_rng(seed)
    centres = points[random.choice(len(points), k, replace=False)]
    for _ in range(rounds):
        near = nearest(points, centres)[0]
        counts = np.bincount(near, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        full = counts > 0
        centres[full] = sums[full] / counts[full, None]
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each point, and all squared distances."""
    d = (points**2).sum(1)[:, None] + (centres**2).sum(1)[None, :] - 2 * points @ centres.T
    return d.argmin(axis=1), np.maximum(d, 0)


@dataclass
class MultiIndex:
    """Codebooks of the two halves, and the squared radius of the traversal."""

    first: np.ndarray
    second: np.ndarray
    reach: float

    @property
    def cells(self) -> int:
        return len(self.first) * len(self.second)

    def _half(self, points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own, d = nearest(points, centres)
        apart = np.sqrt(nearest(centres, centres)[1])[own]
        gain = d - d[np.arange(len(points)), own][:, None]
        plane = np.divide(gain, 2 * apart, out=np.zeros_like(gain), where=apart > 0)
        return own, plane**2

    def bounds(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Own cells, and the squared distances to every cell's side of each half's planes."""
        h = units.shape[1] // 2
        own1, plane1 = self._half(units[:, :h], self.first)
        own2, plane2 = self._half(units[:, h:], self.second)
        return own1 * len(self.second) + own2, plane1, plane2

    def visits(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Own cells, and (vector, cell) for every visit, nearest cells first.

        The sequences of both halves are sorted; of the first's k-th centroid the
        traversal takes those of the second whose bounds still add up to less than the
        reach, which is the frontier of a multi-sequence search.
        """
        own, plane1, plane2 = self.bounds(units)
        order1, order2 = plane1.argsort(axis=1, kind="stable"), plane2.argsort(axis=1, kind="stable")
        sorted1, sorted2 = np.take_along_axis(plane1, order1, 1), np.take_along_axis(plane2, order2, 1)
        who, cell = [], []
        for k in range(sorted1.shape[1]):
            left = self.reach - sorted1[:, k]
            live = np.flatnonzero(left >= 0)
            if not len(live):
                break
            take = (sorted2[live] <= left[live, None]).sum(axis=1)
            v = np.repeat(live, take)
            nth = np.arange(len(v)) - np.repeat(np.cumsum(take) - take, take)
            who.append(v)
            cell.append(order1[v, k] * len(self.second) + order2[v, nth])
        return own, np.concatenate(who), np.concatenate(cell)


def fit_index(sample: np.ndarray, per_label: float, cosine: float, recall: float = 1.0) -> MultiIndex:
    """Codebooks on a sample of vectors, of the size that makes visits and comparisons cheapest for ``per_label``."""
    units = unit(sample)
    h = units.shape[1] // 2
    radius = 2 - 2 * cosine
    probe = units[:: max(1, len(units) // 256)]
    best, least = None, np.inf
    k = FEWEST
    while k <= max(FEWEST, len(units) // 8):
        k = min(k, len(units))
        index = MultiIndex(k_means(units[:, :h], k), k_means(units[:, h:], k, seed=4), radius + 1e-9)
        met = len(index.visits(probe)[1]) / len(probe)
        cost = met * (1 + per_label / index.cells / SPLIT)  # a row sent, and its share of a block product
        if cost < least:
            best, least = index, cost
        elif cost > 4 * least:
            break
        k *= 2
    if recall < 1:
        near = units @ units.T
        a, b = np.nonzero(np.triu(near >= cosine, 1))
        if len(a):
            own, plane1, plane2 = best.bounds(units)
            other = own[b]
            need = plane1[a, other // len(best.second)] + plane2[a, other % len(best.second)]
            best.reach = min(best.reach, float(np.quantile(need, recall)))
    return best


def matrix(column: pa.Array) -> np.ndarray:
    values = np.asarray(column.flatten())
    return values.reshape(len(column), -1)


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``_vec``, ``_label``, ``_e``, ``_good`` and ``_node`` of every row; a node is a label and a vector's values."""
    e = F.col(vector_col).cast("array<double>")
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(e, lambda x: x != 0)
    good = F.coalesce(F.col(label_col).isNotNull() & (F.size(e) > 0) & fine & some, F.lit(False))
    return vectors.select(
        F.col(id_col).cast("long").alias("_vec"), F.col(label_col).cast("string").alias("_label"), e.alias("_e"),
        good.alias("_good"), F.when(good, F.xxhash64(F.col(label_col).cast("string"), e)).alias("_node"),
    )


NODE = "_label string, dim int, _node long, _e array<double>, weight long"
MET = "node long, links long, root long"


def _blocks(cosine: float):
    """Streams the splits of cells: residents first, then their visitors in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = None
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        home: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
        counted: np.ndarray | None = None

        def close():
            if home is not None and counted is not None and counted.any():
                some = counted > 0
                yield rows(node=home[0][some], links=counted[some], root=home[0][some])

        def compare(node, weight, units, local):
            nonlocal counted
            near = units @ home[2].T >= cosine
            near &= node[:, None] != home[0][None, :]
            if not near.any():
                return
            links = near @ home[1]
            counted += np.where(local[:, None], False, near).T.astype(np.int64) @ weight  # both directions but at home
            total = int(near.sum())
            if total < 50_000:
                a, b = np.nonzero(near)
                nodes, top = roots(node[a], home[0][b])
            else:
                label = home[0].copy()
                big = np.int64(2**63 - 1)
                while True:  # smallest label on both sides until nothing moves
                    mine = np.minimum(np.where(near, label[None, :], big).min(axis=1), node)
                    theirs = np.minimum(label, np.where(near, mine[:, None], big).min(axis=0))
                    if (theirs == label).all():
                        break
                    label = theirs
                touched = near.any(axis=1)
                met = near.any(axis=0)
                nodes = np.concatenate([node[touched], home[0][met]])
                top = np.concatenate([mine[touched], label[met]])
            some = links > 0
            yield rows(
                node=np.concatenate([node[some], nodes]), links=np.concatenate([links[some], np.zeros(len(nodes), np.int64)]),
                root=np.concatenate([node[some], top]),
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            block = longs(batch.column("block"))
            role = longs(batch.column("role"))
            node, weight = longs(batch.column("_node")), longs(batch.column("weight"))
            units = batch.column("_e")
            cuts = np.flatnonzero((block[1:] != block[:-1]) | ((role[1:] == 0) != (role[:-1] == 0))) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(block)]):
                if block[lo] != key:
                    yield from close()
                    key, held, home, counted = block[lo], [], None, None
                part = (node[lo:hi], weight[lo:hi], unit(matrix(units.slice(lo, hi - lo))))
                if role[lo] == 0:
                    held.append(part)
                elif held or home is not None:
                    if home is None:
                        home = tuple(np.concatenate(x) for x in zip(*held))
                        held, counted = [], np.zeros(len(home[0]), np.int64)
                    yield from compare(*part, role[lo:hi] == 1)
        yield from close()

    return run


def linked(
    vectors: DataFrame, cosine: float = 0.98, recall: float = 1.0, id_col: str = "vec_id", vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for every row of ``vectors``.

    Rows link when their labels are equal and not NULL, their vectors have equal
    lengths, and their cosine in double precision is at least ``cosine``.  Vectors that
    are NULL, empty, zero or hold NULL or non-finite components link with nothing.  Every
    row counts, repeats too: ``n_links`` is the number of other rows linked directly.
    ``component_id`` is the smallest id reachable by links; a NULL id never names a
    component that has another.
    """
    known = usable(vectors, id_col, vector_col, label_col)
    nodes = known.where("_good").groupBy("_label", F.size("_e").alias("dim"), "_node").agg(
        F.first("_e").alias("_e"), F.count(F.lit(1)).alias("weight")
    )
    nodes = stage(nodes, "vectors")
    size = nodes.agg(F.count(F.lit(1)).alias("n"), F.max("dim").alias("dim"), F.count_distinct("_label").alias("labels")).first()
    spark = vectors.sparkSession
    found = None
    if size["n"]:
        most = max(64, min(SAMPLE, SAMPLE_BYTES // (8 * size["dim"])))
        share = min(1.0, most / size["n"])
        drawn = nodes.where(F.pmod(F.xxhash64("_node"), F.lit(1 << 30)) < int(share * (1 << 30)))
        drawn = drawn.select("dim", "_e").limit(2 * most).toArrow()  # a sample of bounded size, for the codebooks alone
        indexes: dict[int, MultiIndex] = {}
        dims = drawn.column("dim").to_numpy()
        for dim in set(dims.tolist()):
            some = drawn.column("_e").combine_chunks().filter(pa.array(dims == dim))
            if dim > 1 and len(some) >= 8 * FEWEST:
                indexes[dim] = fit_index(matrix(some), size["n"] / size["labels"], cosine, recall)
        shared = spark.sparkContext.broadcast(indexes)  # codebooks: at most a part of the sample

        def homes(batch: pa.RecordBatch) -> pa.RecordBatch:
            return _placed(batch, shared.value, visits=False)

        def visitors(batch: pa.RecordBatch) -> pa.RecordBatch:
            return _placed(batch, shared.value, visits=True)

        at = "_label string, dim int, cell long, _node long, _e array<double>, weight long, role int"
        resident = mapped(nodes, homes, at)
        visiting = mapped(nodes, visitors, at)
        cell = ["_label", "dim", "cell"]
        counts = mapped(nodes.drop("weight").withColumn("weight", F.lit(1).cast("long")), homes, at)
        splits = counts.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / SPLIT).cast("int").alias("splits"))
        resident = resident.join(splits, cell).withColumn("split", F.pmod(F.xxhash64("_node", F.lit(1)), "splits").cast("int"))
        visiting = visiting.join(splits, cell).withColumn("split", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)))
        dealt = resident.unionByName(visiting).withColumn("block", F.xxhash64(*cell, "split"))
        dealt = dealt.select("block", "role", "_node", "weight", "_e").repartition("block").sortWithinPartitions("block", "role")
        met = stage(dealt.mapInArrow(_blocks(cosine), MET), "met")
        links = met.groupBy("node").agg(F.sum("links").alias("links"))
        found = components(met.select(F.col("node").alias("u"), F.col("root").alias("v")))
        own = known.where("_good").groupBy("_node").agg(F.min("_vec").alias("low"), F.count(F.lit(1)).alias("copies"))
        rooted = own.join(found.select(F.col("node").alias("_node"), "root"), "_node", "left")
        rooted = rooted.join(links.withColumnRenamed("node", "_node"), "_node", "left")
        rooted = rooted.withColumns({
            "root": F.coalesce("root", "_node"), "n_links": F.coalesce("links", F.lit(0)) + F.col("copies") - 1,
        })
        lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
        named = stage(rooted.join(lows, "root").select("_node", "n_links", "component_id"), "classes")
        out = known.select("_vec", "_node", "_good").join(named, "_node", "left")
    else:
        nothing = F.lit(None).cast("long")
        out = known.select("_vec", "_good", nothing.alias("n_links"), nothing.alias("component_id"))
    component = F.when(F.col("_good"), F.col("component_id")).otherwise(F.col("_vec"))
    return out.select(
        F.col("_vec").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("_vec") == component, F.lit(False)).alias("kept"),
    )


def _placed(batch: pa.RecordBatch, indexes: dict[int, MultiIndex], visits: bool) -> pa.RecordBatch:
    """Residents (role 0) in their own cell, or visitors: at home (role 1) and to cells of higher number (role 2).

    Of two linked vectors in different cells the one in the lower cell visits the other's.
    """
    dims = longs(batch.column("dim"))
    who, cell, role = [], [], []
    for dim in set(dims.tolist()):
        some = np.flatnonzero(dims == dim)
        index = indexes.get(dim)
        if index is None:
            who.append(some)
            cell.append(np.zeros(len(some), np.int64))
            role.append(np.full(len(some), int(visits)))
            continue
        units = unit(matrix(batch.column("_e").take(pa.array(some))))
        if not visits:
            who.append(some)
            cell.append(index.bounds(units)[0])
            role.append(np.zeros(len(some), np.int64))
            continue
        own, v, c = index.visits(units)
        up = c >= own[v]
        who.append(some[v[up]])
        cell.append(c[up])
        role.append(np.where(c[up] == own[v[up]], 1, 2))
    pick = pa.array(np.concatenate(who))
    return rows(
        **{c: batch.column(c).take(pick) for c in ("_label", "dim")}, cell=np.concatenate(cell).astype(np.int64),
        **{c: batch.column(c).take(pick) for c in ("_node", "_e", "weight")}, role=np.concatenate(role).astype(np.int32),
    )
