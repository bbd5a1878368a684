"""Connected components of a link table, without collecting links or components anywhere.

Each round points every node at its smallest neighbour, jumps along those pointers,
and contracts the links to the nodes pointed at; a table per round holds the pointers
and the labels are their composition.  Tasks first shrink the links they hold to a
spanning forest, so what is shuffled is at most one link per node and task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newstape.llm.common import longs, rows, stage

#: links a task contracts at a time
CHUNK = 1_000_000


def roots(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and the smallest node of each one's component, for links held in memory."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    label = np.arange(len(nodes))
    while len(a):
        low = np.minimum(label[a], label[b])
        high = np.maximum(label[a], label[b])
        np.minimum.at(label, high, low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return nodes, nodes[label]


def forest(links: DataFrame) -> DataFrame:
    """A spanning forest of each task's links, as (u, v) with v the smaller."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        count = 0

        def contracted():
            nodes, top = roots(*[np.concatenate(x) for x in zip(*held)])
            keep = nodes != top
            return nodes[keep], top[keep]

        for batch in batches:
            held.append((longs(batch.column(0)), longs(batch.column(1))))
            count += batch.num_rows
            if count >= CHUNK:
                held = [contracted()]
                count = len(held[0][0])
                if count > CHUNK // 2:  # almost a forest already: pass it on
                    yield rows(u=held[0][0], v=held[0][1])
                    held, count = [], 0
        if held:
            u, v = contracted()
            for at in range(0, len(u), 100_000):
                yield rows(u=u[at : at + 100_000], v=v[at : at + 100_000])

    return links.mapInArrow(run, "u long, v long")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v: long); ``root`` is the smallest node of its component.

    Repeated links and loops are harmless; a node with no link but to itself is not
    in the result, and an empty table gives an empty result.
    """
    left = stage(forest(links.where("u <> v")), "links")
    label: DataFrame | None = None
    while label is None or not left.isEmpty():
        both = left.unionByName(left.select(F.col("v").alias("u"), F.col("u").alias("v")))
        point = stage(both.groupBy("u").agg(F.least("u", F.min("v")).alias("p")), "pointers")
        for _ in range(2):
            ahead = point.select(F.col("u").alias("p"), F.col("p").alias("q"))
            point = point.join(ahead, "p").select("u", F.col("q").alias("p"))
        point = stage(point, "jumped")
        if label is None:
            label = point.select(F.col("u").alias("node"), F.col("p").alias("root"))
        else:
            ahead = point.select(F.col("u").alias("root"), F.col("p").alias("further"))
            label = stage(label.join(ahead, "root", "left").select("node", F.coalesce("further", "root").alias("root")), "labels")
        of_u = point.select("u", F.col("p").alias("pu"))
        of_v = point.select(F.col("u").alias("v"), F.col("p").alias("pv"))
        moved = left.join(of_u, "u").join(of_v, "v").where("pu <> pv")
        moved = moved.select(F.greatest("pu", "pv").alias("u"), F.least("pu", "pv").alias("v")).distinct()
        left = stage(forest(moved), "links")
    return label
