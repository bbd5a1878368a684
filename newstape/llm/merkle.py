"""Merkle dataset manifest: cogrouped subtree exchange.

Every row is a leaf; the leaves of a group stand in the order of their ids, pairs of
nodes become their parent until one is left, and the groups' roots are reduced the same
way to one root of the whole table.

The leaves of a group are dealt by their rank into superblocks of ``2 ** LEVELS``
neighbours.  A superblock is a whole subtree, so it is reduced by itself; its root is a
leaf of the next level, where superblocks of superblocks are reduced, and so on: three or
four rounds whatever the size of the table, none holding more than a superblock in a
task.  On the way down a superblock and the outer nodes it needs (the siblings above its
root) are cogrouped: one function finishes the local reduction, joins the local siblings
with the outer ones to proofs, and folds each leaf up to the root.

Ranks come from a range partitioning: a place inside its range and the sum of the counts
of the ranges before it.  No group, however large, is in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from newstape.llm.common import id_back, id_of, rows, stage

#: levels of a superblock's own tree: 1,024 leaves
LEVELS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_hash(fields: list[Column]) -> Column:
    """SHA-256 of the fields' values, each after its size in bytes, NULL as ``-``; lower-case hex."""
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
             for v in (f.cast("string") for f in fields)]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def reduced(nodes: list[str], rounds: int) -> list[list[str]]:
    """The nodes and what they become in each round; a node without a neighbour is hashed alone."""
    levels = [nodes]
    for _ in range(rounds):
        below = levels[-1]
        levels.append([digest("".join(below[k : k + 2])) for k in range(0, len(below), 2)])
    return levels


def siblings(levels: list[list[str]], at: int) -> tuple[list[str], str]:
    """Siblings of node ``at`` from the lowest level up, and where they stand: L, R, or - where there is none."""
    found, sides = [], []
    for nodes in levels[:-1]:
        other = at ^ 1
        if other < len(nodes):
            found.append(nodes[other])
            sides.append("L" if at & 1 else "R")
        else:
            sides.append("-")
        at >>= 1
    return found, "".join(sides)


def fold(node: str, proof: list[str], sides: str) -> str:
    """The root that a node and its proof lead to."""
    others = iter(proof)
    for side in sides:
        if side == "-":
            node = digest(node)
        else:
            other = next(others)
            node = digest(other + node if side == "L" else node + other)
    return node


def _rounds(count: int, levels: int) -> int:
    """Rounds that a superblock of a tree level with ``count`` nodes goes."""
    return min(levels, (count - 1).bit_length())


def _placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with ``_rank`` from 0 in ``order`` within ``_group`` and the group's ``_count``."""
    ordered = nodes.repartitionByRange("_group", *order).sortWithinPartitions("_group", *order)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, reached = None, 0
        for batch in batches:
            group = batch.column("_group").to_numpy(zero_copy_only=False)
            if not len(group):
                continue
            new = np.concatenate([[group[0] != last], group[1:] != group[:-1]])
            first = np.maximum.accumulate(np.where(new, np.arange(len(group)), 0))
            place = np.arange(len(group)) - first
            if not new[0]:
                place[: np.argmax(np.append(new[1:], True)) + 1] += reached
            last, reached = group[-1], int(place[-1]) + 1
            columns = {c: batch.column(c) for c in batch.schema.names}
            yield rows(**columns, _part=np.full(len(group), part, np.int64), _place=place.astype(np.int64))

    kinds = ", ".join(f"{c} {t}" for c, t in nodes.dtypes)
    # written, so that places and ranges stay what they are
    numbered = stage(ordered.mapInArrow(number, f"{kinds}, _part long, _place long"), "places")
    # a row per group and range: at most as many as there are ranges and groups together
    counts = numbered.groupBy("_group", "_part").agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy("_group")
    before = F.sum("_n").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("_group", "_part", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_n").over(group).alias("_count"))
    placed = numbered.join(counts, ["_group", "_part"])
    return placed.withColumn("_rank", F.col("_before") + F.col("_place")).drop("_part", "_place", "_before")


def _in_blocks(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumns({"_block": F.shiftright("_rank", levels), "_at": F.col("_rank").bitwiseAND((1 << levels) - 1)})


def _upwards(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """The nodes of each round, dealt into superblocks, until every group has one node; that is the last."""

    def up(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("_at")
        count = int(block["_count"].iloc[0])
        top = reduced(block["_hash"].tolist(), _rounds(count, levels))[-1][0]
        one = block.iloc[:1]
        return pd.DataFrame({"_group": one["_group"], "_rank": one["_block"], "_count": -(-count >> levels), "_hash": [top]})

    most = nodes.agg(F.max("_count")).first()[0] or 0
    found = [_in_blocks(nodes, levels)]
    while most > 1:
        below = found[-1].select("_group", "_block", "_at", "_count", "_hash")
        above = below.groupBy("_group", "_block").applyInPandas(up, "_group string, _rank long, _count long, _hash string")
        found.append(_in_blocks(stage(above, "nodes"), levels))
        most = -(-most >> levels)
    return found


OUTER = "_group string, _rank long, _subroot string, _root string, _proof array<string>, _sides string"


def _outer_of(nodes: DataFrame, outer: DataFrame, levels: int) -> DataFrame:
    """The nodes' own siblings before those of their superblock: what the superblocks below them need."""

    def down(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("_at")
        own = reduced(block["_hash"].tolist(), _rounds(int(block["_count"].iloc[0]), levels))
        over = above.iloc[0]
        proofs, sides = zip(*(siblings(own, at) for at in range(len(block))))
        return pd.DataFrame({
            "_group": block["_group"], "_rank": block["_rank"], "_subroot": over["_subroot"], "_root": over["_root"],
            "_proof": [[*p, *over["_proof"]] for p in proofs], "_sides": [s + over["_sides"] for s in sides],
        })

    below = nodes.select("_group", "_block", "_at", "_rank", "_count", "_hash").groupBy("_group", "_block")
    return below.cogroup(_by_block(outer)).applyInPandas(down, OUTER)


def _by_block(outer: DataFrame):
    return outer.withColumnRenamed("_rank", "_block").groupBy("_group", "_block")


def manifest(
    docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "lang",
    claimed: dict[str, Column] | None = None, levels: int = LEVELS,
) -> DataFrame:
    """A row per row: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``place``, ``proof``, ``sides``, ``folded_root``, ``verified``.

    ``leaf`` hashes the ``fields``; NULL and empty differ.  ``place`` is the row's rank in
    its group, ``proof`` holds the siblings from the leaf up to the root and ``sides``
    where they stand (see :func:`fold`).  ``claimed`` gives other values for some fields,
    of a copy to be checked: ``folded_root`` folds the copy's leaf with the proof, and
    ``verified`` says that it reaches the root.  Without it the rows are their own copy.

    Rows with equal ids stand in the order of their leaves; equal rows have leaves of
    their own.  NULL ids come before all others, NULL groups before all groups, which
    stand in the order of their UTF-8 bytes.  An empty table has no rows.  Columns other
    than the named ones are not looked at.
    """
    claimed = claimed or {}
    leaf = leaf_hash([F.col(f) for f in fields])
    copy = leaf_hash([claimed.get(f, F.col(f)) for f in fields])
    name = F.coalesce(F.concat(F.lit("1"), F.col(group_col).cast("string")), F.lit("0"))
    changed = F.lit(False)
    for f, value in claimed.items():
        changed = changed | ~value.cast("string").eqNullSafe(F.col(f).cast("string"))
    leaves = docs.select(
        name.alias("_group"), id_of(id_col).alias("_id"), leaf.alias("_hash"), F.when(changed, copy).alias("_claim"),
        # parts copies of one row, however many there are; they are equal, so their order is free
        F.monotonically_increasing_id().alias("_salt"),
    )
    placed = _placed(stage(leaves, "leaves"), ["_id", "_hash", "_salt"])
    inside = _upwards(placed, levels)

    subroots = inside[-1].select("_group", "_hash")
    tops = subroots.select(F.lit("").alias("_group"), F.col("_group").alias("_name"), "_hash")
    tops = _placed(tops, ["_name"])
    across = _upwards(tops, levels)

    names = tops.select("_name", F.col("_rank").alias("_top"), F.col("_hash").alias("_subroot"))
    outer = across[-1].select(
        "_group", "_rank", F.lit(None).cast("string").alias("_subroot"), F.col("_hash").alias("_root"),
        F.array().cast("array<string>").alias("_proof"), F.lit("").alias("_sides"),
    )
    for nodes in across[-2::-1]:
        outer = _outer_of(nodes, outer, levels)
    outer = stage(outer, "outer").drop("_group", "_subroot").withColumnRenamed("_rank", "_top").join(names, "_top")
    outer = outer.select(F.col("_name").alias("_group"), F.lit(0).cast("long").alias("_rank"), "_subroot", "_root", "_proof", "_sides")
    for nodes in inside[-2:0:-1]:
        outer = stage(_outer_of(nodes, outer, levels), "outer")

    def finish(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("_at")
        leaves = block["_hash"].tolist()
        own = reduced(leaves, _rounds(int(block["_count"].iloc[0]), levels))
        over = above.iloc[0]
        above_proof, above_sides = list(over["_proof"]), over["_sides"]
        proofs, sides, folded = [], [], []
        for at, (leaf, claim) in enumerate(zip(leaves, block["_claim"].tolist())):
            near, where = siblings(own, at)
            proofs.append(near + above_proof)
            sides.append(where + above_sides)
            folded.append(fold(claim if isinstance(claim, str) else leaf, proofs[-1], sides[-1]))
        root = over["_root"]
        return pd.DataFrame({
            "_id": block["_id"], "leaf": leaves, "subroot": over["_subroot"], "root": root, "place": block["_rank"],
            "proof": proofs, "sides": sides, "folded_root": folded, "verified": [f == root for f in folded],
        })

    schema = ("_id long, leaf string, subroot string, root string, place long, proof array<string>, sides string, "
              "folded_root string, verified boolean")
    lowest = inside[0].select("_group", "_block", "_at", "_rank", "_count", "_id", "_hash", "_claim").groupBy("_group", "_block")
    out = lowest.cogroup(_by_block(outer)).applyInPandas(finish, schema)
    return out.select(id_back().alias("doc_id"), *out.columns[1:])
