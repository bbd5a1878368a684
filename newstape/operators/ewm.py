"""Exponentially weighted means as window expressions.

For ``y = (1 - a) * y_prev + a * x`` the value at a row is a weighted sum of the
inputs so far: the running sum of ``weight * x / decay`` times the current decay.
Over a long series that sum would overflow, so a series is cut into blocks of at
most ``BLOCK_ROWS`` rows (about eight years of trading days).  Inside a block the
sum is a plain running window.  Across blocks the end states are folded in order,
``state = state * decay + local``, one small struct per finished block.

Missing inputs follow the usual convention for recursive means: a gap keeps the
last mean, and the next value is weighed against the old mean decayed once per
missed row.

:func:`ewm` keeps everything on one frame (no self-joins), with one shuffle by series key
and one extra sort that all later windows share; every row folds the end states of the
blocks before it.  That is right for daily series, which have a handful of blocks.

:func:`ewm_long` is for series of millions of rows (ticks).  A block is an affine map of
the mean before it, ``y -> decay * y + local``, and such maps compose, so the blocks are
scanned in two levels: the blocks of a superblock are composed to one map, the few
superblocks of a series are scanned, and each superblock then scans its own blocks from
its start.  Rows are dealt by block, so no task holds a series.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from newstape.session import fresh_path

BLOCK_ROWS = 2048
#: blocks of a superblock
FAN = 1024


@dataclass(frozen=True)
class Ewm:
    """One mean: input column, output column, weight of the newest value, values needed."""

    source: str
    output: str
    alpha: float
    min_periods: int

    @classmethod
    def span(cls, source: str, output: str, span: int) -> "Ewm":
        return cls(source, output, 2.0 / (span + 1.0), span)

    @classmethod
    def wilder(cls, source: str, output: str, period: int) -> "Ewm":
        return cls(source, output, 1.0 / period, period)

    @property
    def keep(self) -> float:
        return 1.0 - self.alpha

    def gap_log(self, gap: str) -> str:
        """log(decay of this step / decay of a step without a gap); 0 where no row was missed."""
        old = f"pow({self.keep!r}D, {gap} + 1)"
        return f"if({gap} > 0, ln({old} / ({old} + {self.alpha!r}D)) - {math.log(self.keep)!r}D, 0D)"

    def weight(self, gap: str) -> str:
        """Weight of a new value: 1 for the seed, else alpha, renormalised after a gap."""
        old = f"pow({self.keep!r}D, {gap} + 1)"
        return (
            f"CASE WHEN {gap} IS NULL THEN 1D WHEN {gap} = 0 THEN {self.alpha!r}D "
            f"ELSE {self.alpha!r}D / ({old} + {self.alpha!r}D) END"
        )


def block_rows(groups: Sequence[Sequence[Ewm]], limit: int = BLOCK_ROWS) -> int:
    """Rows per block so that no decay inside a block falls below ``e**-600``."""
    steepest = max(-math.log(spec.keep) for specs in groups for spec in specs)
    return max(1, min(limit, math.floor(600.0 / steepest)))


def row_numbers(key: str = "ticker", order: str = "trading_date") -> str:
    """The expression that :func:`smooth` expects as column ``_pos``."""
    return f"row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS _pos"


def _inside_blocks(df: DataFrame, numbered: list, sources: list, block: str) -> DataFrame:
    """Decay ``_d`` since the start of the block and weighted sum ``_loc`` inside it, from the gaps."""
    # decay since the start of the block: one factor per value, more after a gap
    df = df.selectExpr(
        "*",
        *[f"count({x}) OVER {block} AS _m{g}" for g, x in sources],
        *[f"sum({spec.gap_log(f'_gap{g}')}) OVER {block} AS _e{g}_{i}" for g, i, spec in numbered],
    )
    df = df.selectExpr("*", *[f"pow({spec.keep!r}D, _m{g}) * exp(_e{g}_{i}) AS _d{g}_{i}" for g, i, spec in numbered])

    # weighted sum inside the block
    df = df.selectExpr("*", *[
        f"coalesce(sum({spec.source} * ({spec.weight(f'_gap{g}')}) / _d{g}_{i}) OVER {block} * _d{g}_{i}, 0D)"
        f" AS _loc{g}_{i}"
        for g, i, spec in numbered
    ])
    return df


def smooth(
    df: DataFrame,
    groups: Sequence[Sequence[Ewm]],
    rows: int,
    *,
    key: str = "ticker",
    order: str = "trading_date",
) -> DataFrame:
    """Add the means to a frame that has ``_pos`` and ``_blk`` (see :func:`ewm`).

    The specs inside one group must have inputs that are NULL on the same rows
    (for instance several spans over one column); groups are independent.
    """
    run = f"PARTITION BY {key} ORDER BY _blk, {order}"
    so_far = f"({run} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    before = f"({run} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    block = f"(PARTITION BY {key}, _blk ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    base = list(df.columns)
    made = [spec.output for specs in groups for spec in specs]
    numbered = [(g, i, spec) for g, specs in enumerate(groups) for i, spec in enumerate(specs)]
    sources = [(g, specs[0].source) for g, specs in enumerate(groups)]

    # values so far, and rows missed since the last value
    df = df.selectExpr(
        "*",
        *[f"count({x}) OVER {so_far} AS _n{g}" for g, x in sources],
        *[f"max(if({x} IS NOT NULL, _pos, NULL)) OVER {before} AS _prev{g}" for g, x in sources],
    )
    df = df.selectExpr("*", *[f"if({x} IS NOT NULL, _pos - _prev{g} - 1, NULL) AS _gap{g}" for g, x in sources])

    df = _inside_blocks(df, numbered, sources, block)

    # end states of the finished blocks, oldest first
    state = ", ".join(f"_loc{g}_{i}, _d{g}_{i}" for g, i, _ in numbered)
    df = df.selectExpr(
        "*", f"collect_list(if(_pos % {rows} = 0, struct(_pos, {state}), NULL)) OVER {before} AS _ends"
    )
    df = df.selectExpr(*base, *[
        f"if(_n{g} >= {spec.min_periods}, _loc{g}_{i} + _d{g}_{i} * "
        f"aggregate(array_sort(_ends), 0D, (s, b) -> s * b._d{g}_{i} + b._loc{g}_{i}), NULL) AS {spec.output}"
        for g, i, spec in numbered
    ])
    return df.select(*[c for c in base if c not in made], *made)


def ewm(
    df: DataFrame,
    groups: Sequence[Sequence[Ewm]],
    *,
    key: str = "ticker",
    order: str = "trading_date",
    limit: int = BLOCK_ROWS,
) -> DataFrame:
    """Number the rows of every series, then add every mean in ``groups``."""
    rows = block_rows(groups, limit)
    numbered = df.selectExpr("*", row_numbers(key, order)).selectExpr("*", f"(_pos - 1) DIV {rows} AS _blk")
    return smooth(numbered, groups, rows, key=key, order=order).drop("_pos", "_blk")


def _positions(df: DataFrame, key: str, order: str) -> DataFrame:
    """``_pos`` from 1 within each series, from ranges of rows: a range's own count and those before it."""
    ordered = df.repartitionByRange(key, order).sortWithinPartitions(key, order)
    path = fresh_path(df.sparkSession, "series")
    # written, so that the ranges stay what they are
    ordered.withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    rows = df.sparkSession.read.parquet(path).withColumn("_range", F.shiftright("_row", 33))
    counts = rows.groupBy(key, "_range").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(key, "_range", (F.coalesce(F.sum("_size").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    return rows.join(counts, [key, "_range"]).withColumn("_pos", F.col("_row") + F.col("_shift")).drop("_row", "_range", "_shift")


def _before_each(maps: DataFrame, by: list[str], at: str) -> DataFrame:
    """``_start`` before each of the maps (``_d``, ``_l``: a number per mean) listed in ``_maps``, from the list's own ``_start``."""
    step = "zip_with(zip_with(element_at(acc, -1), m._d, (y, d) -> y * d), m._l, (y, l) -> y + l)"
    states = F.expr(f"aggregate(_maps, array(_start), (acc, m) -> array_append(acc, {step}))")
    each = maps.select(*by, F.explode(F.arrays_zip("_maps", F.slice(states, F.lit(1), F.size("_maps")).alias("_starts"))).alias("_one"))
    return each.select(*by, F.col(f"_one._maps.{at}").alias(at), F.col("_one._starts").alias("_start"))


def _block_starts(ends: DataFrame, key: str, means: int, fan: int) -> DataFrame:
    """The means before each block, from the blocks' maps (``_blk``, ``_d``, ``_l``), in two levels."""
    listed = lambda at: F.array_sort(F.collect_list(F.struct(at, "_d", "_l"))).alias("_maps")
    zeros = F.array_repeat(F.lit(0.0), means)
    blocks = ends.withColumn("_sup", F.expr(f"_blk DIV {fan}")).groupBy(key, "_sup").agg(listed("_blk"))
    whole = blocks.select(
        key, "_sup",
        F.expr(f"aggregate(_maps, array_repeat(1D, {means}), (y, m) -> zip_with(y, m._d, (a, b) -> a * b))").alias("_d"),
        F.expr(f"""aggregate(_maps, array_repeat(0D, {means}),
            (y, m) -> zip_with(zip_with(y, m._d, (a, b) -> a * b), m._l, (a, b) -> a + b))""").alias("_l"),
    )
    starts = _before_each(whole.groupBy(key).agg(listed("_sup")).withColumn("_start", zeros), [key], "_sup")
    return _before_each(blocks.join(starts, [key, "_sup"]), [key], "_blk")


def ewm_long(
    df: DataFrame,
    groups: Sequence[Sequence[Ewm]],
    *,
    key: str = "ticker",
    order: str = "trading_date",
    limit: int = BLOCK_ROWS,
    fan: int = FAN,
) -> DataFrame:
    """What :func:`ewm` gives, for series too long for one task; (``key``, ``order``) is unique and not NULL.

    Three small exchanges by (key, block) besides the ranges: the counts, the maps and the
    means before each block.  Intermediate rows are written to the work folder.
    """
    spark = df.sparkSession
    rows = block_rows(groups, limit)
    base = list(df.columns)
    made = [spec.output for specs in groups for spec in specs]
    numbered = [(g, i, spec) for g, specs in enumerate(groups) for i, spec in enumerate(specs)]
    sources = [(g, specs[0].source) for g, specs in enumerate(groups)]
    series = _positions(df, key, order).selectExpr("*", f"(_pos - 1) DIV {rows} AS _blk")

    # values before each block, and the place of the last one
    counts = series.groupBy(key, "_blk").agg(*[
        part for g, x in sources
        for part in (F.expr(f"count({x})").alias(f"_c{g}"), F.expr(f"max(if({x} IS NOT NULL, _pos, NULL))").alias(f"_l{g}"))
    ])
    earlier = f"(PARTITION BY {key} ORDER BY _blk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    counts = counts.selectExpr(key, "_blk", *[
        e for g, _ in sources
        for e in (f"coalesce(sum(_c{g}) OVER {earlier}, 0) AS _c{g}", f"max(_l{g}) OVER {earlier} AS _l{g}")
    ])
    run = f"PARTITION BY {key}, _blk ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND"
    block = f"({run} CURRENT ROW)"
    inside = series.join(counts, [key, "_blk"]).selectExpr(
        "*",
        *[f"_c{g} + count({x}) OVER {block} AS _n{g}" for g, x in sources],
        *[f"coalesce(max(if({x} IS NOT NULL, _pos, NULL)) OVER ({run} 1 PRECEDING), _l{g}) AS _prev{g}" for g, x in sources],
    )
    inside = inside.selectExpr("*", *[f"if({x} IS NOT NULL, _pos - _prev{g} - 1, NULL) AS _gap{g}" for g, x in sources])
    inside = _inside_blocks(inside, numbered, sources, block)
    inside = inside.selectExpr(
        *base, "_blk", "_pos", *[f"_n{g}" for g, _ in sources],
        f"array({', '.join(f'_d{g}_{i}' for g, i, _ in numbered)}) AS _d",
        f"array({', '.join(f'_loc{g}_{i}' for g, i, _ in numbered)}) AS _l",
    )
    path = fresh_path(spark, "blocks")
    inside.write.parquet(path)
    inside = spark.read.schema(inside.schema).parquet(path)

    ends = inside.where(f"_pos % {rows} = 0").select(key, "_blk", "_d", "_l")
    last = inside.groupBy(key).agg(F.max("_blk").alias("_blk")).select(key, "_blk", *[
        F.array_repeat(F.lit(v), len(made)).alias(c) for c, v in (("_d", 1.0), ("_l", 0.0))
    ])  # a block that is not full ends nothing, but it has a start
    maps = ends.join(last, [key, "_blk"], "left_anti").unionByName(last)
    starts = _block_starts(maps, key, len(made), fan)
    joined = inside.join(starts, [key, "_blk"])
    return joined.selectExpr(*[c for c in base if c not in made], *[
        f"if(_n{g} >= {spec.min_periods}, _l[{k}] + _d[{k}] * _start[{k}], NULL) AS {spec.output}"
        for k, (g, i, spec) in enumerate(numbered)
    ])
