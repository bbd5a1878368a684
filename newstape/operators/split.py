"""Train/test splits that are exact, reproducible, and free of big single-task sorts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

TEST_SHARE = 0.2
SEED = 42
BUCKET_DIGITS = 4  # 65,536 hash ranges per class


def with_split_key(df: DataFrame, by: Sequence[str] = ("ticker", "date"), seed: int = SEED) -> DataFrame:
    """A pseudo-random but repeatable order: MD5 over the row's identity and the seed."""
    parts = [F.col(c).cast("string") for c in by]
    return df.withColumn("_order", F.md5(F.concat_ws("|", *parts, F.lit(str(seed)))))


def class_quotas(counts: DataFrame, label: str, test_share: float = TEST_SHARE) -> DataFrame:
    """Test rows per class: ``ceil(share * rows)`` in total, shared out by largest remainder.

    ``counts`` has one row per class, so its windows are tiny.
    """
    everything = Window.partitionBy(F.lit(0))
    total = F.sum("_n").over(everything)
    test = F.ceil(total * F.lit(test_share) - F.lit(1e-9))
    exact = test * F.col("_n") / total
    shares = counts.withColumns({"_floor": F.floor(exact), "_rest": exact - F.floor(exact), "_test": test})
    spare = F.col("_test") - F.sum("_floor").over(everything)
    ranked = shares.withColumns({
        "_spare": spare,
        "_rank": F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("_rest"), label)),
    })
    extra = F.when(F.col("_rank") <= F.col("_spare"), 1).otherwise(0)
    return ranked.select(label, "_n", (F.col("_floor") + extra).alias("_quota"))


def stratified_split(
    df: DataFrame,
    label: str = "label_direction",
    by: Sequence[str] = ("ticker", "date"),
    test_share: float = TEST_SHARE,
    seed: int = SEED,
) -> DataFrame:
    """Add ``is_test``: the first rows of each class in hash order, up to the class's quota.

    The last test row of a class is found by counting hash ranges (map-side sums, at
    most 65,536 per class), then ordering only the one range it falls into.  Marking
    the rows is a comparison with that bound; ``by`` must identify a row.
    """
    keyed = with_split_key(df, by, seed)
    ranges = keyed.groupBy(label, F.substring("_order", 1, BUCKET_DIGITS).alias("_range")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    quotas = class_quotas(ranges.groupBy(label).agg(F.sum("_rows").alias("_n")), label, test_share)
    upto = Window.partitionBy(label).orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    running = ranges.withColumn("_upto", F.sum("_rows").over(upto)).join(quotas, label)
    last = running.where(
        (F.col("_upto") >= F.col("_quota")) & (F.col("_upto") - F.col("_rows") < F.col("_quota"))
    ).select(label, "_range", (F.col("_quota") - (F.col("_upto") - F.col("_rows"))).alias("_need"))
    # one row per class; whether that is few enough to broadcast is left to Spark
    inside = keyed.select(label, "_order", F.substring("_order", 1, BUCKET_DIGITS).alias("_range")).join(
        last, [label, "_range"]
    )
    nth = F.row_number().over(Window.partitionBy(label).orderBy("_order"))
    bounds = inside.withColumn("_nth", nth).where(F.col("_nth") == F.col("_need")).select(
        label, F.col("_order").alias("_bound")
    )
    marked = keyed.join(bounds, label, "left")
    is_test = F.coalesce(F.col("_order") <= F.col("_bound"), F.lit(False))
    return marked.withColumn("is_test", is_test).select(*df.columns, "is_test")


def time_split(df: DataFrame, first_test_day: dt.date) -> DataFrame:
    """Add ``is_test`` by date: no later row trains a model that is tested on earlier ones."""
    return df.withColumn("is_test", F.col("date") >= F.lit(first_test_day))
