"""Incremental article intake: deduplication, daily counts, and upserts per micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from newstape.operators import upsert
from newstape.schemas import SENTIMENT_SCORES
from newstape.sources.keyed import KeyedTable


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, names: str = "*.parquet", fmt: str = "parquet") -> DataFrame:
    """New files of a landing folder as a stream; the schema is given, never inferred."""
    return spark.readStream.schema(schema).option("pathGlobFilter", names).format(fmt).load(folder)


def new_urls(articles: DataFrame, delay: str = "1 day") -> DataFrame:
    """Each url once among articles that arrive within the watermark of each other."""
    return articles.where(F.col("url") != "").withWatermark("published_at", delay).dropDuplicatesWithinWatermark(["url"])


def daily_label_counts(articles: DataFrame, delay: str = "1 day") -> DataFrame:
    """(ticker, date) article and label counts, kept as state until the watermark passes the day."""
    day = F.window("published_at", "1 day")
    counts = articles.withWatermark("published_at", delay).groupBy(day, "ticker").agg(
        F.count(F.lit(1)).alias("article_count"),
        *[F.count_if(F.col("sentiment_label") == label).alias(f"{label}_count") for label in SENTIMENT_SCORES],
        F.avg(F.col("sentiment_score").cast("double")).alias("daily_mean"),
    )
    return counts.select("ticker", F.to_date("window.start").alias("date"), *[c for c in counts.columns if c not in ("window", "ticker")])


def upsert_batches(
    table: KeyedTable, keys: Sequence[str], refresh: Sequence[str], seq: str | None = None
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that merges every micro-batch into a keyed table.

    A batch rewrites only the partitions it touches.  One that is replayed after a failure
    merges to the same table.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        table.merge(batch, lambda old, new: upsert.upsert(old, new, keys, refresh, seq))

    return merge


def run_available(stream: DataFrame, checkpoint: str, merge: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Process what has arrived, then stop."""
    query = (
        stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).foreachBatch(merge).start()
    )
    query.awaitTermination()
