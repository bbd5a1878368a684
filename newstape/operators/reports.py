"""Summaries of runs and tables.  Each is one grouping; totals come from rollups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from newstape.functions.numeric import half_even, ratio
from newstape.schemas import DIRECTIONS, LABEL_COLUMNS


def _rows() -> Column:
    return F.count(F.lit(1))


def sentiment_distribution(
    articles: DataFrame, sentiments: DataFrame, ticker: str | None = None, model_name: str | None = None
) -> DataFrame:
    """Results per label, for all articles or one ticker, for all models or one."""
    wanted = articles if ticker is None else articles.where(F.col("ticker") == ticker.upper())
    scored = sentiments if model_name is None else sentiments.where(F.col("model_name") == model_name)
    joined = wanted.select("article_id").join(scored.select("article_id", "sentiment_label"), "article_id")
    return joined.groupBy("sentiment_label").agg(_rows().alias("count"))


def row_count(df: DataFrame, ticker: str | None = None, model_name: str | None = None) -> DataFrame:
    """One row with the number of rows, optionally of one ticker or one model."""
    if ticker is not None:
        df = df.where(F.col("ticker") == ticker.upper())
    if model_name is not None:
        df = df.where(F.col("model_name") == model_name)
    return df.agg(_rows().alias("count"))


def _requested(requested: DataFrame, found: DataFrame, counts: Sequence[str]) -> DataFrame:
    """Every requested ticker once: zero counts and status ``empty`` where nothing was found."""
    joined = requested.select("ticker").distinct().join(found, "ticker", "left")
    status = F.when(F.coalesce(counts[0], F.lit(0)) > 0, "ok").otherwise("empty")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts}).withColumn("status", status)


def ingestion_summary(articles: DataFrame, requested: DataFrame) -> DataFrame:
    """Per ticker: articles, first and last publication, distinct sources, status."""
    found = articles.groupBy("ticker").agg(
        _rows().alias("article_count"),
        F.min("published_at").alias("earliest"),
        F.max("published_at").alias("latest"),
        F.count_distinct("source_name").alias("unique_sources"),
    )
    return _requested(requested, found, ["article_count", "unique_sources"])


def sentiment_summary(enriched: DataFrame, requested: DataFrame) -> DataFrame:
    """Per ticker: articles per label and the mean score."""
    label = F.col("sentiment_label")
    names = ("positive", "neutral", "negative")
    found = enriched.groupBy("ticker").agg(
        _rows().alias("article_count"),
        *[F.count_if(label == n).alias(n) for n in names],
        half_even(F.avg(F.col("sentiment_score").cast("double")), 4).alias("mean_score"),
    )
    return _requested(requested, found, ["article_count", *names])


def load_summary(articles: DataFrame, sentiment: DataFrame) -> DataFrame:
    """Per ticker and in total (``ticker`` NULL): inserted, updated and skipped rows of both loads.

    Both inputs come from ``upsert.accounting_by``.
    """
    both = articles.withColumn("_kind", F.lit("articles")).unionByName(sentiment.withColumn("_kind", F.lit("sentiment")))
    sums = [
        F.sum(F.when(F.col("_kind") == kind, F.col(c)).otherwise(0)).alias(f"{kind}_{c}")
        for kind in ("articles", "sentiment")
        for c in ("inserted", "updated", "skipped")
    ]
    rolled = both.rollup("ticker").agg(
        *sums, F.count_distinct("ticker").alias("tickers"), F.grouping("ticker").cast("int").alias("is_total")
    )
    return rolled.withColumns({
        "articles_total": F.col("articles_inserted") + F.col("articles_updated"),
        "sentiment_total": F.col("sentiment_inserted") + F.col("sentiment_updated"),
    })


def price_summary(prices: DataFrame, requested: DataFrame) -> DataFrame:
    """Per ticker: price rows, first and last trading date, status."""
    found = prices.groupBy("ticker").agg(
        _rows().alias("rows_fetched"), F.min("trading_date").alias("date_min"), F.max("trading_date").alias("date_max")
    )
    return _requested(requested, found, ["rows_fetched"])


def feature_summary(features: DataFrame) -> DataFrame:
    """One row: dates and tickers with data, rows, articles, features per row."""
    return features.agg(
        F.count_distinct("date").alias("dates_with_data"),
        F.count_distinct("ticker").alias("tickers"),
        _rows().alias("feature_rows"),
        F.coalesce(F.sum("article_count"), F.lit(0)).alias("total_articles"),
    ).withColumn("features_per_row", F.lit(len(features.columns) - 2).cast("long"))


def dataset_summary(dataset: DataFrame) -> DataFrame:
    """One row: directions, date range, tickers, rows, numbers of feature and label columns."""
    way = F.col("label_direction")
    labels = [c for c in dataset.columns if c in LABEL_COLUMNS]
    return dataset.agg(
        *[F.count_if(way == d).alias(f"{d.lower()}_count") for d in ("BUY", "SELL", "HOLD")],
        F.count_if(way.isNull()).alias("null_count"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.count_distinct("date").alias("dates_with_data"),
        F.count_distinct("ticker").alias("tickers"),
        _rows().alias("dataset_rows"),
    ).withColumns({
        "feature_columns": F.lit(len(dataset.columns) - len(labels) - 2).cast("long"),
        "label_columns": F.lit(len(labels)).cast("long"),
    })


def prediction_summary(predictions: DataFrame, classes: Sequence[str] = DIRECTIONS) -> DataFrame:
    """Per class: predictions and their share in percent; absent classes show zero."""
    one = predictions.agg(
        _rows().alias("_all"), *[F.count_if(F.col("predicted_direction") == c).alias(f"_{c}") for c in classes]
    )
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("direction"), F.col(f"_{c}").alias("n")) for c in classes]))
    listed = one.select("_all", rows.alias("r")).select("_all", "r.direction", "r.n")
    share = F.coalesce(half_even(ratio(F.col("n") * 100.0, F.col("_all").cast("double")), 1), F.lit(0.0))
    return listed.select("direction", F.col("n").alias("predictions"), share.alias("percent"))


def missing_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column, and a total: how many values are missing (NULL or NaN)."""
    missing = {c: F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))) for c in columns}
    one = df.agg(*[agg.alias(f"_{i}") for i, agg in enumerate(missing.values())])
    cells = [F.struct(F.lit(c).alias("feature"), F.col(f"_{i}").alias("missing")) for i, c in enumerate(columns)]
    total = F.struct(F.lit("(total)").alias("feature"), sum((F.col(f"_{i}") for i in range(len(columns))), F.lit(0)).alias("missing"))
    return one.select(F.explode(F.array(*cells, total)).alias("r")).select("r.feature", "r.missing")


def drop_report(dataset: DataFrame, label: str = "label_direction") -> DataFrame:
    """One row: rows kept and dropped for a missing label, dates, and the dataset's mode."""
    counts = dataset.agg(
        _rows().alias("rows_read"), F.count(label).alias("rows_kept"), F.count_distinct("date").alias("dates")
    )
    return counts.select(
        "rows_read", "rows_kept", (F.col("rows_read") - F.col("rows_kept")).alias("rows_dropped"), "dates",
        F.when(F.col("dates") > 1, "historical").otherwise("single-date").alias("mode"),
    )
