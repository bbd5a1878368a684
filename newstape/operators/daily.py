"""Per (ticker, day) aggregates of scored articles, and calendar windows over them.

Input articles carry ticker, date, source_name, sentiment_label and
sentiment_score.  The grouping aggregates map-side first, so a ticker or a day
that holds most of the articles only sends its partial sums through the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from newstape.functions.numeric import half_even
from newstape.functions.windows import trailing_days
from newstape.schemas import DAILY_FEATURES, SENTIMENT_FEATURES, SOURCE_KEYWORDS

DAY = ["ticker", "date"]


def _label_count(label: str) -> Column:
    return F.count_if(F.col("sentiment_label") == label)


def _sentiment_aggregates() -> list[Column]:
    score = F.col("sentiment_score").cast("double")
    rows = F.count(F.lit(1))
    out = [rows.alias("article_count")]
    out += [_label_count(label).alias(f"{label}_count") for label in ("positive", "neutral", "negative")]
    out += [
        half_even(_label_count(label) / rows, 6).alias(f"{label}_ratio")
        for label in ("positive", "neutral", "negative")
    ]
    return out + [
        half_even(F.avg(score), 6).alias("mean_sentiment_score"),
        half_even(F.coalesce(F.stddev_samp(score), F.lit(0.0)), 6).alias("sentiment_score_std"),
        F.min("sentiment_score").cast("long").alias("sentiment_score_min"),
        F.max("sentiment_score").cast("long").alias("sentiment_score_max"),
    ]


def _source_aggregates(keywords: Sequence[str]) -> list[Column]:
    name = F.lower("source_name")
    return [F.count_distinct("source_name").alias("unique_source_count")] + [
        F.count_if(name.contains(word)).alias(f"{word}_article_count") for word in keywords
    ]


def _mean_aggregates() -> list[Column]:
    score = F.col("sentiment_score").cast("double")
    return [F.avg(score).alias("daily_mean"), F.count(score).alias("daily_count")]


def daily_sentiment(articles: DataFrame) -> DataFrame:
    """Counts, label ratios and score statistics per (ticker, date)."""
    return articles.groupBy(*DAY).agg(*_sentiment_aggregates())


def daily_sources(articles: DataFrame, keywords: Sequence[str] = SOURCE_KEYWORDS) -> DataFrame:
    """Distinct sources, and articles whose source name contains each keyword."""
    return articles.groupBy(*DAY).agg(*_source_aggregates(keywords))


def daily_means(articles: DataFrame) -> DataFrame:
    """Unrounded mean score and number of scores per (ticker, date)."""
    return articles.groupBy(*DAY).agg(*_mean_aggregates())


def _volume_windows() -> dict[str, Column]:
    count = F.col("article_count")
    return {
        "articles_last_24h": count,
        "articles_last_3d": F.sum(count).over(trailing_days(3)),
        "articles_last_7d": F.sum(count).over(trailing_days(7)),
    }


def _rolling_windows() -> dict[str, Column]:
    out = {}
    for days in (3, 7):
        out[f"rolling_{days}d_mean_sentiment"] = half_even(F.avg("daily_mean").over(trailing_days(days)), 6)
    for days in (3, 7):
        out[f"rolling_{days}d_article_volume"] = F.sum("daily_count").over(trailing_days(days))
    return out


def article_volumes(daily: DataFrame) -> DataFrame:
    """Articles on the day, and in the 3 and 7 calendar days ending on it."""
    return daily.select(*DAY, *[c.alias(n) for n, c in _volume_windows().items()])


def rolling_sentiment(means: DataFrame) -> DataFrame:
    """Mean of the daily means (each day counts once) and article volume over 3 and 7 days."""
    return means.select(*DAY, *[c.alias(n) for n, c in _rolling_windows().items()])


def daily_features(articles: DataFrame) -> DataFrame:
    """All 22 article features in one grouping and one window pass."""
    grouped = articles.groupBy(*DAY).agg(
        *_sentiment_aggregates(), *_source_aggregates(SOURCE_KEYWORDS), *_mean_aggregates()
    )
    windows = _volume_windows() | _rolling_windows()
    return grouped.withColumns(windows).select(*DAY, *DAILY_FEATURES)


__all__ = [
    "SENTIMENT_FEATURES", "article_volumes", "daily_features", "daily_means",
    "daily_sentiment", "daily_sources", "rolling_sentiment",
]
