"""Joins and single-table lookups over stored articles, results and prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newstape.schemas import SENTIMENT_SCORES


def scored_articles(articles: DataFrame, sentiments: DataFrame) -> DataFrame:
    """Articles with their results; one row per (article, model)."""
    return articles.join(sentiments, "article_id")


def without_sentiment(
    articles: DataFrame, sentiments: DataFrame, model_name: str | None = None, strict: bool = False
) -> DataFrame:
    """Articles that still need scoring.

    Without a model: those with no result at all.  With one, an article counts as
    unscored when it has no result, or has a result of *another* model (even beside
    one of this model); ``strict`` asks for articles without a result of this model.
    """
    if model_name is None:
        return articles.join(sentiments.select("article_id"), "article_id", "left_anti")
    if strict:
        mine = sentiments.where(F.col("model_name") == model_name).select("article_id")
        return articles.join(mine, "article_id", "left_anti")
    per_article = sentiments.groupBy("article_id").agg(
        F.max((F.col("model_name") != model_name).cast("int")).alias("_other")
    )
    joined = articles.join(per_article, "article_id", "left")
    return joined.where(F.col("_other").isNull() | (F.col("_other") == 1)).drop("_other")


def with_score(df: DataFrame, label: str = "sentiment_label") -> DataFrame:
    """Lower-cased label and its score; an unknown label is neutral."""
    lowered = F.lower(label)
    known = F.when(lowered.isin(list(SENTIMENT_SCORES)), lowered).otherwise(F.lit("neutral"))
    score = F.lit(0)
    for name, value in SENTIMENT_SCORES.items():
        score = F.when(F.col(label) == name, value).otherwise(score)
    return df.withColumn(label, known).withColumn("sentiment_score", score)


def newest_first(articles: DataFrame, ticker: str | None = None) -> DataFrame:
    wanted = articles if ticker is None else articles.where(F.col("ticker") == ticker.upper())
    return wanted.orderBy(F.desc("published_at"))


def oldest_first(prices: DataFrame, ticker: str | None = None) -> DataFrame:
    wanted = prices if ticker is None else prices.where(F.col("ticker") == ticker.upper())
    return wanted.orderBy("ticker", "trading_date")


def latest_prices(prices: DataFrame) -> DataFrame:
    """The latest row of every ticker, reduced on the map side."""
    rest = [c for c in prices.columns if c != "ticker"]
    one = prices.groupBy("ticker").agg(F.max_by(F.struct(*rest), "trading_date").alias("_row"))
    return one.select("ticker", *[F.col(f"_row.{c}").alias(c) for c in rest])


def latest_price(prices: DataFrame, ticker: str) -> DataFrame:
    """One ticker's latest row (a top-1, no full sort)."""
    return prices.where(F.col("ticker") == ticker.upper()).orderBy(F.desc("trading_date")).limit(1)
