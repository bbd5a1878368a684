"""Filtered scans over the article, sentiment and price tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from newstape.functions.text import utc_day


def _symbols(tickers: Sequence[str]) -> list[str]:
    return [t.upper() for t in tickers]


def ticker_filter(df: DataFrame, tickers: Sequence[str] | None) -> DataFrame:
    """Keep the named tickers (upper-cased); no names keeps everything."""
    return df.where(F.col("ticker").isin(_symbols(tickers))) if tickers else df


def in_days(column: str, start: dt.date | None, end: dt.date | None) -> Column:
    """Inclusive bounds, each optional."""
    condition = F.lit(True)
    if start is not None:
        condition = condition & (F.col(column) >= F.lit(start))
    if end is not None:
        condition = condition & (F.col(column) <= F.lit(end))
    return condition


def _article_bounds(start: dt.date, end: dt.date) -> Column:
    """Timestamp bounds, so that the filter reaches the files: ``[start 00:00, end + 1 day)``."""
    first = F.lit(start.isoformat()).cast("timestamp")
    after = F.lit((end + dt.timedelta(days=1)).isoformat()).cast("timestamp")
    return (F.col("published_at") >= first) & (F.col("published_at") < after)


WINDOW_COLUMNS = [
    "ticker", "source_name", "published_at", "date",
    "sentiment_label", "sentiment_score", "sentiment_confidence",
]


def article_window(
    articles: DataFrame,
    sentiments: DataFrame,
    start: dt.date,
    end: dt.date,
    tickers: Sequence[str] | None = None,
    model_name: str | None = None,
) -> DataFrame:
    """Scored articles published from ``start`` to ``end`` (UTC days, inclusive).

    Without ``model_name`` an article scored by two models appears twice; naming
    a model keeps one result per article.
    """
    wanted = ticker_filter(articles.where(_article_bounds(start, end)), tickers)
    scored = sentiments if model_name is None else sentiments.where(F.col("model_name") == model_name)
    return (
        wanted.select("article_id", "ticker", "source_name", "published_at")
        .join(
            scored.select("article_id", "sentiment_label", "sentiment_score", "sentiment_confidence"),
            "article_id",
        )
        .withColumn("date", utc_day(F.col("published_at")))
        .select(*WINDOW_COLUMNS)
    )


def scored_window(
    enriched: DataFrame, start: dt.date, end: dt.date, tickers: Sequence[str] | None = None
) -> DataFrame:
    """The same window over articles that already carry their sentiment columns."""
    wanted = ticker_filter(enriched.where(_article_bounds(start, end)), tickers)
    return wanted.withColumn("date", utc_day(F.col("published_at"))).select(*WINDOW_COLUMNS)


def price_range(
    prices: DataFrame,
    tickers: Sequence[str] | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Price rows inside inclusive bounds.  Order is left to the consumer or the sink."""
    return ticker_filter(prices, tickers).where(in_days("trading_date", start, end))


def label_prices(prices: DataFrame, tickers: Sequence[str], start: dt.date, end: dt.date) -> DataFrame:
    """(ticker, trading_date, close_price) for the named tickers; no names, no rows."""
    columns = prices.select("ticker", "trading_date", "close_price")
    if not tickers:
        return columns.where(F.lit(False))
    return price_range(columns, tickers, start, end)
