"""Feature vectors per (ticker, date)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from newstape.errors import FeatureError
from newstape.operators.daily import daily_features
from newstape.operators.indicators import at_dates, technical_indicators
from newstape.schemas import (
    ARTICLE_LOOKBACK_DAYS, FEATURE_COLUMNS, FEATURES, PRICE_WARMUP_DAYS, TECHNICAL_FEATURES,
)
from newstape.sources.scans import article_window, in_days, price_range, scored_window
from newstape.sources.sinks import write_features


def assemble(
    window: DataFrame, prices: DataFrame | None, start: dt.date, end: dt.date, fill: str | None = None
) -> DataFrame:
    """Article features of the days in ``[start, end]`` with that day's indicators attached.

    ``window`` may reach further back than ``start`` (the calendar windows need it);
    ``prices`` starts where the exponential means are to be seeded.
    """
    daily = daily_features(window).where(in_days("date", start, end))
    if prices is None:
        empty = {c: F.lit(None).cast("double") for c in TECHNICAL_FEATURES}
        return daily.withColumns(empty).select(*FEATURE_COLUMNS)
    indicators = technical_indicators(prices, fill).where(in_days("trading_date", start, end))
    return at_dates(daily, indicators).select(*FEATURE_COLUMNS)


def _bounds(start: dt.date, end: dt.date, lookback_days: int) -> tuple[dt.date, dt.date]:
    if start > end:
        raise ValueError(f"start {start} is after end {end}")
    return start - dt.timedelta(days=lookback_days), start - dt.timedelta(days=PRICE_WARMUP_DAYS)


def feature_window(
    articles: DataFrame,
    sentiments: DataFrame | None,
    start: dt.date,
    end: dt.date,
    tickers: Sequence[str] | None = None,
    lookback_days: int = ARTICLE_LOOKBACK_DAYS,
    model_name: str | None = None,
) -> tuple[DataFrame, dt.date]:
    """The scored articles a range's features look at, and the first price date its indicators start from."""
    first_article, first_price = _bounds(start, end, lookback_days)
    if sentiments is None:
        return scored_window(articles, first_article, end, tickers), first_price
    return article_window(articles, sentiments, first_article, end, tickers, model_name), first_price


def feature_vectors(
    articles: DataFrame,
    sentiments: DataFrame | None,
    prices: DataFrame | None,
    start: dt.date,
    end: dt.date,
    tickers: Sequence[str] | None = None,
    lookback_days: int = ARTICLE_LOOKBACK_DAYS,
    model_name: str | None = None,
    fill: str | None = None,
) -> DataFrame:
    """The 43 feature columns for every (ticker, date) in the range with an article.

    Pass ``sentiments=None`` when the articles carry their sentiment columns.
    """
    window, first_price = feature_window(articles, sentiments, start, end, tickers, lookback_days, model_name)
    loaded = None if prices is None else price_range(prices, tickers, first_price, end)
    return assemble(window, loaded, start, end, fill)


def feature_vectors_for_day(
    articles: DataFrame, sentiments: DataFrame | None, prices: DataFrame | None, day: dt.date, **options
) -> DataFrame:
    """One date; the range job with equal ends."""
    return feature_vectors(articles, sentiments, prices, day, day, **options)


def feature_job(
    articles: DataFrame,
    sentiments: DataFrame | None,
    prices: DataFrame | None,
    start: dt.date,
    end: dt.date,
    folder: str,
    by_month: bool = False,
    **options,
) -> DataFrame:
    """Build a range, write it, and return what was written.

    A range without articles gives an empty table; a single day without any is an error.
    """
    built = feature_vectors(articles, sentiments, prices, start, end, **options)
    spark = built.sparkSession
    path = write_features(built, folder, start, end, by_month=by_month)
    written = spark.read.schema(_stored_schema(by_month)).parquet(path).select(*FEATURE_COLUMNS)
    if start == end and written.isEmpty():
        raise FeatureError(f"no ticker has an article on {start}")
    return written


def _stored_schema(by_month: bool) -> T.StructType:
    return T.StructType(FEATURES.fields + ([T.StructField("month", T.StringType())] if by_month else []))
