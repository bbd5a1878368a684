"""Labelled datasets from feature rows and prices."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F, types as T

from newstape.errors import LabelError, LoadError
from newstape.operators.daily import daily_features
from newstape.operators.indicators import technical_indicators
from newstape.operators.labels import label_features, with_labels
from newstape.plans.features import feature_window
from newstape.schemas import FEATURE_COLUMNS, HORIZONS, LABEL_COLUMNS, LABEL_LOOKAHEAD_DAYS
from newstape.sources.scans import in_days, price_range
from newstape.sources.sinks import write_dataset


def ordered_columns(labelled: DataFrame) -> DataFrame:
    """Everything else first, in its own order, then the labels that are present."""
    plain = [c for c in labelled.columns if c not in LABEL_COLUMNS]
    return labelled.select(*plain, *[c for c in LABEL_COLUMNS if c in labelled.columns])


def feature_dates(features: DataFrame) -> tuple[dt.date, dt.date]:
    """First and last feature date: one small aggregate, so the price scan can be bounded."""
    low, high = features.agg(F.min("date"), F.max("date")).first()
    if high is None:
        raise LoadError("the features have no valid date")
    return low, high


def labelled_dataset(
    features: DataFrame,
    prices: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
    lookahead_days: int = LABEL_LOOKAHEAD_DAYS,
    seq: str | None = None,
) -> DataFrame:
    """Label every feature row that has a close, using prices up to ``lookahead_days`` past the end.

    Callers that know the date range pass it and nothing runs before the result is used.
    ``seq`` orders the price rows of a repeated day; the last one counts.
    """
    if start is None or end is None:
        start, end = feature_dates(features)
    wanted = price_range(
        prices.select("ticker", "trading_date", "close_price", *([seq] if seq else [])),
        None, start, end + dt.timedelta(days=lookahead_days),
    )
    return ordered_columns(label_features(features, wanted, seq))


def training_dataset(
    articles: DataFrame,
    sentiments: DataFrame | None,
    prices: DataFrame,
    start: dt.date,
    end: dt.date,
    lookahead_days: int = LABEL_LOOKAHEAD_DAYS,
    seq: str | None = None,
    **options,
) -> DataFrame:
    """Features and labels of a range at once: what :func:`labelled_dataset` makes of the range's feature vectors.

    The prices are read, dealt by ticker and sorted once, and one pass over them gives the
    indicators of a day and the closes ahead of it; one join adds them to the article features.
    """
    window, first_price = feature_window(articles, sentiments, start, end, **{k: v for k, v in options.items() if k != "fill"})
    loaded = price_range(prices, options.get("tickers"), first_price, end + dt.timedelta(days=lookahead_days))
    bars = technical_indicators(loaded, options.get("fill"), seq, HORIZONS)
    bars = with_labels(bars.where(F.col("close_price").isNotNull() & in_days("trading_date", start, end)))
    daily = daily_features(window).where(in_days("date", start, end))
    joined = daily.join(bars.drop("close_price").withColumnRenamed("trading_date", "date"), ["ticker", "date"])
    return joined.select(*FEATURE_COLUMNS, *LABEL_COLUMNS)


def labelled_dataset_for_day(
    features: DataFrame,
    prices: DataFrame,
    day: dt.date | None = None,
    lookahead_days: int = LABEL_LOOKAHEAD_DAYS,
) -> DataFrame:
    """The dataset of one day (the latest by default); earlier rows find no close and drop out."""
    if day is None:
        day = feature_dates(features)[1]
    return labelled_dataset(features, prices, day, day, lookahead_days)


def require_labels(dataset: DataFrame) -> DataFrame:
    """For jobs about to write: fail when no feature row had a close."""
    if dataset.isEmpty():
        raise LabelError("No labeled rows: no feature row has a close on its date")
    return dataset


def dataset_job(
    features: DataFrame,
    prices: DataFrame,
    folder: str,
    start: dt.date | None = None,
    end: dt.date | None = None,
    lookahead_days: int = LABEL_LOOKAHEAD_DAYS,
    by_month: bool = False,
) -> DataFrame:
    """Label, write, and return what was written; fails when no feature row had a close."""
    if start is None or end is None:
        start, end = feature_dates(features)
    built = labelled_dataset(features, prices, start, end, lookahead_days)
    path = write_dataset(built, folder, start, end, by_month=by_month)
    stored = T.StructType(built.schema.fields + ([T.StructField("month", T.StringType())] if by_month else []))
    return require_labels(features.sparkSession.read.schema(stored).parquet(path).select(*built.columns))
