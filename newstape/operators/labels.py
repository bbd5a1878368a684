"""Forward-looking labels from the ticker's own trading calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newstape.functions.numeric import half_even, null_if_nan, ratio
from newstape.functions.windows import last_of_day, once_a_day, series_window
from newstape.schemas import BUY_ABOVE, HORIZONS, LABEL_COLUMNS, SELL_BELOW


def trading_days(prices: DataFrame, seq: str | None = None) -> DataFrame:
    """(ticker, trading_date, close_price) of the rows with a close; neither NULL nor NaN is one.

    With ``seq`` a repeated day keeps its last row in that order, chosen before rows
    without a close are dropped.
    """
    if seq is not None:
        prices = last_of_day(prices, seq)
    close = null_if_nan(F.col("close_price").cast("double"))
    return prices.select("ticker", "trading_date", close.alias("close_price")).where(F.col("close_price").isNotNull())


def future_closes(prices: DataFrame, horizons: tuple[int, ...] = HORIZONS, seq: str | None = None) -> DataFrame:
    """(ticker, trading_date, close_price) with the close N trading rows ahead.

    Rows without a close are not trading days and are dropped before counting.  A day
    that is there twice would shift all horizons: pass ``seq``, or the job fails.
    """
    traded = trading_days(prices, seq)
    if seq is None:
        traded = traded.withColumn("close_price", once_a_day(F.col("close_price")))
    return traded.withColumns({
        f"future_close_{n}d": F.lead("close_price", n).over(series_window()) for n in horizons
    })


def forward_return(close: Column, future: Column) -> Column:
    """Relative change to a future close; NULL without one, or from a zero close."""
    return half_even(ratio(future - close, close), 8)


def went_up(change: Column) -> Column:
    """1 for a gain, 0 otherwise, NULL when unknown."""
    return F.when(change.isNotNull(), (change > 0).cast("int"))


def direction(change: Column) -> Column:
    """BUY above the upper threshold, SELL below the lower one, HOLD between them."""
    return (
        F.when(change > BUY_ABOVE, "BUY").when(change < SELL_BELOW, "SELL").when(change.isNotNull(), "HOLD")
    )


def price_labels(prices: DataFrame, seq: str | None = None) -> DataFrame:
    """(ticker, trading_date, close_price) and the thirteen label columns; ``seq`` as in :func:`future_closes`."""
    return with_labels(future_closes(prices, seq=seq))


def with_labels(closes: DataFrame) -> DataFrame:
    """Returns, up labels and direction beside ``close_price`` and the future closes."""
    returns = closes.withColumns({
        f"return_{n}d": forward_return(F.col("close_price"), F.col(f"future_close_{n}d")) for n in HORIZONS
    })
    return returns.withColumns(
        {f"label_up_{n}d": went_up(F.col(f"return_{n}d")) for n in HORIZONS}
        | {"label_direction": direction(F.col("return_5d"))}
    )


def label_features(features: DataFrame, prices: DataFrame, seq: str | None = None) -> DataFrame:
    """Feature rows with a close on their date, followed by the labels.

    A row whose later closes are missing stays; only those horizons are NULL.  ``seq`` as
    in :func:`future_closes`.
    """
    labels = price_labels(prices, seq).drop("close_price").withColumnRenamed("trading_date", "date")
    plain = [c for c in features.columns if c not in LABEL_COLUMNS]
    return features.select(*plain).join(labels, ["ticker", "date"], "inner").select(*plain, *LABEL_COLUMNS)


def without_close(features: DataFrame, prices: DataFrame, seq: str | None = None) -> DataFrame:
    """The feature rows that :func:`label_features` leaves out."""
    traded = trading_days(prices, seq).select("ticker", F.col("trading_date").alias("date"))
    return features.join(traded, ["ticker", "date"], "left_anti")
