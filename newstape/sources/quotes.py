"""Landed daily quote files turned into ``PRICE`` rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from newstape.errors import LoadError
from newstape.functions.text import ticker_symbol
from newstape.schemas import PRICE
from newstape.sources.files import typed

#: Header names of quote files.
REQUIRED = ["Open", "High", "Low", "Close", "Volume"]
ADJUSTED = ["Adj Close", "Adj. Close"]


def _number(name: str) -> Column:
    return typed(F.col(f"`{name}`"), T.DoubleType())


def normalised_quotes(quotes: DataFrame, ticker: str | Column, date_column: str = "Date") -> DataFrame:
    """Typed price rows.  The date is the date part as written, in the source's own zone.

    Rows with an unreadable date are dropped; a missing adjusted close falls back to the close.
    """
    missing = [c for c in [date_column, *REQUIRED] if c not in quotes.columns]
    if missing:
        raise LoadError(f"quotes lack required columns: {missing}; they have {quotes.columns}")
    adjusted = [_number(c) for c in ADJUSTED if c in quotes.columns][:1]
    day = typed(F.col(f"`{date_column}`"), T.DateType())
    symbol = ticker if isinstance(ticker, Column) else F.lit(ticker)
    return quotes.select(
        ticker_symbol(symbol).alias("ticker"),
        day.alias("trading_date"),
        _number("Open").alias("open_price"),
        _number("High").alias("high_price"),
        _number("Low").alias("low_price"),
        _number("Close").alias("close_price"),
        F.coalesce(*adjusted, _number("Close")).alias("adjusted_close"),
        typed(F.col("Volume"), T.LongType()).alias("volume"),
    ).where(F.col("trading_date").isNotNull() & (F.col("ticker") != "")).select(*PRICE.names)
