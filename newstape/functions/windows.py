"""Window specifications over one series per ticker.

All of them run on frames that hold one row per (ticker, day), so a series is
bounded by the calendar (about 250 trading rows a year) no matter how many
articles or trades stand behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec, functions as F


def series_window(order: str = "trading_date", key: str = "ticker") -> WindowSpec:
    return Window.partitionBy(key).orderBy(order)


def trailing_rows(rows: int, order: str = "trading_date", key: str = "ticker") -> WindowSpec:
    """The current row and the ``rows - 1`` before it."""
    return series_window(order, key).rowsBetween(-(rows - 1), 0)


def trailing_days(days: int, day: str = "date", key: str = "ticker") -> WindowSpec:
    """The calendar days ``[D - days + 1, D]``; days without a row simply are not there."""
    number = F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))
    return Window.partitionBy(key).orderBy(number).rangeBetween(-(days - 1), 0)


def full_frame(value: Column, aggregate: Column, rows: int, order: str = "trading_date") -> Column:
    """``aggregate`` over the trailing rows, NULL unless the frame holds ``rows`` values."""
    frame = trailing_rows(rows, order)
    return F.when(F.count(value).over(frame) == rows, aggregate.over(frame))


def last_of_day(prices: DataFrame, seq: str) -> DataFrame:
    """One row per (ticker, trading_date): the last by ``seq``, reduced on the map side."""
    rest = [c for c in prices.columns if c not in ("ticker", "trading_date")]
    one = prices.groupBy("ticker", "trading_date").agg(F.max_by(F.struct(*rest), F.col(seq)).alias("_row"))
    return one.select(*[F.col(c) if c not in rest else F.col(f"_row.{c}").alias(c) for c in prices.columns])


def once_a_day(value: Column) -> Column:
    """The value, or a failure where the row before it in the series is of the same day."""
    repeated = F.lag("trading_date").over(series_window()) == F.col("trading_date")
    message = F.concat_ws(" ", F.lit("more than one price row of"), F.col("ticker"), F.col("trading_date").cast("string"))
    return F.when(repeated, F.raise_error(message)).otherwise(value)
