"""Technical indicators over one daily price series per ticker.

Input: one row per (ticker, trading_date) with the ``PRICE`` columns.  Every
function adds columns to the frame it is given; :func:`technical_indicators`
shares one partitioning by ticker between all nineteen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from newstape.functions.numeric import half_even, null_if_nan, pct_change, ratio
from newstape.functions.windows import full_frame, last_of_day, series_window
from newstape.operators.ewm import Ewm, block_rows, ewm, row_numbers, smooth
from newstape.schemas import TECHNICAL_FEATURES

CLOSE, HIGH, LOW, VOLUME = "close_price", "high_price", "low_price", "volume"


def _num(name: str) -> Column:
    return null_if_nan(F.col(name).cast("double"))


def _published(df: DataFrame, columns: dict[str, Column], keep: list[str]) -> DataFrame:
    """Round the finished indicators and drop the helper columns."""
    return df.select(*keep, *[half_even(null_if_nan(c), 8).alias(name) for name, c in columns.items()])


def with_sma(prices: DataFrame, windows: tuple[int, ...] = (10, 20)) -> DataFrame:
    """Simple moving averages ``sma_<n>`` of the close."""
    close = _num(CLOSE)
    return _published(
        prices, {f"sma_{n}": full_frame(close, F.avg(close), n) for n in windows}, prices.columns
    )


def with_ema(prices: DataFrame, spans: tuple[int, ...] = (10, 20)) -> DataFrame:
    """Exponential moving averages ``ema_<span>`` of the close, seeded with the first close."""
    keep = prices.columns
    out = ewm(prices.withColumn("_c", _num(CLOSE)), [[Ewm.span("_c", f"ema_{n}", n) for n in spans]])
    return _published(out, {f"ema_{n}": F.col(f"ema_{n}") for n in spans}, keep)


def _moves(prices: DataFrame) -> DataFrame:
    """Daily gain and loss of the close; NULL where either day has no close."""
    delta = _num(CLOSE) - F.lag(_num(CLOSE)).over(series_window())
    return prices.withColumn("_delta", delta).withColumns({
        "_gain": F.when(F.col("_delta").isNotNull(), F.greatest(F.col("_delta"), F.lit(0.0))),
        "_loss": F.when(F.col("_delta").isNotNull(), F.greatest(-F.col("_delta"), F.lit(0.0))),
    })


def _rsi_value(gain: Column, loss: Column) -> Column:
    return F.when(loss == 0, F.lit(100.0)).otherwise(100.0 - F.try_divide(F.lit(100.0), 1.0 + ratio(gain, loss)))


def with_rsi(prices: DataFrame, period: int = 14) -> DataFrame:
    """Relative strength index with Wilder smoothing; 100 where nothing was lost."""
    keep = prices.columns
    out = ewm(
        _moves(prices),
        [[Ewm.wilder("_gain", "_ag", period), Ewm.wilder("_loss", "_al", period)]],
    )
    return _published(out, {f"rsi_{period}": _rsi_value(F.col("_ag"), F.col("_al"))}, keep)


def with_macd(prices: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    """MACD line, its signal line, and their difference."""
    keep = prices.columns
    out = ewm(
        prices.withColumn("_c", _num(CLOSE)),
        [[Ewm.span("_c", "_fast", fast), Ewm.span("_c", "_slow", slow)]],
    ).withColumn("_line", F.col("_fast") - F.col("_slow"))
    out = ewm(out, [[Ewm.span("_line", "_signal", signal)]])
    return _published(
        out,
        {
            "macd": F.col("_line"),
            "macd_signal": F.col("_signal"),
            "macd_histogram": F.col("_line") - F.col("_signal"),
        },
        keep,
    )


def with_bollinger(prices: DataFrame, rows: int = 20, width: float = 2.0) -> DataFrame:
    """Bollinger bands around the simple moving average, and their relative width."""
    keep, close = prices.columns, _num(CLOSE)
    out = prices.withColumns({
        "_middle": full_frame(close, F.avg(close), rows),
        "_spread": full_frame(close, F.stddev_samp(close), rows) * width,
    })
    upper, lower = F.col("_middle") + F.col("_spread"), F.col("_middle") - F.col("_spread")
    return _published(
        out, {"bb_upper": upper, "bb_lower": lower, "bb_width": ratio(upper - lower, F.col("_middle"))}, keep
    )


def _true_range(prices: DataFrame) -> DataFrame:
    before = F.lag(_num(CLOSE)).over(series_window())
    high, low = _num(HIGH), _num(LOW)
    return prices.withColumn("_before", before).withColumn(
        "_range",
        F.greatest(high - low, F.abs(high - F.col("_before")), F.abs(low - F.col("_before"))),
    )


def with_atr(prices: DataFrame, period: int = 14) -> DataFrame:
    """Average true range with Wilder smoothing."""
    keep = prices.columns
    out = ewm(_true_range(prices), [[Ewm.wilder("_range", "_atr", period)]])
    return _published(out, {f"atr_{period}": F.col("_atr")}, keep)


def _level(name: str, fill: str | None) -> Column:
    """A value for percentage changes: as it is, or the last known one (``fill="pad"``)."""
    if fill is None:
        return _num(name)
    if fill == "pad":
        return F.last(_num(name), ignorenulls=True).over(series_window().rowsBetween(Window.unboundedPreceding, 0))
    raise ValueError("fill is None or 'pad'")


def with_volatility(prices: DataFrame, rows: int = 20, fill: str | None = None) -> DataFrame:
    """Sample standard deviation of the last ``rows`` one-row returns."""
    keep = prices.columns
    out = prices.withColumn("_c", _level(CLOSE, fill))
    out = out.withColumn("_ret", pct_change(F.col("_c"), F.lag("_c").over(series_window())))
    ret = F.col("_ret")
    return _published(out, {f"volatility_{rows}d": full_frame(ret, F.stddev_samp(ret), rows)}, keep)


def with_returns(prices: DataFrame, lags: tuple[int, ...] = (1, 5, 10), fill: str | None = None) -> DataFrame:
    """Relative change of the close against 1, 5 and 10 trading rows before."""
    keep = prices.columns
    out = prices.withColumn("_c", _level(CLOSE, fill))
    return _published(
        out,
        {f"price_chg_{n}d": pct_change(F.col("_c"), F.lag("_c", n).over(series_window())) for n in lags},
        keep,
    )


def with_volume(prices: DataFrame, rows: int = 5, fill: str | None = None) -> DataFrame:
    """Volume change, trailing average, and volume relative to that average."""
    keep = prices.columns
    out = prices.withColumn("_v", _level(VOLUME, fill)).withColumn("_raw", _num(VOLUME))
    average = full_frame(F.col("_raw"), F.avg("_raw"), rows)
    return _published(
        out,
        {
            "volume_change_pct": pct_change(F.col("_v"), F.lag("_v").over(series_window())),
            f"volume_avg_{rows}d": average,
            "volume_ratio": ratio(F.col("_raw"), average),
        },
        keep,
    )


#: The means behind the bundle: four over the close, two over its moves, one over the range, then the signal.
MEANS = [
    [Ewm.span("_c", "ema_10", 10), Ewm.span("_c", "ema_20", 20), Ewm.span("_c", "_fast", 12), Ewm.span("_c", "_slow", 26)],
    [Ewm.wilder("_gain", "_ag", 14), Ewm.wilder("_loss", "_al", 14)],
    [Ewm.wilder("_range", "atr_14", 14)],
]
SIGNAL = [[Ewm.span("macd", "macd_signal", 9)]]


def _frame(aggregate: str, value: str, rows: int, order: str = "trading_date") -> str:
    """SQL of a trailing-row aggregate that is NULL until the frame is full."""
    over = f"(PARTITION BY ticker ORDER BY {order} ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    return f"if(count({value}) OVER {over} = {rows}, {aggregate}({value}) OVER {over}, NULL)"


def technical_indicators(
    prices: DataFrame, fill: str | None = None, seq: str | None = None, ahead: tuple[int, ...] = ()
) -> DataFrame:
    """(ticker, trading_date) and the nineteen indicators of ``TECHNICAL_FEATURES``.

    A repeated day keeps its last row by ``seq``; without ``seq`` it fails the job.
    ``ahead`` adds ``close_price`` and ``future_close_<n>d``, the close n trading rows on
    (rows without a close are not counted), out of the same pass over the prices.

    One shuffle by ticker and two sorts serve all of them: the first pass numbers
    the rows and takes everything that looks at raw prices, the later ones run in
    the (ticker, block, date) order of the weighted means.
    """
    by_day = "PARTITION BY ticker ORDER BY trading_date"
    over, known = f"({by_day})", f"({by_day} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    if seq is not None:
        prices = last_of_day(prices, seq)
    df = prices.select(
        "ticker", "trading_date",
        _num(CLOSE).alias("_c"), _num(HIGH).alias("_h"), _num(LOW).alias("_l"), _num(VOLUME).alias("_raw"),
    )
    if fill == "pad":
        df = df.selectExpr("*", f"last_value(_c, true) OVER {known} AS _level", f"last_value(_raw, true) OVER {known} AS _v")
    elif fill is None:
        df = df.selectExpr("*", "_c AS _level", "_raw AS _v")
    else:
        raise ValueError("fill is None or 'pad'")

    rows = block_rows(MEANS + SIGNAL)
    df = df.selectExpr(
        "*",
        row_numbers(),
        f"if(lag(trading_date) OVER {over} = trading_date, raise_error(concat_ws(' ', 'more than one price row of', ticker, "
        f"string(trading_date))), lag(_c) OVER {over}) AS _before",
        *[f"lag(_level, {n}) OVER {over} AS _back{n}" for n in (1, 5, 10)],
        f"lag(_v) OVER {over} AS _vback",
        f"{_frame('avg', '_c', 10)} AS sma_10",
        f"{_frame('avg', '_c', 20)} AS sma_20",
        f"{_frame('stddev_samp', '_c', 20)} * 2D AS _spread",
        f"{_frame('avg', '_raw', 5)} AS volume_avg_5d",
        *[f"lead(_c, {n}) IGNORE NULLS OVER {over} AS future_close_{n}d" for n in ahead],
    )
    df = df.selectExpr(
        "*",
        f"(_pos - 1) DIV {rows} AS _blk",
        "if(_c IS NOT NULL AND _before IS NOT NULL, greatest(_c - _before, 0D), NULL) AS _gain",
        "if(_c IS NOT NULL AND _before IS NOT NULL, greatest(_before - _c, 0D), NULL) AS _loss",
        "greatest(_h - _l, abs(_h - _before), abs(_l - _before)) AS _range",
    )
    df = df.withColumn("price_chg_1d", pct_change(F.col("_level"), F.col("_back1")))
    df = smooth(df, MEANS, rows)
    df = df.selectExpr(
        "*",
        "_fast - _slow AS macd",
        f"{_frame('stddev_samp', 'price_chg_1d', 20, '_blk, trading_date')} AS volatility_20d",
    )
    df = smooth(df, SIGNAL, rows)
    upper, lower = F.col("sma_20") + F.col("_spread"), F.col("sma_20") - F.col("_spread")
    derived = {
        "rsi_14": _rsi_value(F.col("_ag"), F.col("_al")),
        "macd_histogram": F.col("macd") - F.col("macd_signal"),
        "bb_upper": upper,
        "bb_lower": lower,
        "bb_width": ratio(upper - lower, F.col("sma_20")),
        "price_chg_5d": pct_change(F.col("_level"), F.col("_back5")),
        "price_chg_10d": pct_change(F.col("_level"), F.col("_back10")),
        "volume_change_pct": pct_change(F.col("_v"), F.col("_vback")),
        "volume_ratio": ratio(F.col("_raw"), F.col("volume_avg_5d")),
    }
    return _published(
        df,
        {name: derived[name] if name in derived else F.col(name) for name in TECHNICAL_FEATURES},
        ["ticker", "trading_date", *([F.col("_c").alias("close_price")] if ahead else []), *[f"future_close_{n}d" for n in ahead]],
    )


def at_dates(wanted: DataFrame, indicators: DataFrame) -> DataFrame:
    """Attach indicator values to (ticker, date) rows; NULL where that day has no price row."""
    return wanted.join(indicators.withColumnRenamed("trading_date", "date"), ["ticker", "date"], "left")
