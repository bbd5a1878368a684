import statistics

import numpy as np
import pandas as pd
import pytest

from helpers import bars, column, days
from newstape.operators import indicators as I
from newstape.schemas import TECHNICAL_FEATURES


def nulls(values):
    return sum(v is None for v in values)


def test_sma(spark):
    assert column(I.with_sma(bars(spark, [1, 2, 3, 4, 5]), (3,)), "sma_3") == [None, None, 2.0, 3.0, 4.0]


def test_sma_is_null_around_a_missing_close(spark):
    assert column(I.with_sma(bars(spark, [1, 2, None, 4, 5, 6]), (2,)), "sma_2") == [None, 1.5, None, None, 4.5, 5.5]


def test_ema_prefix_and_values(spark):
    closes = list(range(1, 25))
    got = column(I.with_ema(bars(spark, closes), (10,)), "ema_10")
    assert nulls(got) == 9 and all(v is None for v in got[:9])
    want = pd.Series(closes, dtype=float).ewm(span=10, adjust=False, min_periods=10).mean()
    np.testing.assert_allclose(got[9:], want[9:], atol=1e-8)


@pytest.mark.parametrize("closes,value", [(range(1, 30), 100.0), (range(29, 0, -1), 0.0), ([5] * 29, 100.0)])
def test_rsi_on_trends(spark, closes, value):
    got = column(I.with_rsi(bars(spark, list(closes))), "rsi_14")
    assert nulls(got) == 14 and got[14:] == [value] * 15


def test_rsi_stays_in_range(spark):
    rng = np.random.default_rng(3)
    got = column(I.with_rsi(bars(spark, list(100 + rng.normal(size=80).cumsum()))), "rsi_14")
    assert all(0 <= v <= 100 for v in got[14:])


def test_macd_prefixes(spark):
    rows = I.with_macd(bars(spark, [100 + i % 7 for i in range(60)])).orderBy("trading_date").collect()
    assert nulls([r["macd"] for r in rows]) == 25
    assert nulls([r["macd_signal"] for r in rows]) == 33 == nulls([r["macd_histogram"] for r in rows])
    last = rows[-1]
    assert last["macd_histogram"] == pytest.approx(last["macd"] - last["macd_signal"], abs=2e-8)


def test_bollinger_width(spark):
    closes = [10, 11, 9, 12, 8]
    row = I.with_bollinger(bars(spark, closes), rows=5).orderBy("trading_date").collect()[-1]
    assert row["bb_width"] == pytest.approx(4 * statistics.stdev(closes) / 10, abs=1e-8)
    assert row["bb_upper"] > 10 > row["bb_lower"]


def test_bollinger_width_is_null_for_zero_mean(spark):
    row = I.with_bollinger(bars(spark, [-1, 0, 1]), rows=3).orderBy("trading_date").collect()[-1]
    assert row["bb_width"] is None and row["bb_upper"] == 2.0


def test_atr_prefix(spark):
    got = column(I.with_atr(bars(spark, range(100, 130))), "atr_14")
    assert nulls(got) == 13 and got[13] is not None


def test_volatility_needs_twenty_one_rows(spark):
    assert column(I.with_volatility(bars(spark, range(100, 120))), "volatility_20d") == [None] * 20
    got = column(I.with_volatility(bars(spark, range(100, 121))), "volatility_20d")
    assert nulls(got) == 20 and got[20] > 0


def test_returns(spark):
    rows = I.with_returns(bars(spark, [100, 101, 102, 103, 104, 110])).orderBy("trading_date").collect()
    assert rows[5]["price_chg_5d"] == pytest.approx(0.1)
    assert rows[1]["price_chg_1d"] == pytest.approx(0.01)
    assert rows[5]["price_chg_10d"] is None


def test_returns_from_zero(spark):
    got = column(I.with_returns(bars(spark, [0, 5, 0, 0])), "price_chg_1d")
    assert got == [None, float("inf"), -1.0, None]


def test_returns_over_a_gap(spark):
    gap = bars(spark, [1, None, 2])
    assert column(I.with_returns(gap), "price_chg_1d") == [None, None, None]
    assert column(I.with_returns(gap, fill="pad"), "price_chg_1d") == [None, 0.0, 1.0]


def test_volume(spark):
    rows = I.with_volume(bars(spark, [1] * 5, volumes=[100, 200, 300, 400, 500])).orderBy("trading_date").collect()
    assert rows[4]["volume_avg_5d"] == 300.0 and rows[4]["volume_ratio"] == pytest.approx(5 / 3, abs=1e-8)
    assert rows[1]["volume_change_pct"] == 1.0


def test_zero_volume_average(spark):
    rows = I.with_volume(bars(spark, [1] * 5, volumes=[0] * 5)).orderBy("trading_date").collect()
    assert rows[4]["volume_avg_5d"] == 0.0 and rows[4]["volume_ratio"] is None


@pytest.mark.parametrize("fill", [None, "pad"])
def test_bundle_equals_the_parts(spark, fill):
    rng = np.random.default_rng(11)
    closes = [float(v) for v in 100 + rng.normal(size=120).cumsum()]
    for hole in (0, 40, 41, 90):
        closes[hole] = None
    prices = bars(spark, closes).unionByName(bars(spark, range(50, 90), "TSLA"))
    bundle = I.technical_indicators(prices, fill)
    parts = prices
    for add in (I.with_sma, I.with_ema, I.with_rsi, I.with_macd, I.with_bollinger, I.with_atr):
        parts = add(parts)
    for add in (I.with_volatility, I.with_returns, I.with_volume):
        parts = add(parts, fill=fill)
    order = ["ticker", "trading_date"]
    got = bundle.orderBy(*order).toPandas()[TECHNICAL_FEATURES].astype(float)
    want = parts.orderBy(*order).toPandas()[TECHNICAL_FEATURES].astype(float)
    pd.testing.assert_frame_equal(got, want, atol=1.01e-8, rtol=0)


def test_other_tickers_prices_leave_nulls(spark):
    wanted = spark.createDataFrame([("AAPL", days(3))], "ticker string, date date")
    row = I.at_dates(wanted, I.technical_indicators(bars(spark, range(60), "TSLA"))).collect()[0]
    assert all(row[c] is None for c in TECHNICAL_FEATURES)


def test_one_shuffle_and_two_sorts(spark):
    plan = I.technical_indicators(bars(spark, range(5)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 2
