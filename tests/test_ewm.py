"""Weighted means against pandas, with gaps, leading NULLs and small blocks."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest

from newstape.operators.ewm import Ewm, block_rows, ewm, ewm_long

SPECS = [("e10", 10), ("e26", 26), ("e9", 9)]


def series(seed, rows, gap_share, leading):
    rng = np.random.default_rng(seed)
    values = 100 + rng.normal(size=rows).cumsum()
    values[rng.random(rows) < gap_share] = np.nan
    values[:leading] = np.nan
    return values


def frame(spark, all_series):
    day = dt.date(2000, 1, 1)
    rows = [
        (name, day + dt.timedelta(days=i), None if math.isnan(v) else float(v))
        for name, values in all_series.items()
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, "ticker string, trading_date date, x double")


def by_fan_of_three(*args, **named):
    return ewm_long(*args, fan=3, **named)


@pytest.mark.parametrize("operator", [ewm, by_fan_of_three])
@pytest.mark.parametrize("limit", [7, 64, 2048])
def test_matches_pandas(spark, limit, operator):
    data = {
        "full": series(1, 400, 0.0, 0),
        "gaps": series(2, 400, 0.3, 0),
        "late": series(3, 300, 0.1, 40),
        "rare": series(4, 300, 0.9, 5),
        "none": np.full(30, np.nan),
        "one": np.array([5.0]),
    }
    data["hole"] = np.concatenate([series(5, 60, 0, 0), np.full(120, np.nan), series(6, 60, 0.2, 0)])
    out = operator(
        frame(spark, data),
        [[Ewm.span("x", name, span) for name, span in SPECS] + [Ewm.wilder("x", "w14", 14)]],
        limit=limit,
    ).toPandas().sort_values(["ticker", "trading_date"])
    for ticker, values in data.items():
        got = out[out.ticker == ticker]
        source = pd.Series(values)
        for name, span in SPECS:
            want = source.ewm(span=span, adjust=False, min_periods=span).mean()
            np.testing.assert_allclose(got[name].to_numpy(float), want.to_numpy(), rtol=1e-11, err_msg=f"{ticker} {name}")
        want = source.ewm(alpha=1 / 14, adjust=False, min_periods=14).mean()
        np.testing.assert_allclose(got["w14"].to_numpy(float), want.to_numpy(), rtol=1e-11, err_msg=ticker)


def test_groups_with_different_gaps(spark):
    a, b = series(7, 200, 0.2, 0), series(8, 200, 0.0, 30)
    left = frame(spark, {"t": a}).withColumnRenamed("x", "a")
    right = frame(spark, {"t": b}).withColumnRenamed("x", "b")
    out = ewm(left.join(right, ["ticker", "trading_date"]), [[Ewm.span("a", "ea", 5)], [Ewm.span("b", "eb", 12)]], limit=50)
    got = out.orderBy("trading_date").toPandas()
    for column, values, span in (("ea", a, 5), ("eb", b, 12)):
        want = pd.Series(values).ewm(span=span, adjust=False, min_periods=span).mean()
        np.testing.assert_allclose(got[column].to_numpy(float), want.to_numpy(), rtol=1e-11)


def test_a_long_series_is_split_over_tasks(spark):
    rows = 1_000_000
    x = "if(id % 97 = 5, NULL, 100 + 10 * sin(id / 1000) + (id * 2654435761 % 1000) / 100)"
    ticks = spark.range(rows).selectExpr("'t' AS ticker", "id AS trading_date", f"CAST({x} AS DOUBLE) AS x")
    out = ewm_long(ticks, [[Ewm.span("x", "e26", 26), Ewm.span("x", "e1000", 1000)]], fan=64)
    got = out.orderBy("trading_date").toPandas()
    source = ticks.orderBy("trading_date").toPandas()["x"]
    for name, span in (("e26", 26), ("e1000", 1000)):
        want = source.ewm(span=span, adjust=False, min_periods=span).mean()
        np.testing.assert_allclose(got[name].to_numpy(float), want.to_numpy(), rtol=1e-11)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning(ticker#" in plan  # only the maps of blocks meet by series


def test_blocks_never_overflow():
    assert block_rows([[Ewm.span("x", "y", 10)]]) == 2048
    fast = [[Ewm("x", "y", 0.9, 1)]]
    assert 0.1 ** block_rows(fast) > 0.0


def test_plan_has_one_shuffle(spark):
    out = ewm(frame(spark, {"t": series(1, 10, 0, 0)}), [[Ewm.span("x", "y", 3)]])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
