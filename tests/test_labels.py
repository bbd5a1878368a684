import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import DAY, bars, days, one
from newstape.errors import LabelError
from newstape.operators import labels
from newstape.plans import dataset
from newstape.schemas import LABEL_COLUMNS


def features(spark, rows):
    return spark.createDataFrame(rows, "ticker string, date date, article_count long")


def labelled(spark, closes, **options):
    return one(labels.label_features(features(spark, [("AAPL", DAY, 1)]), bars(spark, closes, **options)))


def test_return(spark):
    row = labelled(spark, [100, 101])
    assert row["return_1d"] == 0.01 and row["label_up_1d"] == 1


@pytest.mark.parametrize("rows,known", [(2, {1}), (3, {1}), (4, {1, 3}), (5, {1, 3}), (6, {1, 3, 5}), (8, {1, 3, 5, 7})])
def test_partial_horizons_keep_the_row(spark, rows, known):
    row = labelled(spark, [100 + i for i in range(rows)])
    assert {n for n in (1, 3, 5, 7) if row[f"return_{n}d"] is not None} == known
    assert (row["label_direction"] is not None) == (5 in known)


@pytest.mark.parametrize("last,way", [(102.1, "BUY"), (97.9, "SELL"), (102.0, "HOLD"), (98.0, "HOLD"), (100.0, "HOLD")])
def test_direction_thresholds_are_strict(spark, last, way):
    assert labelled(spark, [100, 1, 1, 1, 1, last])["label_direction"] == way


def test_no_move_is_not_up(spark):
    assert labelled(spark, [100, 100])["label_up_1d"] == 0


def test_zero_close_has_no_returns(spark):
    row = labelled(spark, [0, 5])
    assert row["future_close_1d"] == 5.0 and row["return_1d"] is None and row["label_up_1d"] is None


def test_days_without_close_are_not_trading_days(spark):
    assert labelled(spark, [100, None, 110])["future_close_1d"] == 110.0


def test_missing_close_today(spark):
    rows = features(spark, [("AAPL", DAY - dt.timedelta(days=365), 1)])
    out = labels.label_features(rows, bars(spark, [1, 2]))
    with pytest.raises(LabelError, match="No labeled rows"):
        dataset.require_labels(out)
    assert labels.without_close(rows, bars(spark, [1, 2])).count() == 1


def test_ticker_case_matters(spark):
    assert labels.label_features(features(spark, [("aapl", DAY, 1)]), bars(spark, [1, 2])).isEmpty()


def test_labels_come_last_in_order(spark):
    out = labels.label_features(features(spark, [("AAPL", DAY, 1)]), bars(spark, [1, 2]))
    assert out.columns == ["ticker", "date", "article_count"] + LABEL_COLUMNS


def test_range_needs_no_dates_and_bounds_the_prices(spark):
    rows = features(spark, [("AAPL", days(0), 1), ("AAPL", days(20), 1)])
    sparse = bars(spark, [100, 101]).unionByName(bars(spark, [120, 121, 122], start=days(20))).unionByName(
        bars(spark, [150], start=days(60))
    )
    out = {r["date"]: r for r in dataset.labelled_dataset(rows, sparse).collect()}
    assert out[days(0)]["future_close_3d"] == 121.0
    assert out[days(20)]["future_close_3d"] is None  # day 60 lies past the look-ahead


def test_single_day_drops_older_rows(spark):
    rows = features(spark, [("AAPL", days(0), 1), ("AAPL", days(2), 1)])
    out = dataset.labelled_dataset_for_day(rows, bars(spark, [1, 2, 3, 4]))
    assert [r["date"] for r in out.collect()] == [days(2)]
    assert out.where(F.col("return_1d").isNull()).isEmpty()
