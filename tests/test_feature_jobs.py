import datetime as dt

import pytest

from helpers import bars
from newstape.errors import FeatureError, LabelError
from newstape.plans import dataset, features
from newstape.schemas import FEATURE_COLUMNS, FEATURES, LABEL_COLUMNS, TECHNICAL_FEATURES

START, END = dt.date(2026, 3, 2), dt.date(2026, 3, 6)
ENRICHED = "ticker string, source_name string, published_at timestamp, sentiment_label string, sentiment_score int, sentiment_confidence double"


def seeded(spark):
    rows = [
        (t, "CNBC", dt.datetime(2026, 3, 2 + d, 9 + i), ["positive", "neutral", "negative"][i], 1 - i, 0.9)
        for t in ("AAPL", "TSLA") for d in range(5) for i in range(3)
    ]
    return spark.createDataFrame(rows, ENRICHED)


def prices(spark):
    start = START - dt.timedelta(days=100)
    return bars(spark, [150.5 + i for i in range(140)], "AAPL", start=start).unionByName(
        bars(spark, [200.5 + i for i in range(140)], "TSLA", start=start))


def test_range_has_a_row_per_article_day(spark):
    out = features.feature_vectors(seeded(spark), None, prices(spark), START, END)
    assert out.columns == FEATURE_COLUMNS and out.schema.names == FEATURES.names
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in FEATURES.fields]
    rows = out.orderBy("ticker", "date").collect()
    assert len(rows) == 10 and all(r["macd_signal"] is not None for r in rows)
    assert [r["articles_last_7d"] for r in rows[:5]] == [3, 6, 9, 12, 15]


def test_single_day_equals_one_day_range(spark):
    one_day = features.feature_vectors_for_day(seeded(spark), None, prices(spark), START)
    ranged = features.feature_vectors(seeded(spark), None, prices(spark), START, START)
    assert one_day.exceptAll(ranged).isEmpty() and one_day.count() == 2


def test_history_start_seeds_the_means(spark):
    day = END
    from_day = features.feature_vectors_for_day(seeded(spark), None, prices(spark), day).orderBy("ticker").first()
    from_range = features.feature_vectors(seeded(spark), None, prices(spark), START, day).where(f"date = '{day}'").orderBy("ticker").first()
    assert from_day["sma_20"] == from_range["sma_20"]
    assert from_day["ema_20"] != from_range["ema_20"]  # loaded from another first day


def test_start_after_end(spark):
    with pytest.raises(ValueError):
        features.feature_vectors(seeded(spark), None, None, END, START)


def test_no_articles_gives_the_empty_schema(spark):
    out = features.feature_vectors(seeded(spark), None, prices(spark), dt.date(2020, 1, 1), dt.date(2020, 1, 2))
    assert out.isEmpty() and out.columns == FEATURE_COLUMNS


def test_without_prices_the_indicators_are_null(spark):
    row = features.feature_vectors(seeded(spark), None, None, START, END, ["aapl"]).first()
    assert row["ticker"] == "AAPL" and all(row[c] is None for c in TECHNICAL_FEATURES)


def test_dataset_job(spark):
    rows = features.feature_vectors(seeded(spark), None, prices(spark), START, END)
    out = dataset.labelled_dataset(rows, prices(spark))
    assert out.columns == FEATURE_COLUMNS + LABEL_COLUMNS and out.count() == 10
    assert out.where("return_7d IS NULL").isEmpty()
    given = dataset.labelled_dataset(rows, prices(spark), START, END)
    assert given.exceptAll(out).isEmpty()


def test_training_dataset_is_the_labelled_features(spark):
    rows = features.feature_vectors(seeded(spark), None, prices(spark), START, END)
    apart = dataset.labelled_dataset(rows, prices(spark), START, END)
    once = dataset.training_dataset(seeded(spark), None, prices(spark), START, END)
    assert once.columns == apart.columns and not once.isEmpty()
    assert once.exceptAll(apart).isEmpty() and apart.exceptAll(once).isEmpty()
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lead(") > 0


def test_shuffles_of_the_feature_join(spark):
    out = features.feature_vectors(seeded(spark), None, prices(spark), START, END)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = features.feature_vectors(seeded(spark), None, prices(spark), START, END)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # two levels of the distinct count, one by ticker for each side's windows, and the join by ticker and day,
    # which spreads a busy ticker
    assert plan.count("Exchange hashpartitioning") == 6 and out.columns == FEATURE_COLUMNS


def test_jobs_write_and_check(spark, tmp_path):
    written = features.feature_job(seeded(spark), None, prices(spark), START, END, str(tmp_path))
    assert written.count() == 10 and written.schema == FEATURES
    labelled = dataset.dataset_job(written, prices(spark), str(tmp_path), by_month=True)
    assert labelled.count() == 10 and labelled.columns == FEATURE_COLUMNS + LABEL_COLUMNS
    quiet = dt.date(2020, 1, 1)
    with pytest.raises(FeatureError):
        features.feature_job(seeded(spark), None, prices(spark), quiet, quiet, str(tmp_path))
    nothing = features.feature_job(seeded(spark), None, None, quiet, dt.date(2020, 1, 2), str(tmp_path))
    assert nothing.isEmpty() and nothing.columns == FEATURE_COLUMNS
    with pytest.raises(LabelError):
        dataset.dataset_job(written, bars(spark, [1, 2], start=quiet), str(tmp_path / "x"))
