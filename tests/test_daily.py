import pytest
from pyspark.sql import functions as F

from helpers import DAY, articles, days, one
from newstape.operators import daily


def test_counts_ratios_and_spread(spark):
    row = one(daily.daily_sentiment(articles(spark, [
        ("AAPL", 0, "positive"), ("AAPL", 0, "positive"), ("AAPL", 0, "negative"), ("AAPL", 0, "neutral"),
    ])))
    assert (row["article_count"], row["positive_count"], row["neutral_count"], row["negative_count"]) == (4, 2, 1, 1)
    assert (row["positive_ratio"], row["neutral_ratio"], row["negative_ratio"]) == (0.5, 0.25, 0.25)
    assert row["mean_sentiment_score"] == 0.25
    assert row["sentiment_score_std"] == pytest.approx(0.957427)
    assert (row["sentiment_score_min"], row["sentiment_score_max"]) == (-1, 1)


def test_single_article_has_no_spread(spark):
    assert one(daily.daily_sentiment(articles(spark, [("AAPL", 0, "positive")])))["sentiment_score_std"] == 0.0


def test_sources_match_case_insensitively_and_skip_null(spark):
    row = one(daily.daily_sources(articles(spark, [
        ("AAPL", 0, "positive", "Yahoo Finance"), ("AAPL", 0, "positive", "yahoo_finance"),
        ("AAPL", 0, "positive", "BENZINGA"), ("AAPL", 0, "positive", "CNBC"), ("AAPL", 0, "positive", None),
    ])))
    assert row["unique_source_count"] == 4
    assert (row["yahoo_article_count"], row["benzinga_article_count"], row["cnbc_article_count"]) == (2, 1, 1)


def on_day(df):
    return one(df.where(F.col("date") == F.lit(DAY)))


def test_eighth_day_is_outside_the_week(spark):
    rows = articles(spark, [("AAPL", 0, "neutral"), ("AAPL", -6, "neutral"), ("AAPL", -7, "neutral"), ("AAPL", -2, "neutral")])
    row = on_day(daily.article_volumes(daily.daily_sentiment(rows)))
    assert (row["articles_last_24h"], row["articles_last_3d"], row["articles_last_7d"]) == (1, 2, 3)


def test_rolling_mean_weighs_days_equally(spark):
    rows = articles(spark, [("AAPL", -1, "positive")] * 3 + [("AAPL", 0, "negative")])
    row = on_day(daily.rolling_sentiment(daily.daily_means(rows)))
    assert row["rolling_3d_mean_sentiment"] == 0.0
    assert row["rolling_3d_article_volume"] == 4


def test_tickers_do_not_mix(spark):
    rows = articles(spark, [("AAPL", 0, "positive"), ("TSLA", -1, "negative"), ("TSLA", 0, "negative")])
    out = {r["ticker"]: r for r in daily.daily_features(rows).where(F.col("date") == F.lit(DAY)).collect()}
    assert out["AAPL"]["articles_last_7d"] == 1 and out["TSLA"]["articles_last_7d"] == 2
    assert out["AAPL"]["rolling_7d_mean_sentiment"] == 1.0


def test_bundle_equals_the_parts(spark):
    rows = articles(spark, [("AAPL", -d, ["positive", "neutral", "negative"][d % 3], ["CNBC", None][d % 2]) for d in range(12)] * 2)
    bundle = daily.daily_features(rows)
    parts = daily.daily_sentiment(rows)
    for other in (
        daily.daily_sources(rows), daily.article_volumes(daily.daily_sentiment(rows)),
        daily.rolling_sentiment(daily.daily_means(rows)),
    ):
        parts = parts.join(other, ["ticker", "date"])
    parts = parts.select(*bundle.columns)
    assert bundle.exceptAll(parts).isEmpty() and parts.exceptAll(bundle).isEmpty()
    assert bundle.count() == 12 and days(0) == DAY
