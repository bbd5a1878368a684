"""Registered queries: daily aggregates, calendar windows, indicators, labels, feature jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from newstape.checks import sql as S
from newstape.checks.views import (
    day_text, event_articles, event_prices, line_articles, line_prices, stored_articles, stored_sentiments, time_text,
)
from newstape.functions.numeric import half_even
from newstape.operators import daily, indicators, labels
from newstape.plans import dataset, features
from newstape.schemas import (
    DAILY_FEATURES, LABEL_COLUMNS, ROLLING_FEATURES, SENTIMENT_FEATURES, SOURCE_FEATURES, TECHNICAL_FEATURES,
    PRICE, VOLUME_WINDOW_FEATURES,
)
from newstape.session import fresh_path
from newstape.sources import files

#: wide enough to cover every row of the sample tables
FIRST, LAST = dt.date(1990, 1, 1), dt.date(2030, 12, 31)


def dated(spark, sf_dir) -> DataFrame:
    return line_articles(spark, sf_dir).withColumn("date", F.to_date("published_at"))


def with_day(df: DataFrame, column: str = "date") -> DataFrame:
    return df.withColumn(column, day_text(column))


def at_places(df: DataFrame, names: list[str]) -> DataFrame:
    """Indicators rounded for the comparison of two floating-point evaluation orders."""
    rounded: dict[str, Column] = {
        c: half_even(F.col(c) + float(S.OFF_TIE), 6) for c in names if c in df.columns
    }
    return df.withColumns(rounded)


def _daily(operator, columns):
    def build(spark, sf_dir):
        return with_day(operator(dated(spark, sf_dir)))

    text = S.with_ctes(
        "line_articles line_daily",
        f"SELECT ticker, CAST(date AS VARCHAR) AS date, {', '.join(S.daily_sql(c) for c in columns)} FROM line_daily",
    )
    return build, text


def _calendar(operator, columns):
    def build(spark, sf_dir):
        return with_day(operator(dated(spark, sf_dir)))

    text = S.with_ctes(
        "line_articles line_daily line_windows",
        f"SELECT ticker, CAST(date AS VARCHAR) AS date, {', '.join(S.daily_sql(c) for c in columns)} FROM line_windows",
    )
    return build, text


def _indicator(operator, columns):
    def build(spark, sf_dir):
        prices = line_prices(spark, sf_dir)
        return with_day(
            at_places(operator(prices).select("ticker", "trading_date", *columns), columns), "trading_date"
        )

    text = S.with_ctes(
        "line_prices series smoothed technical",
        "SELECT ticker, CAST(trading_date AS VARCHAR) AS trading_date, "
        + ", ".join(S.technical_sql(c) for c in columns) + " FROM technical",
    )
    return build, text


def _labels(columns, source):
    def build(spark, sf_dir):
        out = labels.price_labels(line_prices(spark, sf_dir))
        return with_day(out.select("ticker", "trading_date", *[_label_value(c) for c in columns]), "trading_date")

    text = S.with_ctes(
        "line_prices future returns labels_of",
        "SELECT ticker, CAST(trading_date AS VARCHAR) AS trading_date, "
        + ", ".join(_label_sql(c) for c in columns) + f" FROM {source}",
    )
    return build, text


def _label_value(name: str) -> Column:
    if name.startswith("label_up"):
        return F.col(name).cast("long").alias(name)
    return F.col(name)


def _label_sql(name: str) -> str:
    if name.startswith("label_up"):
        return f"CAST({name} AS BIGINT) AS {name}"
    return name


# --- feature and dataset jobs -----------------------------------------------------


def feature_rows(spark, sf_dir, start=FIRST, end=LAST) -> DataFrame:
    return features.feature_vectors(line_articles(spark, sf_dir), None, line_prices(spark, sf_dir), start, end)


def p1(spark, sf_dir):
    return with_day(at_places(feature_rows(spark, sf_dir), TECHNICAL_FEATURES))


def _feature_select(where: str = "") -> str:
    return (
        "SELECT d.ticker, CAST(d.date AS VARCHAR) AS date, "
        + ", ".join(S.daily_sql(c) for c in DAILY_FEATURES) + ", "
        + ", ".join(S.technical_sql(c, "t") for c in TECHNICAL_FEATURES)
        + " FROM line_windows d LEFT JOIN technical t ON t.ticker = d.ticker AND t.trading_date = d.date" + where
    )


FEATURE_CTES = "line_articles line_daily line_windows line_prices series smoothed technical"
P1_SQL = S.with_ctes(FEATURE_CTES, _feature_select())


def p1_event(spark, sf_dir):
    """The stored-table form: articles joined with the results of one model."""
    from newstape.checks.views import MODEL

    out = features.feature_vectors(
        stored_articles(spark, sf_dir), stored_sentiments(spark, sf_dir), event_prices(spark, sf_dir),
        dt.date(2024, 1, 1), dt.date(2024, 1, 31), model_name=MODEL,
    )
    return with_day(at_places(out, TECHNICAL_FEATURES))


#: the feature views again, over the event tables
EVENT_VIEWS = {
    "line_articles": """SELECT a.ticker, a.date, a.source_name, s.sentiment_label, s.sentiment_score
        FROM event_articles a JOIN stored_sentiments s USING (url) WHERE model_name = 'keyword-v1'""",
    "line_prices": "SELECT * FROM event_prices",
}
P1_EVENT_SQL = S.with_ctes("event_articles stored_sentiments event_prices", ", " + ", ".join(
    f"{name} AS ({EVENT_VIEWS.get(name) or S.CTES[name]})" for name in FEATURE_CTES.split()
) + _feature_select())


DAY = dt.date(1998, 6, 15)


def p2(spark, sf_dir):
    out = features.feature_vectors_for_day(line_articles(spark, sf_dir), None, line_prices(spark, sf_dir), DAY)
    return with_day(at_places(out, TECHNICAL_FEATURES))


P2_SQL = (
    S.with_ctes(FEATURE_CTES, _feature_select(f" WHERE d.date = DATE '{DAY}'"))
    .replace(
        "FROM line_prices WINDOW w AS (PARTITION BY ticker ORDER BY trading_date)",
        f"FROM line_prices WHERE trading_date BETWEEN DATE '{DAY}' - INTERVAL 90 DAYS AND DATE '{DAY}' "
        "WINDOW w AS (PARTITION BY ticker ORDER BY trading_date)",
    )
)


def _dataset_columns(df: DataFrame) -> DataFrame:
    names = [c for c in df.columns if c not in LABEL_COLUMNS]
    df = at_places(df, TECHNICAL_FEATURES)
    return with_day(df.select(*names, *[_label_value(c) for c in LABEL_COLUMNS]))


def p3(spark, sf_dir):
    return _dataset_columns(dataset.training_dataset(line_articles(spark, sf_dir), None, line_prices(spark, sf_dir), FIRST, LAST))


P3_SQL = S.with_ctes(
    FEATURE_CTES + " future returns labels_of",
    ", f AS (" + _feature_select() + ") SELECT f.*, " + ", ".join(_label_sql(c) for c in LABEL_COLUMNS)
    + " FROM f JOIN labels_of l ON l.ticker = f.ticker AND CAST(l.trading_date AS VARCHAR) = f.date",
)


def p4(spark, sf_dir):
    rows = daily.daily_features(dated(spark, sf_dir))
    return _dataset_columns(dataset.labelled_dataset_for_day(rows, line_prices(spark, sf_dir), DAY))


P4_SQL = S.with_ctes(
    "line_articles line_daily line_windows line_prices future returns labels_of",
    "SELECT d.ticker, CAST(d.date AS VARCHAR) AS date, " + ", ".join(S.daily_sql(c) for c in DAILY_FEATURES) + ", "
    + ", ".join(_label_sql(c) for c in LABEL_COLUMNS)
    + " FROM line_windows d JOIN labels_of l ON l.ticker = d.ticker AND l.trading_date = d.date",
).replace(
    "FROM line_prices WINDOW w",
    f"FROM line_prices WHERE trading_date BETWEEN DATE '{DAY}' AND DATE '{DAY}' + INTERVAL 14 DAYS WINDOW w",
)


def p5(spark, sf_dir):
    rows = daily.daily_sentiment(dated(spark, sf_dir)).select("ticker", "date", "article_count")
    return with_day(labels.label_features(rows, line_prices(spark, sf_dir)).select(
        "ticker", "date", "article_count", *[_label_value(c) for c in LABEL_COLUMNS]
    ))


P5_SQL = S.with_ctes(
    "line_articles line_daily line_prices future returns labels_of",
    "SELECT d.ticker, CAST(d.date AS VARCHAR) AS date, article_count, "
    + ", ".join(_label_sql(c) for c in LABEL_COLUMNS)
    + " FROM line_daily d JOIN labels_of l ON l.ticker = d.ticker AND l.trading_date = d.date",
)


def j4(spark, sf_dir):
    """All nineteen indicators on every article day."""
    rows = daily.daily_sentiment(dated(spark, sf_dir)).select("ticker", "date", "article_count")
    bars = indicators.technical_indicators(line_prices(spark, sf_dir))
    return with_day(at_places(indicators.at_dates(rows, bars), TECHNICAL_FEATURES))


J4_SQL = S.with_ctes(
    "line_articles line_daily line_prices series smoothed technical",
    "SELECT d.ticker, CAST(date AS VARCHAR) AS date, article_count, " + ", ".join(S.technical_sql(c, "t") for c in TECHNICAL_FEATURES)
    + " FROM line_daily d LEFT JOIN technical t ON t.ticker = d.ticker AND t.trading_date = d.date",
)


def w12(spark, sf_dir):
    """Every article day of the event tickers with the close's ten-day average on that day."""
    rows = event_articles(spark, sf_dir).select("ticker", F.to_date("published_at").alias("date")).distinct()
    bars = indicators.with_sma(event_prices(spark, sf_dir), (10,)).select("ticker", "trading_date", "sma_10")
    return with_day(indicators.at_dates(rows, bars))


W12_SQL = S.with_ctes(
    "event_articles event_prices",
    """, sma AS (SELECT ticker, trading_date, CASE WHEN row_number() OVER w >= 10
                     THEN avg(close_price) OVER (w ROWS 9 PRECEDING) END AS sma_10
              FROM event_prices WINDOW w AS (PARTITION BY ticker ORDER BY trading_date))
    SELECT a.ticker, CAST(a.date AS VARCHAR) AS date, """ + S.r("sma_10", 8) + """ AS sma_10
    FROM (SELECT DISTINCT ticker, date FROM event_articles) a
    LEFT JOIN sma ON sma.ticker = a.ticker AND sma.trading_date = a.date""",
)


def _twice(spark, sf_dir) -> DataFrame:
    """Prices where every third day of the month has an earlier, wrong row, and days of volume 2 a NaN close."""
    bars = line_prices(spark, sf_dir)
    wrong = bars.where(F.dayofmonth("trading_date") % 3 == 0).withColumns({
        "close_price": F.lit(1.0), "high_price": F.lit(2.0), "low_price": F.lit(0.5), "volume": F.lit(7).cast("long")})
    return bars.withColumn("seq", F.lit(2)).unionByName(wrong.withColumn("seq", F.lit(1)))


def w12_repeated(spark, sf_dir):
    """Repeated price days: the last row by ``seq`` counts, for the indicators and for the labels."""
    prices = _twice(spark, sf_dir)
    bars = indicators.technical_indicators(prices, seq="seq").select("ticker", "trading_date", "sma_10", "volume_avg_5d")
    closes = labels.future_closes(prices, (1, 5), seq="seq")
    out = at_places(bars, ["sma_10", "volume_avg_5d"]).join(closes, ["ticker", "trading_date"])
    return with_day(out, "trading_date")


W12_REPEATED_SQL = S.with_ctes(
    "line_prices series smoothed technical future",
    f"""SELECT t.ticker, CAST(t.trading_date AS VARCHAR) AS trading_date, {S.technical_sql('sma_10', 't')},
               {S.technical_sql('volume_avg_5d', 't')}, f.close_price, f.future_close_1d, f.future_close_5d
        FROM technical t JOIN future f ON f.ticker = t.ticker AND f.trading_date = t.trading_date""",
)


def w14_nan(spark, sf_dir):
    """Prices written as Parquet with NaN closes on days of an even volume, loaded and labelled: NaN is no close."""
    bars = line_prices(spark, sf_dir)
    close = F.when(F.col("volume") % 2 == 0, F.lit(float("nan"))).otherwise(F.col("close_price"))
    path = fresh_path(spark, "prices")
    bars.withColumn("close_price", close).write.parquet(path)
    landed = files.load_table(spark, path, PRICE, ("ticker", "trading_date"), "parquet")
    return with_day(labels.price_labels(landed).select(
        "ticker", "trading_date", "close_price", *[_label_value(c) for c in LABEL_COLUMNS]), "trading_date")


W14_NAN_SQL = S.with_ctes(
    "line_prices future returns labels_of",
    "SELECT ticker, CAST(trading_date AS VARCHAR) AS trading_date, close_price, "
    + ", ".join(_label_sql(c) for c in LABEL_COLUMNS) + " FROM labels_of",
).replace("FROM line_prices WINDOW w", "FROM line_prices WHERE volume % 2 <> 0 WINDOW w")


def j5(spark, sf_dir):
    """Matched and unmatched feature rows of the label join, told apart by one left join."""
    rows = daily.daily_sentiment(dated(spark, sf_dir)).select("ticker", "date")
    traded = labels.trading_days(line_prices(spark, sf_dir)).withColumnRenamed("trading_date", "date")
    return rows.join(traded, ["ticker", "date"], "left").groupBy("ticker").agg(
        F.count("close_price").alias("labelled"), F.count_if(F.col("close_price").isNull()).alias("skipped")
    )


J5_SQL = S.with_ctes(
    "line_articles line_daily line_prices",
    """SELECT d.ticker, count(p.ticker) AS labelled, count(*) FILTER (p.ticker IS NULL) AS skipped
       FROM line_daily d LEFT JOIN line_prices p ON p.ticker = d.ticker AND p.trading_date = d.date GROUP BY 1""",
)


def daily_means(spark, sf_dir):
    out = daily.daily_means(dated(spark, sf_dir))
    return with_day(out.withColumn("daily_mean", half_even(F.col("daily_mean"), 8)))


G3_SQL = S.with_ctes(
    "line_articles line_daily",
    "SELECT ticker, CAST(date AS VARCHAR) AS date, " + S.r("daily_mean", 8) + " AS daily_mean, daily_count FROM line_daily",
)


def c7(spark, sf_dir):
    from newstape.functions.text import utc_day

    out = event_articles(spark, sf_dir).select(
        "event_id", time_text("published_at").alias("published_at"), utc_day(F.col("published_at")).alias("date")
    )
    return with_day(out)


C7_SQL = S.with_ctes(
    "event_articles",
    """SELECT event_id, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at,
              CAST(date AS VARCHAR) AS date FROM event_articles""",
)


QUERIES = {
    "g1_daily_sentiment": _daily(daily.daily_sentiment, SENTIMENT_FEATURES),
    "g2_daily_sources": _daily(daily.daily_sources, SOURCE_FEATURES),
    "g3_daily_means": (daily_means, G3_SQL),
    "w1_article_volumes": _calendar(lambda a: daily.article_volumes(daily.daily_sentiment(a)), VOLUME_WINDOW_FEATURES),
    "w2_rolling_sentiment": _calendar(lambda a: daily.rolling_sentiment(daily.daily_means(a)), ROLLING_FEATURES),
    "w3_sma": _indicator(indicators.with_sma, ["sma_10", "sma_20"]),
    "w4_ema": _indicator(indicators.with_ema, ["ema_10", "ema_20"]),
    "w5_rsi": _indicator(indicators.with_rsi, ["rsi_14"]),
    "w6_macd": _indicator(indicators.with_macd, ["macd", "macd_signal", "macd_histogram"]),
    "w7_bollinger": _indicator(indicators.with_bollinger, ["bb_upper", "bb_lower", "bb_width"]),
    "w8_atr": _indicator(indicators.with_atr, ["atr_14"]),
    "w9_volatility": _indicator(indicators.with_volatility, ["volatility_20d"]),
    "w10_returns": _indicator(indicators.with_returns, ["price_chg_1d", "price_chg_5d", "price_chg_10d"]),
    "w11_volume": _indicator(indicators.with_volume, ["volume_change_pct", "volume_avg_5d", "volume_ratio"]),
    "w12_value_at_date": (w12, W12_SQL),
    "w12_repeated_day": (w12_repeated, W12_REPEATED_SQL),
    "w13_technical_bundle": _indicator(indicators.technical_indicators, TECHNICAL_FEATURES),
    "w14_future_closes": _labels([c for c in LABEL_COLUMNS if c.startswith("future")], "future"),
    "w14_nan_close": (w14_nan, W14_NAN_SQL),
    "l1_forward_returns": _labels([c for c in LABEL_COLUMNS if c.startswith("return")], "returns"),
    "l2_up_labels": _labels([c for c in LABEL_COLUMNS if c.startswith("label_up")], "labels_of"),
    "l3_direction": _labels(["label_direction"], "labels_of"),
    "j4_indicators_at_dates": (j4, J4_SQL),
    "j5_label_join": (j5, J5_SQL),
    "j6_rows_ahead": _labels(["future_close_5d", "return_5d"], "returns"),
    "c7_utc_day": (c7, C7_SQL),
    "p1_feature_vectors": (p1, P1_SQL),
    "p1_feature_vectors_stored": (p1_event, P1_EVENT_SQL),
    "p2_feature_vectors_day": (p2, P2_SQL),
    "p3_labelled_dataset": (p3, P3_SQL),
    "p4_labelled_dataset_day": (p4, P4_SQL),
    "p5_label_features": (p5, P5_SQL),
}
