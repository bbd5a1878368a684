"""Small frames for the operator tests."""

import datetime as dt

ARTICLES = "ticker string, date date, source_name string, sentiment_label string, sentiment_score int"
BARS = "ticker string, trading_date date, open_price double, high_price double, low_price double, close_price double, adjusted_close double, volume long"
DAY = dt.date(2026, 6, 16)
SCORES = {"positive": 1, "neutral": 0, "negative": -1}


def days(n):
    return DAY + dt.timedelta(days=n)


def articles(spark, rows):
    """rows: (ticker, day offset, label[, source])"""
    data = [(r[0], days(r[1]), r[3] if len(r) > 3 else "Reuters", r[2], SCORES[r[2]]) for r in rows]
    return spark.createDataFrame(data, ARTICLES)


def bars(spark, closes, ticker="AAPL", volumes=None, start=DAY):
    rows = []
    for i, c in enumerate(closes):
        v = volumes[i] if volumes else 1_000_000
        if c is None:
            rows.append((ticker, start + dt.timedelta(days=i), None, None, None, None, None, v))
        else:
            c = float(c)
            rows.append((ticker, start + dt.timedelta(days=i), c, c + 1, c - 1, c, c, v))
    return spark.createDataFrame(rows, BARS)


def column(df, name, order="trading_date"):
    return [r[name] for r in df.orderBy(order).collect()]


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0].asDict()
