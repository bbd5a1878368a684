"""Fixed schemas, column orders and thresholds."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: table layouts -------------------------------------------------

ARTICLE = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("source_id", T.StringType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("published_at", T.TimestampType()),
    T.StructField("content", T.StringType()),
    T.StructField("fetched_at", T.TimestampType()),
])

SENTIMENT_FIELDS = T.StructType([
    T.StructField("sentiment_label", T.StringType()),
    T.StructField("sentiment_score", T.IntegerType()),
    T.StructField("sentiment_confidence", T.DoubleType()),
    T.StructField("analysed_at", T.TimestampType()),
])

ENRICHED_ARTICLE = T.StructType(ARTICLE.fields + SENTIMENT_FIELDS.fields)

SENTIMENT_RESULT = T.StructType(
    [T.StructField("article_id", T.StringType()), T.StructField("model_name", T.StringType())]
    + SENTIMENT_FIELDS.fields
)

PRICE = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("trading_date", T.DateType()),
    T.StructField("open_price", T.DoubleType()),
    T.StructField("high_price", T.DoubleType()),
    T.StructField("low_price", T.DoubleType()),
    T.StructField("close_price", T.DoubleType()),
    T.StructField("adjusted_close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
])

FEED_ITEM = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("datetime", T.LongType()),
    T.StructField("headline", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("url", T.StringType()),
])

ARCHIVE_ITEM = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("seendate", T.StringType()),
    T.StructField("domain", T.StringType()),
])

ARCHIVE_PAYLOAD = T.StructType([T.StructField("articles", T.ArrayType(ARCHIVE_ITEM))])

# --- fixed values: feature, label and prediction columns --------------------------

SENTIMENT_FEATURES = [
    "article_count", "positive_count", "neutral_count", "negative_count",
    "positive_ratio", "neutral_ratio", "negative_ratio",
    "mean_sentiment_score", "sentiment_score_std", "sentiment_score_min", "sentiment_score_max",
]
SOURCE_FEATURES = [
    "unique_source_count", "yahoo_article_count", "benzinga_article_count", "cnbc_article_count",
]
VOLUME_WINDOW_FEATURES = ["articles_last_24h", "articles_last_3d", "articles_last_7d"]
ROLLING_FEATURES = [
    "rolling_3d_mean_sentiment", "rolling_7d_mean_sentiment",
    "rolling_3d_article_volume", "rolling_7d_article_volume",
]
TECHNICAL_FEATURES = [
    "sma_10", "sma_20", "ema_10", "ema_20",
    "rsi_14", "macd", "macd_signal", "macd_histogram",
    "bb_upper", "bb_lower", "bb_width", "atr_14", "volatility_20d",
    "price_chg_1d", "price_chg_5d", "price_chg_10d",
    "volume_change_pct", "volume_avg_5d", "volume_ratio",
]
DAILY_FEATURES = SENTIMENT_FEATURES + SOURCE_FEATURES + VOLUME_WINDOW_FEATURES + ROLLING_FEATURES
FEATURE_COLUMNS = ["ticker", "date"] + DAILY_FEATURES + TECHNICAL_FEATURES

HORIZONS = (1, 3, 5, 7)
LABEL_COLUMNS = (
    [f"future_close_{n}d" for n in HORIZONS]
    + [f"return_{n}d" for n in HORIZONS]
    + [f"label_up_{n}d" for n in HORIZONS]
    + ["label_direction"]
)
DIRECTIONS = ["BUY", "HOLD", "SELL"]
BUY_ABOVE = 0.02
SELL_BELOW = -0.02

SENTIMENT_SCORES = {"positive": 1, "neutral": 0, "negative": -1}
SOURCE_KEYWORDS = ["yahoo", "benzinga", "cnbc"]
COMPANY_PHRASES = {
    "AAPL": "Apple Inc", "TSLA": "Tesla", "NVDA": "NVIDIA", "MSFT": "Microsoft", "AMZN": "Amazon",
}
ARCHIVE_REQUEST_CAP = 250
ARCHIVE_CHUNK_DAYS = 7
PRICE_WARMUP_DAYS = 90
ARTICLE_LOOKBACK_DAYS = 7
LABEL_LOOKAHEAD_DAYS = 14

# --- end of fixed values ----------------------------------------------------------

_INT_FEATURES = {
    "article_count", "positive_count", "neutral_count", "negative_count",
    "sentiment_score_min", "sentiment_score_max", *SOURCE_FEATURES, *VOLUME_WINDOW_FEATURES,
    "rolling_3d_article_volume", "rolling_7d_article_volume",
}


def _feature_field(name: str) -> T.StructField:
    if name == "ticker":
        return T.StructField(name, T.StringType())
    if name == "date":
        return T.StructField(name, T.DateType())
    return T.StructField(name, T.LongType() if name in _INT_FEATURES else T.DoubleType())


def _label_field(name: str) -> T.StructField:
    if name == "label_direction":
        return T.StructField(name, T.StringType())
    return T.StructField(name, T.IntegerType() if name.startswith("label_up") else T.DoubleType())


FEATURES = T.StructType([_feature_field(c) for c in FEATURE_COLUMNS])
DATASET = T.StructType(FEATURES.fields + [_label_field(c) for c in LABEL_COLUMNS])
