"""Coercion of article and sentiment records before they are stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newstape.functions.numeric import null_if_nan
from newstape.functions.text import article_key, lenient_timestamp, ticker_symbol
from newstape.schemas import ARTICLE

#: Stored defaults.
REQUIRED_TEXT = ("ticker", "source_id", "title", "url")
STAMPS = ("published_at", "fetched_at")


def _present(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def article_records(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """The ten article columns: required text defaults to ``""``, stamps parse leniently, the rest may be NULL."""
    def column(name: str) -> Column:
        value = _present(df, name)
        if name in REQUIRED_TEXT:
            return F.coalesce(value.cast("string"), F.lit(""))
        return lenient_timestamp(value) if name in STAMPS else value

    return df.select(*[column(c).alias(c) for c in ARTICLE.names], *extra)


def sentiment_records(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """url and the four sentiment columns; missing results are neutral, 0, 0.0."""
    label = F.nullif(_present(df, "sentiment_label"), F.lit(""))
    return df.select(
        F.coalesce(_present(df, "url"), F.lit("")).alias("url"),
        F.coalesce(label, F.lit("neutral")).alias("sentiment_label"),
        F.coalesce(_present(df, "sentiment_score").try_cast("int"), F.lit(0)).alias("sentiment_score"),
        F.coalesce(null_if_nan(_present(df, "sentiment_confidence").try_cast("double")), F.lit(0.0))
        .alias("sentiment_confidence"),
        lenient_timestamp(_present(df, "analysed_at")).alias("analysed_at"),
        *extra,
    )


def with_article_id(articles: DataFrame) -> DataFrame:
    return articles.withColumn("article_id", article_key(F.col("url")))


def named_tickers(df: DataFrame) -> DataFrame:
    """Tickers stripped and upper-cased; rows without one are dropped."""
    return df.withColumn("ticker", ticker_symbol(F.col("ticker"))).where(F.col("ticker") != "")
