"""Landed news payloads turned into ``ARTICLE`` rows.

A landing folder holds what two kinds of news service answered: a *feed* file is
a JSON array of items (or one item per line), an *archive* file is an object with
an ``articles`` list.  One file is one bounded answer, so a multi-line file stays
small; JSON lines are splittable and preferred for bulk.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from newstape.functions.text import ARCHIVE_STAMP, lenient_timestamp, text_or_null, ticker_symbol, url_digest
from newstape.schemas import ARCHIVE_PAYLOAD, ARTICLE, FEED_ITEM

#: column of a record that is no JSON
RECORD = "_record"


def _stamp(fetched_at: dt.datetime | Column) -> Column:
    return fetched_at if isinstance(fetched_at, Column) else F.lit(fetched_at)


def _ticker(ticker: str | Column) -> Column:
    return ticker_symbol(ticker if isinstance(ticker, Column) else F.lit(ticker))


def _none(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


def read_feed(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Feed items; damaged fields become NULL, and what is no JSON at all is left out (see :func:`rejected`)."""
    return _sound(_read(spark, path, FEED_ITEM, multi_line), FEED_ITEM)


def read_archive(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Archive payloads, one row per answer; what is no JSON is left out (see :func:`rejected`)."""
    return _sound(_read(spark, path, ARCHIVE_PAYLOAD, multi_line), ARCHIVE_PAYLOAD)


def rejected(spark: SparkSession, path: str, schema: T.StructType = FEED_ITEM, multi_line: bool = True) -> DataFrame:
    """(``file_name``, ``record``): the items or answers of a folder that could not be read, as they stand there.

    Rows that :func:`read_feed` or :func:`read_archive` gives and these are together all
    records of the folder.
    """
    raw = _read(spark, path, schema, multi_line)
    return raw.where(_damaged(schema)).select(F.col("_metadata.file_name").alias("file_name"), F.col(RECORD).alias("record"))


def _read(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool) -> DataFrame:
    landed = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
    return spark.read.schema(landed).option("multiLine", multi_line).option("columnNameOfCorruptRecord", RECORD).json(path)


def _damaged(schema: T.StructType) -> Column:
    """The record is no JSON; one that is, but has a field of another type, is kept without that field."""
    # Spark refuses to read the record alone, so a column of the schema is looked at too
    other = F.coalesce(F.col(schema.names[0]).cast("string"), F.lit("")) != F.lit("\0")
    return F.col(RECORD).isNotNull() & F.get_json_object(RECORD, "$").isNull() & other


def _sound(raw: DataFrame, schema: T.StructType) -> DataFrame:
    return raw.where(~F.coalesce(_damaged(schema), F.lit(False))).select(*schema.names)


def feed_articles(items: DataFrame, ticker: str | Column, fetched_at: dt.datetime | Column) -> DataFrame:
    """Feed items as articles: unix seconds to timestamps, blank text to NULL."""
    return items.select(
        _ticker(ticker).alias("ticker"),
        F.col("id").cast("string").alias("source_id"),
        text_or_null(F.col("source")).alias("source_name"),
        _none().alias("author"),
        text_or_null(F.col("headline")).alias("title"),
        text_or_null(F.col("summary")).alias("description"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.timestamp_seconds("datetime").alias("published_at"),
        _none().alias("content"),
        _stamp(fetched_at).alias("fetched_at"),
    ).select(*ARTICLE.names)


def archive_articles(payloads: DataFrame, ticker: str | Column, fetched_at: dt.datetime | Column) -> DataFrame:
    """Archive answers as articles; the source id is derived from the url."""
    items = payloads.select(
        _ticker(ticker).alias("ticker"), _stamp(fetched_at).alias("fetched_at"), F.explode("articles").alias("item")
    )
    return items.select(
        "ticker",
        url_digest(F.col("item.url")).alias("source_id"),
        text_or_null(F.col("item.domain")).alias("source_name"),
        _none().alias("author"),
        text_or_null(F.col("item.title")).alias("title"),
        _none().alias("description"),
        F.coalesce("item.url", F.lit("")).alias("url"),
        lenient_timestamp(F.col("item.seendate"), ARCHIVE_STAMP).alias("published_at"),
        _none().alias("content"),
        "fetched_at",
    ).select(*ARTICLE.names)
