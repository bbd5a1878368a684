"""The sample tables seen as article, sentiment and price tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newstape.functions.text import article_key
from newstape.session import tune

MODEL = "keyword-v1"
SECOND_MODEL = "keyword-v2"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def source_by(number: Column) -> Column:
    return (
        F.when(number == 0, "Yahoo Finance").when(number == 1, "Benzinga")
        .when(number == 2, "CNBC").when(number == 3, "Reuters")
    )


def flag_label(flag: Column) -> Column:
    return F.when(flag == "A", "positive").when(flag == "N", "neutral").otherwise("negative")


def flag_score(flag: Column) -> Column:
    return F.when(flag == "A", 1).when(flag == "N", 0).otherwise(-1)


def branded(spark: SparkSession, sf_dir: str, items: DataFrame) -> DataFrame:
    """Line items with the brand and name of their part."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")
    return items.join(parts, F.col("l_partkey") == parts["p_partkey"])


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their brand: every row is one article and one trade."""
    return branded(spark, sf_dir, table(spark, sf_dir, "lineitem"))


def line_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored articles, one per line item; urls repeat, ``seq`` is their arrival order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    # the items come in the order of their keys, and meet their part last, so its texts are not shuffled again
    items = table(spark, sf_dir, "lineitem")
    rows = branded(spark, sf_dir, items.join(orders, items["l_orderkey"] == orders["o_orderkey"]))
    return rows.select(
        F.col("p_brand").alias("ticker"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("source_id"),
        source_by((F.col("l_orderkey") + F.col("l_linenumber")) % 5).alias("source_name"),
        F.lit(None).cast("string").alias("author"),
        F.col("p_name").alias("title"),
        F.col("l_returnflag").alias("description"),
        F.concat_ws(
            "/", F.lit("http://news.example"), F.col("l_orderkey"), F.col("l_linenumber")
        ).alias("url"),
        F.col("o_orderdate").cast("timestamp").alias("published_at"),
        F.lit(None).cast("string").alias("content"),
        F.col("l_shipdate").cast("timestamp").alias("fetched_at"),
        flag_label(F.col("l_returnflag")).alias("sentiment_label"),
        flag_score(F.col("l_returnflag")).alias("sentiment_score"),
        (F.col("l_tax") + 0.5).alias("sentiment_confidence"),
        F.col("l_shipdate").cast("timestamp").alias("analysed_at"),
        F.struct("l_extendedprice", "l_quantity", "l_partkey", "l_suppkey", "l_discount", "l_tax",
                 "l_shipdate", "l_returnflag", "l_linestatus").alias("seq"),
        F.col("l_linestatus").alias("batch"),
    )


def line_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of unit prices per brand, ordered inside a day by order line."""
    px = F.col("l_extendedprice") / F.col("l_quantity")
    rows = trades(spark, sf_dir).select(
        F.col("p_brand").alias("ticker"),
        F.to_date("l_shipdate").alias("trading_date"),
        px.alias("px"),
        F.struct((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"), px.alias("px")).alias("k"),
        F.col("l_quantity").alias("q"),
    )
    return daily_bars(rows)


def daily_bars(rows: DataFrame) -> DataFrame:
    """One row per (ticker, trading_date); partial aggregates keep busy days small."""
    return rows.groupBy("ticker", "trading_date").agg(
        F.min_by("px", "k").alias("open_price"),
        F.max("px").alias("high_price"),
        F.min("px").alias("low_price"),
        F.max_by("px", "k").alias("close_price"),
        F.max_by("px", "k").alias("adjusted_close"),
        F.sum("q").cast("long").alias("volume"),
    )


def event_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored articles, one per event: ten tickers over thirty days."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("T"), F.col("user_id") % 10).alias("ticker"),
        F.col("event_id"),
        source_by(F.col("event_id") % 5).alias("source_name"),
        F.concat(F.lit("http://news.example/e/"), F.col("event_id")).alias("url"),
        F.col("ts").cast("timestamp").alias("published_at"),
        F.when(kind.isin("purchase", "signup"), "positive").when(kind == "error", "negative")
        .otherwise("neutral").alias("sentiment_label"),
        F.when(kind.isin("purchase", "signup"), 1).when(kind == "error", -1).otherwise(0).alias("sentiment_score"),
        F.lit(0.9).alias("sentiment_confidence"),
    )


def event_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        F.concat(F.lit("T"), F.col("user_id") % 10).alias("ticker"),
        F.to_date("ts").alias("trading_date"),
        F.col("value").alias("px"),
        F.struct("ts", "event_id").alias("k"),
        F.lit(1).alias("q"),
    )
    return daily_bars(rows)


def stored_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event articles as a stored table with ids."""
    return event_articles(spark, sf_dir).withColumn("article_id", article_key(F.col("url")))


def stored_sentiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of two models: the first scored all but the signups, the second only views and clicks."""
    articles = stored_articles(spark, sf_dir)
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    rows = articles.join(events, "event_id")
    first = rows.where(F.col("event_type") != "signup").select(
        "article_id", F.lit(MODEL).alias("model_name"), "sentiment_label", "sentiment_score", "sentiment_confidence"
    )
    second = rows.where(F.col("event_type").isin("view", "click")).select(
        "article_id", F.lit(SECOND_MODEL).alias("model_name"),
        F.lit("positive").alias("sentiment_label"), F.lit(1).alias("sentiment_score"),
        F.lit(0.6).alias("sentiment_confidence"),
    )
    return first.unionByName(second)


def day_text(column: str) -> Column:
    """Dates and times leave the registered queries as text, equal in both engines."""
    return F.date_format(column, "yyyy-MM-dd")


def time_text(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
