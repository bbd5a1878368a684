"""Registered queries: landed files, clean-up, upserts, joins, lookups, reports, sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from newstape.checks import sql as S
from newstape.checks.daily_queries import FIRST, LAST, P3_SQL, dated, with_day
from newstape.checks.views import (
    MODEL, day_text, event_articles, event_prices, line_articles, line_prices, stored_articles, stored_sentiments,
    table, time_text,
)
from newstape.functions import text as X
from newstape.functions.numeric import half_even, null_if_nan
from newstape.operators import daily, labels, lookups, records, reports, tagging, upsert
from newstape.plans import loading
from newstape.schemas import ARTICLE, DAILY_FEATURES, ENRICHED_ARTICLE, FEATURES, PRICE, SENTIMENT_FEATURES
from newstape.session import fresh_path, tune
from newstape.sources import files, payloads, quotes, scans, sinks
from newstape.sources.keyed import KeyedTable, by_hash

STAMP = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)
#: DuckDB spelling of the white space that is stripped
WS = " || ".join(f"chr({ord(c)})" for c in X.WHITESPACE)
STAMP_SQL = "'2025-01-01 00:00:00'"


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: time_text(c) for c in columns})


# --- landed files -------------------------------------------------------------------


def a1(spark, sf_dir):
    """Documents written as a feed landing folder, then read back as articles."""
    docs = table(spark, sf_dir, "documents")
    items = docs.select(
        F.col("doc_id").alias("id"), (F.col("doc_id") * 3600 + 1700000000).alias("datetime"),
        F.concat(F.lit("  "), F.col("lang"), F.lit(" \n")).alias("headline"), F.col("text").alias("summary"),
        F.when(F.col("source") == "web", "  ").otherwise(F.col("source")).alias("source"),
        F.concat(F.lit("http://news.example/d/"), F.col("doc_id")).alias("url"),
    )
    path = fresh_path(spark, "feed")
    items.write.json(path)
    out = payloads.feed_articles(payloads.read_feed(spark, path, multi_line=False), " aapl ", STAMP)
    return as_text(out, "published_at", "fetched_at")


A1_SQL = f"""
    SELECT 'AAPL' AS ticker, CAST(doc_id AS VARCHAR) AS source_id,
           nullif(trim(CASE WHEN source = 'web' THEN '  ' ELSE source END, {WS}), '') AS source_name,
           CAST(NULL AS VARCHAR) AS author, nullif(trim(lang, {WS}), '') AS title,
           nullif(trim(text, {WS}), '') AS description,
           'http://news.example/d/' || doc_id AS url,
           strftime(make_timestamp((doc_id * 3600 + 1700000000) * 1000000), '%Y-%m-%d %H:%M:%S') AS published_at,
           CAST(NULL AS VARCHAR) AS content, {STAMP_SQL} AS fetched_at
    FROM documents"""


def a1_rejects(spark, sf_dir):
    """A feed folder in which some items break off: each record is an article or a reject, whole."""
    docs = table(spark, sf_dir, "documents")
    item = F.to_json(F.struct(F.col("doc_id").alias("id"), F.lit(1700000000).alias("datetime"), F.col("text").alias("headline")))
    lines = docs.select("doc_id", item.alias("item")).select(F.when(F.col("doc_id") % 10 == 3, F.expr("left(item, length(item) div 2 + 12)")).otherwise(F.col("item")).alias("value"))
    path = fresh_path(spark, "broken-feed")
    lines.write.text(path)
    kept = payloads.feed_articles(payloads.read_feed(spark, path, multi_line=False), "aapl", STAMP)
    lost = payloads.rejected(spark, path, multi_line=False)
    return kept.select(F.col("source_id").alias("id"), F.lit("article").alias("status")).unionByName(
        lost.select(F.regexp_extract("record", '"id":([0-9]+)', 1).alias("id"), F.lit("reject").alias("status"))
    )


A1_REJECTS_SQL = """
    SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN doc_id % 10 = 3 THEN 'reject' ELSE 'article' END AS status FROM documents"""


def a2(spark, sf_dir):
    """Pages written as archive answers of one or two items, some answers without a list; urls with a fragment get an unreadable date."""
    pages = table(spark, sf_dir, "pages")
    seen = F.date_format(F.timestamp_seconds(F.col("page_id") * 60 + 1700000000), "yyyyMMdd'T'HHmmss'Z'")
    def item(url):
        return F.struct(
            url.alias("url"), F.concat(F.lit(" "), F.col("html")).alias("title"),
            F.when(url.contains("#"), "soon").otherwise(seen).alias("seendate"),
            F.regexp_extract(url, "https?://([^/]+)", 1).alias("domain"),
        )

    one, two = item(F.col("url")), item(F.concat("url", F.lit("&again")))
    listed = F.when(F.col("page_id") % 3 == 0, F.array(one, two)).otherwise(F.array(one))
    nothing = pages.where(F.col("page_id") % 5 == 0).select(F.when(F.lit(False), listed).alias("articles"))
    path = fresh_path(spark, "archive")
    pages.select(listed.alias("articles")).unionByName(nothing).write.json(path)
    out = payloads.archive_articles(payloads.read_archive(spark, path, multi_line=False), "tsla", STAMP)
    return as_text(out, "published_at", "fetched_at")


A2_SQL = f"""
    SELECT 'TSLA' AS ticker, substr(sha256(url), 1, 16) AS source_id,
           nullif(trim(regexp_extract(url, 'https?://([^/]+)', 1), {WS}), '') AS source_name,
           CAST(NULL AS VARCHAR) AS author, nullif(trim(html, {WS}), '') AS title,
           CAST(NULL AS VARCHAR) AS description, url,
           CASE WHEN contains(url, '#') THEN NULL
                ELSE strftime(make_timestamp((page_id * 60 + 1700000000) * 1000000), '%Y-%m-%d %H:%M:%S') END AS published_at,
           CAST(NULL AS VARCHAR) AS content, {STAMP_SQL} AS fetched_at
    FROM (SELECT page_id, url, html FROM pages UNION ALL SELECT page_id, url || '&again', html FROM pages WHERE page_id % 3 = 0)"""

#: phrases that occur in the sample texts
SAMPLE_PHRASES = {"AAA": "Of The", "BBB": "the", "CCC": "le la", "DDD": "is  on it", "EEE": "Apple Inc"}


def words_sql(column: str) -> str:
    return f"' ' || trim(regexp_replace(lower({column}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) || ' '"


def a3(spark, sf_dir):
    """Long texts against a few phrases of common words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    phrases = spark.createDataFrame(list(SAMPLE_PHRASES.items()), "ticker string, phrase string")
    return tagging.tag(docs, phrases, "doc_id", "text")


A3_SQL = " UNION ALL ".join(
    f"SELECT doc_id, '{t}' AS ticker FROM documents WHERE contains({words_sql('text')}, {words_sql(repr(p))})"
    for t, p in SAMPLE_PHRASES.items()
)


def a3_table(spark, sf_dir):
    """Article titles against a phrase table taken from the part names of each brand."""
    articles = line_articles(spark, sf_dir).select("url", "title").dropDuplicates(["url", "title"])
    articles = articles.withColumn("article", F.concat_ws("|", "url", "title"))
    phrases = table(spark, sf_dir, "part").select(F.col("p_type").alias("ticker"), F.col("p_name").alias("phrase")).distinct()
    return tagging.tag(articles, phrases, "article", "title", unique=True)


A3_TABLE_SQL = S.with_ctes(
    "line_articles",
    f"""SELECT DISTINCT url || '|' || title AS article, p_type AS ticker
    FROM (SELECT DISTINCT url, title FROM line_articles)
    JOIN (SELECT DISTINCT p_type, p_name FROM part)
      ON contains({words_sql('title')}, {words_sql('p_name')})""",
)


def a3_items(spark, sf_dir):
    """Long texts against a table of phrases cut from texts: the first three words of every document."""
    docs = table(spark, sf_dir, "documents")
    # no more of a text is cut into words than its first three
    start = F.regexp_extract(F.lower("text"), r"^[^\p{L}\p{N}]*+([\p{L}\p{N}]++(?:[^\p{L}\p{N}]++[\p{L}\p{N}]++){0,2})", 1)
    head = F.trim(X.words_of(start))
    phrases = docs.select(F.concat(F.lit("D"), F.col("doc_id") % 50).alias("ticker"), head.alias("phrase")).distinct()
    return tagging.tag(docs.select("doc_id", "text"), phrases, "doc_id", "text")


A3_ITEMS_SQL = f"""
    WITH w AS (SELECT doc_id, {words_sql('text')} AS words FROM documents),
         p AS (SELECT DISTINCT 'D' || (doc_id % 50) AS ticker,
                      array_to_string(list_slice(string_split(trim(words), ' '), 1, 3), ' ') AS phrase FROM w)
    SELECT DISTINCT doc_id, ticker FROM w JOIN p ON phrase <> '' AND contains(words, ' ' || phrase || ' ')"""

COVER = (dt.datetime(1995, 1, 1, tzinfo=dt.timezone.utc), dt.datetime(2002, 1, 15, tzinfo=dt.timezone.utc))


def a4(spark, sf_dir):
    articles = line_articles(spark, sf_dir)
    tickers = table(spark, sf_dir, "part").select(F.col("p_brand").alias("ticker"))
    out = tagging.coverage(articles, tickers, *COVER, cap=15)
    return as_text(out.withColumn("possibly_truncated", F.col("possibly_truncated").cast("int")), "chunk_start", "chunk_end")


A4_SQL = S.with_ctes(
    "line_articles",
    """, chunks AS (SELECT CAST(i AS BIGINT) AS chunk, TIMESTAMP '1995-01-01' + INTERVAL (i * 7) DAY AS s,
                          least(TIMESTAMP '1995-01-01' + INTERVAL (i * 7 + 7) DAY - INTERVAL 1 SECOND,
                                TIMESTAMP '2002-01-15') AS e
                   FROM range(0, date_diff('day', DATE '1995-01-01', DATE '2002-01-15') // 7 + 1) t(i)),
       tickers AS (SELECT DISTINCT p_brand AS ticker FROM part)
    SELECT t.ticker, chunk, strftime(s, '%Y-%m-%d %H:%M:%S') AS chunk_start,
           strftime(e, '%Y-%m-%d %H:%M:%S') AS chunk_end, count(a.url) AS article_count,
           CASE WHEN count(a.url) >= 15 THEN 1 ELSE 0 END AS possibly_truncated
    FROM tickers t CROSS JOIN chunks
    LEFT JOIN line_articles a ON a.ticker = t.ticker AND a.published_at BETWEEN s AND e GROUP BY ALL""",
)


def a5(spark, sf_dir):
    """Daily features written as CSV and loaded with their types."""
    path = fresh_path(spark, "features-csv")
    daily.daily_features(dated(spark, sf_dir)).write.option("header", True).csv(path)
    return with_day(files.load_table(spark, path, FEATURES))


DAILY_SQL = S.with_ctes(
    "line_articles line_daily line_windows",
    f"SELECT ticker, CAST(date AS VARCHAR) AS date, {', '.join(S.daily_sql(c) for c in DAILY_FEATURES)} FROM line_windows",
)


def a6(spark, sf_dir):
    """File names derived from the orders: feed, archive and produced names, and some that do not parse."""
    orders = table(spark, sf_dir, "orders")
    who, day = F.upper(F.substring("o_orderpriority", 3, 20)), day_text("o_orderdate")
    name = (
        F.when(F.col("o_orderstatus") == "F", F.concat(who, F.lit("_news_"), day))
        .when(F.col("o_orderstatus") == "O", F.concat(who, F.lit("_gdelt_"), day, F.lit("_"), day))
        .otherwise(F.concat(who, F.lit("_sentiment_"), F.year("o_orderdate")))
    )
    names = orders.select(F.concat(name, F.lit(".csv")).alias("file_name")).distinct()
    return files.file_facts(names)


A6_SQL = """
    SELECT file_name,
           CASE WHEN NOT ok THEN NULL WHEN s = 'F' THEN 'feed' WHEN s = 'O' THEN 'archive' ELSE 'sentiment' END AS kind,
           CASE WHEN ok THEN who END AS file_ticker,
           CASE WHEN NOT ok THEN NULL WHEN s = 'F' THEN day ELSE left(day, 4) END AS tag
    FROM (SELECT DISTINCT who || CASE s WHEN 'F' THEN '_news_' || day WHEN 'O' THEN '_gdelt_' || day || '_' || day
                 ELSE '_sentiment_' || left(day, 4) END || '.csv' AS file_name, s, who,
                 CASE WHEN s = 'P' THEN left(day, 4) ELSE day END AS day,
                 regexp_full_match(who, '[A-Z]+') AS ok
          FROM (SELECT CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderstatus ELSE 'P' END AS s,
                       upper(substr(o_orderpriority, 3, 20)) AS who,
                       strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders))"""


def a6_files(spark, sf_dir):
    """Events written as named article files, one per ticker; three tickers asked for by tag, one of which has no file."""
    folder = fresh_path(spark, "landing")
    rows = event_articles(spark, sf_dir).select(
        F.col("ticker"), "url", F.concat(F.lit("row "), F.col("event_id"), F.lit("\nnext, line")).alias("title"),
        F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("published_at"),
    )
    letters = F.translate("ticker", "T0123456789", "TABCDEFGHIJ")
    tag = F.when(F.col("ticker") == "T5", "2023-01-01").otherwise("2024-01-01")
    named = rows.withColumns({"ticker": letters, "_file": F.concat(letters, F.lit("_news_"), tag)})
    parts = f"{folder}-parts"
    named.repartition("_file").write.partitionBy("_file").option("header", True).option("escape", '"').csv(parts)
    _named_files(spark, parts, folder)
    found, report = loading.articles_from_files(spark, folder, "2024-01-01", ["ta", "TF", "TZ", "TC"])
    read = found.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("title").alias("titles"), F.count("published_at").alias("stamps"))
    return report.join(read, "ticker", "left")


def _named_files(spark, parts: str, folder: str) -> None:
    """Move each partition's file to the name of its partition, as a fetch job would have left it."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(parts).getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(path(folder))
    for part in store.globStatus(path(f"{parts}/_file=*/part-*")):
        name = part.getPath().getParent().getName().removeprefix("_file=")
        store.rename(part.getPath(), path(f"{folder}/{name}.csv"))


A6_FILES_SQL = S.with_ctes("event_articles", """
    , asked AS (SELECT unnest(['TA', 'TF', 'TZ', 'TC']) AS ticker),
      e AS (SELECT translate(ticker, 'T0123456789', 'TABCDEFGHIJ') AS ticker, count(*) AS n FROM event_articles WHERE ticker <> 'T5' GROUP BY 1)
    SELECT ticker, CASE WHEN n IS NULL THEN 0 ELSE 1 END AS files, CASE WHEN n IS NULL THEN 'missing' ELSE 'ok' END AS status,
           n AS rows, n AS titles, n AS stamps FROM asked LEFT JOIN e USING (ticker)""")


def a7(spark, sf_dir):
    out = scans.article_window(
        stored_articles(spark, sf_dir), stored_sentiments(spark, sf_dir), dt.date(2023, 12, 31), dt.date(2024, 1, 30)
    )
    return as_text(with_day(out).withColumn("sentiment_score", F.col("sentiment_score").cast("long")), "published_at")


A7_SQL = S.with_ctes(
    "event_articles stored_sentiments",
    """SELECT ticker, source_name, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at,
              CAST(date AS VARCHAR) AS date, s.sentiment_label, CAST(s.sentiment_score AS BIGINT) AS sentiment_score,
              s.sentiment_confidence
       FROM event_articles a JOIN stored_sentiments s USING (url)
       WHERE published_at >= TIMESTAMP '2023-12-31' AND published_at < TIMESTAMP '2024-01-31'""",
)


def a8(spark, sf_dir):
    out = scans.price_range(event_prices(spark, sf_dir), ["t1", "T4", "t7"], dt.date(2024, 1, 5), None)
    return with_day(out, "trading_date")


A8_SQL = S.with_ctes(
    "event_prices",
    """SELECT ticker, CAST(trading_date AS VARCHAR) AS trading_date, open_price, high_price, low_price, close_price,
              close_price AS adjusted_close, volume FROM event_prices
       WHERE ticker IN ('T1', 'T4', 'T7') AND trading_date >= DATE '2024-01-05'""",
)


def a9(spark, sf_dir):
    out = scans.label_prices(event_prices(spark, sf_dir), ["t0", "t9"], dt.date(2024, 1, 2), dt.date(2024, 1, 20))
    return with_day(out, "trading_date")


A9_SQL = S.with_ctes(
    "event_prices",
    """SELECT ticker, CAST(trading_date AS VARCHAR) AS trading_date, close_price FROM event_prices
       WHERE ticker IN ('T0', 'T9') AND trading_date BETWEEN DATE '2024-01-02' AND DATE '2024-01-20'""",
)


def a10(spark, sf_dir):
    """Line prices written as a quote file with missing adjusted closes, NaN, and unreadable dates."""
    bars = line_prices(spark, sf_dir)
    odd = F.col("volume") == 1
    quote = bars.select(
        F.col("ticker").alias("Symbol"),
        F.when(F.col("volume") == 2, "n/a").otherwise(F.concat(day_text("trading_date"), F.lit(" 00:00:00-05:00"))).alias("Date"),
        F.col("open_price").alias("Open"), F.col("high_price").alias("High"),
        F.when(odd, F.lit("nan")).otherwise(F.col("low_price").cast("string")).alias("Low"),
        F.col("close_price").alias("Close"),
        F.when(odd, F.lit(None)).otherwise(F.col("close_price") - 0.5).alias("Adj Close"),
        F.col("volume").cast("double").alias("Volume"),
    )
    path = fresh_path(spark, "quotes")
    quote.write.option("header", True).csv(path)
    landed = tune(spark).read.option("header", True).csv(path)
    return with_day(quotes.normalised_quotes(landed, F.col("Symbol")), "trading_date")


A10_SQL = S.with_ctes(
    "line_prices",
    """SELECT upper(ticker) AS ticker, CAST(trading_date AS VARCHAR) AS trading_date, open_price, high_price,
              CASE WHEN volume <> 1 THEN low_price END AS low_price, close_price,
              CASE WHEN volume = 1 THEN close_price ELSE close_price - 0.5e0 END AS adjusted_close, volume
       FROM line_prices WHERE volume <> 2""",
)

# --- clean-up expressions ---------------------------------------------------------


def c1(spark, sf_dir):
    """Values of view events arrive as NaN."""
    value = F.when(F.col("event_type") == "view", F.lit(float("nan"))).otherwise(F.col("value"))
    return table(spark, sf_dir, "events").select("event_id", null_if_nan(value).alias("value"))


C1_SQL = "SELECT event_id, CASE WHEN event_type <> 'view' THEN value END AS value FROM events"


def c2(spark, sf_dir):
    stamp = F.when(F.col("event_type") == "error", F.concat(F.lit("at "), F.col("ts").cast("string"))).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+01:00'")
    )
    out = table(spark, sf_dir, "events").select("event_id", X.lenient_timestamp(stamp).alias("seen"))
    return as_text(out, "seen")


C2_SQL = """SELECT event_id, CASE WHEN event_type <> 'error'
                   THEN strftime(date_trunc('second', ts) - INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') END AS seen FROM events"""


def c3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    raw = docs.select(
        F.when(F.col("lang") != "en", F.col("lang")).alias("ticker"), F.col("source").alias("source_name"),
        F.col("text").alias("title"), F.concat(F.lit("u/"), F.col("doc_id")).alias("url"), F.col("n_chars"),
        F.when(F.col("lang") == "en", "2024-05-06 07:08:09").otherwise("never").alias("published_at"),
    )
    return as_text(records.article_records(raw), "published_at", "fetched_at")


C3_SQL = """
    SELECT coalesce(CASE WHEN lang <> 'en' THEN lang END, '') AS ticker, '' AS source_id, source AS source_name,
           CAST(NULL AS VARCHAR) AS author, text AS title, CAST(NULL AS VARCHAR) AS description,
           'u/' || doc_id AS url, CASE WHEN lang = 'en' THEN '2024-05-06 07:08:09' END AS published_at,
           CAST(NULL AS VARCHAR) AS content, CAST(NULL AS VARCHAR) AS fetched_at FROM documents"""


def c4(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    is_error = F.col("event_type") == "error"
    raw = events.select(
        F.concat(F.lit("e/"), F.col("event_id")).alias("url"),
        F.when(~is_error, F.col("event_type")).alias("sentiment_label"),
        F.when(is_error, "x").otherwise("-1").alias("sentiment_score"),
        F.when(is_error, F.lit(float("nan"))).otherwise(F.col("value")).alias("sentiment_confidence"),
    )
    out = records.sentiment_records(raw).withColumn("sentiment_score", F.col("sentiment_score").cast("long"))
    return as_text(out, "analysed_at")


C4_SQL = """
    SELECT 'e/' || event_id AS url, CASE WHEN event_type = 'error' THEN 'neutral' ELSE event_type END AS sentiment_label,
           CAST(CASE WHEN event_type = 'error' THEN 0 ELSE -1 END AS BIGINT) AS sentiment_score,
           CASE WHEN event_type = 'error' THEN 0e0 ELSE value END AS sentiment_confidence,
           CAST(NULL AS VARCHAR) AS analysed_at FROM events"""


def c5(spark, sf_dir):
    """Every text padded with white space, and every source name with its letters made blank."""
    docs = table(spark, sf_dir, "documents")
    padded = F.concat(F.lit("\t "), F.col("text"), F.lit(" \n"))
    blank = F.concat(F.lit("\t "), F.regexp_replace("source", "[a-z0-9]", " "))
    return docs.select("doc_id", X.text_or_null(padded).alias("text"), X.text_or_null(blank).alias("blank"))


C5_SQL = f"SELECT doc_id, nullif(trim(text, {WS}), '') AS text, CAST(NULL AS VARCHAR) AS blank FROM documents"


def c6(spark, sf_dir):
    raw = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "BUILDING", " ").otherwise(F.concat(F.lit(" "), F.lower("c_mktsegment"))).alias("ticker"),
    )
    return records.named_tickers(raw)


C6_SQL = "SELECT c_custkey, c_mktsegment AS ticker FROM customer WHERE c_mktsegment <> 'BUILDING'"


def c8(spark, sf_dir):
    """Title and text, each alone, and neither."""
    title = F.when(F.col("lang") == "en", "  ").otherwise(F.concat(F.lit(" "), F.col("source")))
    nothing = F.lit(None).cast("string")
    return table(spark, sf_dir, "documents").select(
        "doc_id", X.model_text(title, F.col("text")).alias("text"), X.model_text(title, nothing).alias("title_only"),
    )


C8_SQL = f"""
    SELECT doc_id, nullif(concat_ws('. ', CASE WHEN lang <> 'en' THEN nullif(trim(source, {WS}), '') END,
                   nullif(trim(text, {WS}), '')), '') AS text,
           CASE WHEN lang <> 'en' THEN nullif(trim(source, {WS}), '') END AS title_only FROM documents"""


def c9(spark, sf_dir):
    """Labels first in the input, canonical order in the output (checked by position)."""
    from newstape.plans.dataset import ordered_columns

    rows = daily.daily_sentiment(dated(spark, sf_dir)).select("ticker", "date", "article_count")
    both = labels.label_features(rows, line_prices(spark, sf_dir))
    shuffled = both.select("label_direction", "return_5d", "ticker", "date", "article_count")
    return with_day(ordered_columns(shuffled))


C9_SQL = S.with_ctes(
    "line_articles line_daily line_prices future returns labels_of",
    """SELECT d.ticker, CAST(d.date AS VARCHAR) AS date, article_count, return_5d, label_direction
       FROM line_daily d JOIN labels_of l ON l.ticker = d.ticker AND l.trading_date = d.date""",
)


def c10(spark, sf_dir):
    price = F.col("l_extendedprice") / 7
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", *[half_even(price, n).alias(f"r{n}") for n in (4, 6, 8)],
        half_even(F.col("l_linenumber") / 128, 6).alias("tie"),
    )


C10_SQL = "SELECT l_orderkey, " + ", ".join(
    f"{S.r('l_extendedprice / 7', n)} AS r{n}" for n in (4, 6, 8)
) + f", {S.r('l_linenumber / 128', 6)} AS tie FROM lineitem"


def c13(spark, sf_dir):
    """The predicates together: url, ticker list, inclusive days, label present."""
    out = dated(spark, sf_dir).where(
        (F.col("url") != "") & F.col("ticker").isin("Brand#1", "Brand#7") & F.col("source_name").isNotNull()
    ).where(scans.in_days("date", dt.date(1996, 1, 1), dt.date(1999, 12, 31)))
    return with_day(out.groupBy("ticker", "date").agg(F.count("source_name").alias("n")))


C13_SQL = S.with_ctes(
    "line_articles",
    """SELECT ticker, CAST(date AS VARCHAR) AS date, count(*) AS n FROM line_articles
       WHERE ticker IN ('Brand#1', 'Brand#7') AND source_name IS NOT NULL
         AND date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' GROUP BY ALL""",
)

# --- upserts ------------------------------------------------------------------------


def _stored_lines(spark, sf_dir, columns=ENRICHED_ARTICLE.names) -> DataFrame:
    """Articles of the open batch as they stand in the table: the first of each url."""
    open_batch = line_articles(spark, sf_dir).where(F.col("batch") == "O").select(*columns, "seq")
    return upsert.keep_first(open_batch, ["url"], "seq").drop("seq")


def _incoming_lines(spark, sf_dir) -> DataFrame:
    """The finished batch; articles without a source arrive without a url."""
    rows = line_articles(spark, sf_dir).where(F.col("batch") == "F").drop("batch")
    return rows.withColumn("url", F.when(F.col("source_name").isNull(), "").otherwise(F.col("url")))


SHOWN = ["url", "ticker", "source_id", "source_name", "title", "description", "published_at", "fetched_at"]


def b6(spark, sf_dir):
    merged = upsert.upsert_articles(_stored_lines(spark, sf_dir), _incoming_lines(spark, sf_dir), "seq")
    return as_text(merged.select(*SHOWN, "_action", F.col("_copies").alias("copies")), "published_at", "fetched_at") \
        .withColumnRenamed("_action", "action")


UPSERT_CTES = """, ex AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY seq) AS n
                         FROM line_articles WHERE batch = 'O') WHERE n = 1),
       raw AS (SELECT * REPLACE (CASE WHEN source_name IS NULL THEN '' ELSE url END AS url)
               FROM line_articles WHERE batch = 'F'),
       inc AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY seq) AS first,
                      row_number() OVER (PARTITION BY url ORDER BY seq DESC) AS last,
                      count(*) OVER (PARTITION BY url) AS copies FROM raw WHERE url <> ''),
       f AS (SELECT * FROM inc WHERE first = 1), l AS (SELECT * FROM inc WHERE last = 1),
       merged AS (SELECT coalesce(ex.url, f.url) AS url,
                coalesce(ex.ticker, f.ticker) AS ticker, coalesce(ex.source_id, f.source_id) AS source_id,
                CASE WHEN l.url IS NULL THEN ex.source_name ELSE l.source_name END AS source_name,
                CASE WHEN l.url IS NULL THEN ex.title ELSE l.title END AS title,
                CASE WHEN l.url IS NULL THEN ex.description ELSE l.description END AS description,
                strftime(coalesce(ex.published_at, f.published_at), '%Y-%m-%d %H:%M:%S') AS published_at,
                strftime(CASE WHEN l.url IS NULL THEN ex.fetched_at ELSE l.fetched_at END, '%Y-%m-%d %H:%M:%S') AS fetched_at,
                CASE WHEN f.url IS NULL THEN 'keep' WHEN ex.url IS NULL THEN 'insert' ELSE 'update' END AS action,
                coalesce(f.copies, 0) AS copies
         FROM ex FULL JOIN f ON ex.url = f.url LEFT JOIN l ON l.url = f.url)
    """
B6_SQL = S.with_ctes("line_articles", UPSERT_CTES + "SELECT * FROM merged")


def b6_small(spark, sf_dir):
    """The same merge into a stored table of articles: of 16 partitions those that the batch touches are rewritten."""
    rows = _stored_lines(spark, sf_dir, ARTICLE.names)
    stored = KeyedTable(spark, fresh_path(spark, "articles"), rows.schema, ["url"], by_hash(["url"], 16), rebalance=False)
    stored.merge(rows, lambda old, new: upsert.upsert_articles(old, new))
    incoming = _incoming_lines(spark, sf_dir).where(F.col("url") != "").select(*ARTICLE.names, "seq")
    merged = stored.merge(incoming, lambda old, new: upsert.upsert_articles(old, new, "seq"))
    return as_text(merged.select(*SHOWN, F.col("_action").alias("action"), F.col("_copies").alias("copies")), "published_at", "fetched_at")


def b9(spark, sf_dir):
    incoming = _incoming_lines(spark, sf_dir)
    merged = upsert.upsert_articles(_stored_lines(spark, sf_dir), incoming, "seq")
    return upsert.accounting(merged, incoming.where(F.col("url") == ""))


B9_SQL = S.with_ctes("line_articles", UPSERT_CTES + """
    SELECT inserted, updated, skipped, inserted + updated AS total FROM (
      SELECT count(*) FILTER (action = 'insert') AS inserted,
             CAST(sum(CASE action WHEN 'insert' THEN copies - 1 WHEN 'update' THEN copies ELSE 0 END) AS BIGINT) AS updated,
             (SELECT count(*) FROM raw WHERE url = '') AS skipped FROM merged)""")


def b9_null_url(spark, sf_dir):
    """Articles without a source arrive with NULL for a url; each is counted as skipped, per ticker."""
    rows = line_articles(spark, sf_dir).where(F.col("batch") == "F").drop("batch")
    rows = rows.withColumn("url", F.when(F.col("source_name").isNotNull(), F.col("url")))
    merged = upsert.upsert_articles(_stored_lines(spark, sf_dir), rows, "seq")
    return upsert.accounting_by(rows, "ticker", F.col("url") != "", merged.where(F.col("_action") == "insert"))


B9_NULL_SQL = S.with_ctes("line_articles", UPSERT_CTES + """
    , fresh AS (SELECT ticker, count(*) AS n FROM merged WHERE action = 'insert' GROUP BY 1)
    SELECT raw.ticker, coalesce(any_value(fresh.n), 0) AS inserted,
           count(*) FILTER (raw.url <> '') - coalesce(any_value(fresh.n), 0) AS updated, count(*) FILTER (raw.url = '') AS skipped
    FROM raw LEFT JOIN fresh ON fresh.ticker = raw.ticker GROUP BY 1""")


def _line_results(articles: DataFrame) -> DataFrame:
    """Stored results of two models for the open batch."""
    keyed = records.with_article_id(articles)
    first = keyed.select(
        "article_id", F.lit(MODEL).alias("model_name"), "sentiment_label", "sentiment_score", "sentiment_confidence", "analysed_at"
    )
    return first.unionByName(first.withColumn("model_name", F.lit("other")))


def b7(spark, sf_dir):
    stored = records.with_article_id(_stored_lines(spark, sf_dir))
    merged = upsert.upsert_sentiments(
        _line_results(stored), _incoming_lines(spark, sf_dir).select(
            "url", "sentiment_label", "sentiment_score", "sentiment_confidence", "analysed_at", "seq"
        ), stored, MODEL, "seq",
    )
    out = merged.join(stored.select("article_id", "url"), "article_id").select(
        "url", "model_name", "sentiment_label", F.col("sentiment_score").cast("long").alias("sentiment_score"),
        half_even(F.col("sentiment_confidence"), 6).alias("sentiment_confidence"),
        time_text("analysed_at").alias("analysed_at"), F.col("_action").alias("action"),
    )
    return out


B7_SQL = S.with_ctes("line_articles", UPSERT_CTES + """
    SELECT ex.url, m.name AS model_name,
           CASE WHEN hit THEN l.sentiment_label ELSE ex.sentiment_label END AS sentiment_label,
           CAST(CASE WHEN hit THEN l.sentiment_score ELSE ex.sentiment_score END AS BIGINT) AS sentiment_score,
           """ + S.r("CASE WHEN hit THEN l.sentiment_confidence ELSE ex.sentiment_confidence END", 6) + """ AS sentiment_confidence,
           strftime(CASE WHEN hit THEN l.analysed_at ELSE ex.analysed_at END, '%Y-%m-%d %H:%M:%S') AS analysed_at,
           CASE WHEN hit THEN 'update' ELSE 'keep' END AS action
    FROM (SELECT ex.*, m.name, (l.url IS NOT NULL AND m.name = 'keyword-v1') AS hit, l.url AS lurl
          FROM ex CROSS JOIN (VALUES ('keyword-v1'), ('other')) m(name) LEFT JOIN l ON l.url = ex.url) ex
    JOIN (VALUES ('keyword-v1'), ('other')) m(name) ON m.name = ex.name
    LEFT JOIN l ON l.url = ex.url""")


def _batch_prices(spark, sf_dir, status: str) -> DataFrame:
    from newstape.checks.views import daily_bars, trades

    px = F.col("l_extendedprice") / F.col("l_quantity")
    return daily_bars(trades(spark, sf_dir).where(F.col("l_linestatus") == status).select(
        F.col("p_brand").alias("ticker"), F.to_date("l_shipdate").alias("trading_date"), px.alias("px"),
        F.struct((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"), px.alias("px")).alias("k"),
        F.col("l_quantity").alias("q"),
    )).select(*PRICE.names)


def b8(spark, sf_dir):
    merged = upsert.upsert_prices(_batch_prices(spark, sf_dir, "O"), _batch_prices(spark, sf_dir, "F"))
    return with_day(merged.select(*PRICE.names, F.col("_action").alias("action")), "trading_date")


def b8_overlapping(spark, sf_dir):
    """Two quote files of one batch that overlap: the open and the finished bars, the finished file read last."""
    both = _batch_prices(spark, sf_dir, "O").withColumn("seq", F.lit(1)).unionByName(
        _batch_prices(spark, sf_dir, "F").withColumn("seq", F.lit(2))
    )
    table_, _ = loading.load_prices(spark, both, fresh_path(spark, "tables"), "seq")
    return with_day(table_, "trading_date")


def _bars_sql(status: str) -> str:
    return S.CTES["line_prices"].replace("ON l_partkey = p_partkey", f"ON l_partkey = p_partkey WHERE l_linestatus = '{status}'")


B8_SQL = f"""WITH ex AS ({_bars_sql('O')}), inc AS ({_bars_sql('F')})
    SELECT ticker, CAST(trading_date AS VARCHAR) AS trading_date, """ + ", ".join(
    f"CASE WHEN inc.volume IS NULL THEN ex.{c} ELSE inc.{c} END AS {c}"
    for c in ("open_price", "high_price", "low_price", "close_price", "volume")
) + """, CASE WHEN inc.volume IS NULL THEN ex.close_price ELSE inc.close_price END AS adjusted_close,
    CASE WHEN inc.volume IS NULL THEN 'keep' WHEN ex.volume IS NULL THEN 'insert' ELSE 'update' END AS action
    FROM ex FULL JOIN inc USING (ticker, trading_date)"""

# --- dedup, joins, lookups -----------------------------------------------------------


def w15(spark, sf_dir):
    rows = line_articles(spark, sf_dir).select(*SHOWN, "seq")
    out = upsert.keep_first(rows, ["ticker", "url"], "seq")
    return as_text(out.select(*SHOWN), "published_at", "fetched_at")


W15_SQL = S.with_ctes(
    "line_articles",
    """SELECT url, ticker, source_id, source_name, title, description,
              strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at,
              strftime(fetched_at, '%Y-%m-%d %H:%M:%S') AS fetched_at
       FROM (SELECT *, row_number() OVER (PARTITION BY ticker, url ORDER BY seq) AS n FROM line_articles) WHERE n = 1""",
)


def w16(spark, sf_dir):
    return with_day(lookups.latest_prices(line_prices(spark, sf_dir)), "trading_date")


LATEST_COLUMNS = "open_price, high_price, low_price, close_price, close_price AS adjusted_close, volume"
W16_SQL = S.with_ctes(
    "line_prices",
    f"""SELECT ticker, CAST(trading_date AS VARCHAR) AS trading_date, {LATEST_COLUMNS} FROM line_prices
        QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY trading_date DESC) = 1""",
)


def s3(spark, sf_dir):
    return with_day(lookups.latest_price(event_prices(spark, sf_dir), "t3"), "trading_date")


S3_SQL = S.with_ctes(
    "event_prices",
    f"""SELECT ticker, CAST(trading_date AS VARCHAR) AS trading_date, {LATEST_COLUMNS} FROM event_prices
        WHERE ticker = 'T3' ORDER BY trading_date DESC LIMIT 1""",
)


def s1(spark, sf_dir):
    return as_text(lookups.newest_first(event_articles(spark, sf_dir), "t5").select("event_id", "published_at"), "published_at")


S1_SQL = S.with_ctes(
    "event_articles",
    """SELECT event_id, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at FROM event_articles
       WHERE ticker = 'T5' ORDER BY event_articles.published_at DESC""",
)


def s2(spark, sf_dir):
    return with_day(lookups.oldest_first(line_prices(spark, sf_dir)).select("ticker", "trading_date", "close_price"), "trading_date")


S2_SQL = S.with_ctes(
    "line_prices",
    "SELECT ticker, CAST(trading_date AS VARCHAR) AS trading_date, close_price FROM line_prices ORDER BY 1, 2",
)


def s5(spark, sf_dir):
    rows = daily.daily_sentiment(dated(spark, sf_dir)).select("date", "ticker", "article_count")
    return with_day(rows.orderBy("date", "ticker"))


S5_SQL = S.with_ctes(
    "line_articles line_daily",
    "SELECT CAST(date AS VARCHAR) AS date, ticker, article_count FROM line_daily ORDER BY 1, 2",
)


def j1(spark, sf_dir):
    out = lookups.scored_articles(
        stored_articles(spark, sf_dir).select("article_id", "url", "ticker"), stored_sentiments(spark, sf_dir)
    )
    return out.select("url", "ticker", "model_name", "sentiment_label")


J1_SQL = S.with_ctes(
    "event_articles stored_sentiments",
    "SELECT url, ticker, model_name, s.sentiment_label FROM event_articles JOIN stored_sentiments s USING (url)",
)


def _unscored(model_name=None, strict=False):
    def build(spark, sf_dir):
        out = lookups.without_sentiment(
            stored_articles(spark, sf_dir).select("article_id", "url", "ticker"),
            stored_sentiments(spark, sf_dir), model_name, strict,
        )
        return out.select("url", "ticker")

    return build


J2_HEAD = "SELECT url, ticker FROM event_articles a WHERE "
J2_ANY = "NOT EXISTS (SELECT 1 FROM stored_sentiments s WHERE s.url = a.url"
J2_SQL = S.with_ctes("event_articles stored_sentiments", J2_HEAD + J2_ANY + ")")
J2_MODEL_SQL = S.with_ctes(
    "event_articles stored_sentiments",
    J2_HEAD + J2_ANY + ") OR EXISTS (SELECT 1 FROM stored_sentiments s WHERE s.url = a.url AND model_name <> 'keyword-v1')",
)
J2_STRICT_SQL = S.with_ctes("event_articles stored_sentiments", J2_HEAD + J2_ANY + " AND model_name = 'keyword-v1')")


def j3(spark, sf_dir):
    """Incoming results whose url is known or not, per ticker."""
    stored = records.with_article_id(_stored_lines(spark, sf_dir))
    linked = upsert.attach_articles(_incoming_lines(spark, sf_dir), stored)
    return linked.groupBy("ticker").agg(
        F.count("article_id").alias("linked"), F.count_if(F.col("article_id").isNull()).alias("skipped")
    )


J3_SQL = S.with_ctes("line_articles", UPSERT_CTES + """
    SELECT raw.ticker, count(ex.url) AS linked, count(*) FILTER (ex.url IS NULL) AS skipped
    FROM raw LEFT JOIN ex ON ex.url = raw.url GROUP BY 1""")


def j7(spark, sf_dir):
    """Rows per outcome of the full outer merge."""
    merged = upsert.upsert_prices(_batch_prices(spark, sf_dir, "O"), _batch_prices(spark, sf_dir, "F"))
    return merged.groupBy(F.col("_action").alias("action")).agg(F.count(F.lit(1)).alias("n"))


J7_SQL = f"""WITH ex AS ({_bars_sql('O')}), inc AS ({_bars_sql('F')})
    SELECT CASE WHEN inc.volume IS NULL THEN 'keep' WHEN ex.volume IS NULL THEN 'insert' ELSE 'update' END AS action,
           count(*) AS n FROM ex FULL JOIN inc USING (ticker, trading_date) GROUP BY 1"""


def j8(spark, sf_dir):
    """Label to score; event types that are no label become neutral."""
    kind = F.col("event_type")
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "purchase", "POSITIVE").when(kind == "error", "Negative").otherwise(kind).alias("sentiment_label"),
    )
    return lookups.with_score(rows).withColumn("sentiment_score", F.col("sentiment_score").cast("long"))


J8_SQL = """SELECT event_id, CASE event_type WHEN 'purchase' THEN 'positive' WHEN 'error' THEN 'negative' ELSE 'neutral' END AS sentiment_label,
    CAST(CASE event_type WHEN 'purchase' THEN 1 WHEN 'error' THEN -1 ELSE 0 END AS BIGINT) AS sentiment_score FROM events"""

# --- unions ---------------------------------------------------------------------------


def u1(spark, sf_dir):
    """Feature frames of two halves of the calendar, united: equal to one pass."""
    rows = dated(spark, sf_dir)
    split = dt.date(1998, 1, 1)
    early = daily.daily_sentiment(rows.where(F.col("date") < F.lit(split)))
    late = daily.daily_sentiment(rows.where(F.col("date") >= F.lit(split)))
    return with_day(early.unionByName(late))


U1_SQL = S.with_ctes(
    "line_articles line_daily",
    f"SELECT ticker, CAST(date AS VARCHAR) AS date, {', '.join(S.daily_sql(c) for c in SENTIMENT_FEATURES)} FROM line_daily",
)


def u2(spark, sf_dir):
    """Two overlapping fetches of the same articles, united and reduced to one row per url."""
    rows = line_articles(spark, sf_dir)
    both = rows.where(F.col("batch") == "O").unionByName(rows).select("url", "ticker", "title", "fetched_at", "seq")
    return as_text(upsert.keep_first(both, ["url"], "seq").drop("seq"), "fetched_at")


U2_SQL = S.with_ctes(
    "line_articles",
    """SELECT url, ticker, title, strftime(fetched_at, '%Y-%m-%d %H:%M:%S') AS fetched_at
       FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY seq) AS n FROM line_articles) WHERE n = 1""",
)


def u3(spark, sf_dir):
    """Both landed feeds in one schema."""
    both = a1(spark, sf_dir).unionByName(a2(spark, sf_dir))
    return both.select("ticker", "source_id", "source_name", "url", "published_at")


U3_SQL = f"""SELECT ticker, source_id, source_name, url, published_at FROM ({A1_SQL})
    UNION ALL SELECT ticker, source_id, source_name, url, published_at FROM ({A2_SQL})"""

# --- reports --------------------------------------------------------------------------


def g4(spark, sf_dir):
    return reports.sentiment_distribution(stored_articles(spark, sf_dir), stored_sentiments(spark, sf_dir))


G4_SQL = S.with_ctes(
    "event_articles stored_sentiments",
    'SELECT s.sentiment_label, count(*) AS "count" FROM event_articles JOIN stored_sentiments s USING (url) GROUP BY 1',
)


def g4_filtered(spark, sf_dir):
    return reports.sentiment_distribution(stored_articles(spark, sf_dir), stored_sentiments(spark, sf_dir), "t2", MODEL)


G4_FILTERED_SQL = S.with_ctes(
    "event_articles stored_sentiments",
    """SELECT s.sentiment_label, count(*) AS "count" FROM event_articles JOIN stored_sentiments s USING (url)
       WHERE ticker = 'T2' AND model_name = 'keyword-v1' GROUP BY 1""",
)


def g5(spark, sf_dir):
    counts = [
        ("articles", reports.row_count(event_articles(spark, sf_dir))),
        ("articles of T3", reports.row_count(event_articles(spark, sf_dir), ticker="t3")),
        ("results", reports.row_count(stored_sentiments(spark, sf_dir))),
        ("results of a model", reports.row_count(stored_sentiments(spark, sf_dir), model_name=MODEL)),
        ("prices", reports.row_count(event_prices(spark, sf_dir))),
        ("prices of T3", reports.row_count(event_prices(spark, sf_dir), ticker="t3")),
    ]
    out = None
    for name, df in counts:
        row = df.select(F.lit(name).alias("what"), "count")
        out = row if out is None else out.unionByName(row)
    return out


G5_SQL = S.with_ctes(
    "event_articles stored_sentiments event_prices",
    """SELECT 'articles' AS what, count(*) AS "count" FROM event_articles
       UNION ALL SELECT 'articles of T3', count(*) FROM event_articles WHERE ticker = 'T3'
       UNION ALL SELECT 'results', count(*) FROM stored_sentiments
       UNION ALL SELECT 'results of a model', count(*) FROM stored_sentiments WHERE model_name = 'keyword-v1'
       UNION ALL SELECT 'prices', count(*) FROM event_prices
       UNION ALL SELECT 'prices of T3', count(*) FROM event_prices WHERE ticker = 'T3'""",
)


def _asked(spark, sf_dir) -> DataFrame:
    """Requested tickers: every brand, and the market segments, which have no rows."""
    brands = table(spark, sf_dir, "part").select(F.col("p_brand").alias("ticker"))
    return brands.unionByName(table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("ticker"))).distinct()


ASKED_SQL = ", asked AS (SELECT p_brand AS ticker FROM part UNION SELECT c_mktsegment FROM customer) "


def g6(spark, sf_dir):
    return as_text(reports.ingestion_summary(line_articles(spark, sf_dir), _asked(spark, sf_dir)), "earliest", "latest")


G6_SQL = S.with_ctes("line_articles", ASKED_SQL + """
    SELECT q.ticker, count(a.ticker) AS article_count, strftime(min(published_at), '%Y-%m-%d %H:%M:%S') AS earliest,
           strftime(max(published_at), '%Y-%m-%d %H:%M:%S') AS latest, count(DISTINCT source_name) AS unique_sources,
           CASE WHEN count(a.ticker) > 0 THEN 'ok' ELSE 'empty' END AS status
    FROM asked q LEFT JOIN line_articles a ON a.ticker = q.ticker GROUP BY 1""")


def g7(spark, sf_dir):
    return reports.sentiment_summary(line_articles(spark, sf_dir), _asked(spark, sf_dir))


G7_SQL = S.with_ctes("line_articles", ASKED_SQL + f"""
    SELECT q.ticker, count(a.ticker) AS article_count, count(*) FILTER (sentiment_label = 'positive') AS positive,
           count(*) FILTER (sentiment_label = 'neutral') AS neutral, count(*) FILTER (sentiment_label = 'negative') AS negative,
           {S.r('avg(CAST(sentiment_score AS DOUBLE))', 4)} AS mean_score,
           CASE WHEN count(a.ticker) > 0 THEN 'ok' ELSE 'empty' END AS status
    FROM asked q LEFT JOIN line_articles a ON a.ticker = q.ticker GROUP BY 1""")


def g8(spark, sf_dir):
    stored, incoming = _stored_lines(spark, sf_dir), _incoming_lines(spark, sf_dir)
    merged = upsert.upsert_articles(stored, incoming, "seq")
    articles = upsert.accounting_by(incoming, "ticker", F.col("url") != "", merged.where(F.col("_action") == "insert"))
    linked = upsert.attach_articles(incoming.select("ticker", "url"), records.with_article_id(stored.select("url")))
    results = upsert.accounting_by(linked, "ticker", F.col("article_id").isNotNull())
    out = reports.load_summary(articles, results)
    return out.withColumns({"tickers": F.col("tickers").cast("long"), "is_total": F.col("is_total").cast("long")})


G8_SQL = S.with_ctes("line_articles", UPSERT_CTES + """
    , a AS (SELECT raw.ticker, count(*) FILTER (raw.url <> '' AND f.url IS NOT NULL AND ex.url IS NULL) AS ins,
                   count(*) FILTER (raw.url <> '') AS used, count(*) FILTER (raw.url = '') AS skip,
                   count(*) FILTER (ex.url IS NOT NULL) AS linked
            FROM raw LEFT JOIN f ON f.url = raw.url AND f.seq = raw.seq AND f.ticker = raw.ticker
                     LEFT JOIN ex ON ex.url = raw.url GROUP BY 1),
       firsts AS (SELECT f.ticker, count(*) AS ins FROM f WHERE f.url NOT IN (SELECT url FROM ex) GROUP BY 1),
       per AS (SELECT a.ticker, coalesce(firsts.ins, 0) AS ins, used, skip, linked
               FROM a LEFT JOIN firsts USING (ticker)),
       tot AS (SELECT count(*) AS n FROM raw)
    SELECT ticker, CAST(sum(ins) AS BIGINT) AS articles_inserted, CAST(sum(used - ins) AS BIGINT) AS articles_updated,
           CAST(sum(skip) AS BIGINT) AS articles_skipped, CAST(0 AS BIGINT) AS sentiment_inserted,
           CAST(sum(linked) AS BIGINT) AS sentiment_updated,
           CAST(sum(used + skip - linked) AS BIGINT) AS sentiment_skipped,
           count(DISTINCT ticker) AS tickers, CAST(grouping(ticker) AS BIGINT) AS is_total,
           CAST(sum(used) AS BIGINT) AS articles_total, CAST(sum(linked) AS BIGINT) AS sentiment_total
    FROM per GROUP BY ROLLUP (ticker)""")


def g9(spark, sf_dir):
    out = reports.price_summary(line_prices(spark, sf_dir), _asked(spark, sf_dir))
    return out.withColumns({c: day_text(c) for c in ("date_min", "date_max")})


G9_SQL = S.with_ctes("line_prices", ASKED_SQL + """
    SELECT q.ticker, count(p.ticker) AS rows_fetched, CAST(min(trading_date) AS VARCHAR) AS date_min,
           CAST(max(trading_date) AS VARCHAR) AS date_max,
           CASE WHEN count(p.ticker) > 0 THEN 'ok' ELSE 'empty' END AS status
    FROM asked q LEFT JOIN line_prices p ON p.ticker = q.ticker GROUP BY 1""")


def g10(spark, sf_dir):
    return reports.feature_summary(daily.daily_features(dated(spark, sf_dir)))


G10_SQL = S.with_ctes(
    "line_articles line_daily",
    """SELECT count(DISTINCT date) AS dates_with_data, count(DISTINCT ticker) AS tickers, count(*) AS feature_rows,
              CAST(sum(article_count) AS BIGINT) AS total_articles, CAST(22 AS BIGINT) AS features_per_row FROM line_daily""",
)


def _dataset(spark, sf_dir) -> DataFrame:
    return labels.label_features(daily.daily_features(dated(spark, sf_dir)), line_prices(spark, sf_dir))


DATASET_CTES = "line_articles line_daily line_prices future returns labels_of"
DATASET_FROM = "FROM line_daily d JOIN labels_of l ON l.ticker = d.ticker AND l.trading_date = d.date"


def g11(spark, sf_dir):
    out = reports.dataset_summary(_dataset(spark, sf_dir))
    return out.withColumns({c: day_text(c) for c in ("min_date", "max_date")})


G11_SQL = S.with_ctes(DATASET_CTES, f"""
    SELECT count(*) FILTER (label_direction = 'BUY') AS buy_count, count(*) FILTER (label_direction = 'SELL') AS sell_count,
           count(*) FILTER (label_direction = 'HOLD') AS hold_count, count(*) FILTER (label_direction IS NULL) AS null_count,
           CAST(min(date) AS VARCHAR) AS min_date, CAST(max(date) AS VARCHAR) AS max_date,
           count(DISTINCT date) AS dates_with_data, count(DISTINCT d.ticker) AS tickers, count(*) AS dataset_rows,
           CAST(22 AS BIGINT) AS feature_columns, CAST(13 AS BIGINT) AS label_columns {DATASET_FROM}""")


def g14(spark, sf_dir):
    return reports.drop_report(_dataset(spark, sf_dir))


G14_SQL = S.with_ctes(DATASET_CTES, f"""
    SELECT count(*) AS rows_read, count(label_direction) AS rows_kept, count(*) - count(label_direction) AS rows_dropped,
           count(DISTINCT date) AS dates, 'historical' AS mode {DATASET_FROM}""")

# --- sinks: written, then read back --------------------------------------------------


def b1(spark, sf_dir):
    rows = daily.daily_features(dated(spark, sf_dir))
    path = sinks.write_features(rows, fresh_path(spark, "out"), FIRST, LAST, by_month=True)
    return with_day(spark.read.parquet(path).select(*rows.columns))


def b2(spark, sf_dir):
    """All 56 columns of the dataset."""
    from newstape.checks.daily_queries import _dataset_columns, feature_rows
    from newstape.plans.dataset import labelled_dataset

    rows = labelled_dataset(feature_rows(spark, sf_dir), line_prices(spark, sf_dir), FIRST, LAST)
    path = sinks.write_dataset(rows, fresh_path(spark, "out"), FIRST, LAST, by_month=True)
    return _dataset_columns(sinks.read_written(spark, path, rows.schema))


def _enriched(spark, sf_dir) -> DataFrame:
    """All fourteen columns of an enriched article; the tickers are numbers."""
    rows = line_articles(spark, sf_dir).withColumn("ticker", F.lpad(F.regexp_extract("ticker", "[0-9]+", 0), 4, "0"))
    return rows.select(*ENRICHED_ARTICLE.names)


def _enriched_text(rows: DataFrame) -> DataFrame:
    out = rows.withColumns({
        "sentiment_score": F.col("sentiment_score").cast("long"),
        "sentiment_confidence": half_even(F.col("sentiment_confidence").cast("double"), 6),
    })
    return as_text(out, "published_at", "fetched_at", "analysed_at")


def b3(spark, sf_dir):
    rows = _enriched(spark, sf_dir)
    path = sinks.write_enriched(rows, fresh_path(spark, "out"), "2024", fmt="csv")
    return _enriched_text(sinks.read_written(spark, path, rows.schema, "csv"))


def b3_raw(spark, sf_dir):
    """The articles as they were fetched, and the summary of the fetch, both written and read back."""
    rows = _enriched(spark, sf_dir)
    folder = fresh_path(spark, "out")
    written = sinks.read_written(spark, sinks.write_raw(rows, folder, "news", "2024"), rows.schema)
    summary = reports.ingestion_summary(written, written.select("ticker"))
    path = sinks.write_summary(summary, folder, "news", "2024")
    return as_text(sinks.read_written(spark, path, summary.schema, "csv"), "earliest", "latest")


B3_SQL = S.with_ctes("line_articles", """
    SELECT lpad(regexp_extract(ticker, '[0-9]+'), 4, '0') AS ticker, source_id, source_name, author, title, description, url,
           strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at, content,
           strftime(fetched_at, '%Y-%m-%d %H:%M:%S') AS fetched_at, sentiment_label,
           CAST(sentiment_score AS BIGINT) AS sentiment_score, """ + S.r("sentiment_confidence", 6) + """ AS sentiment_confidence,
           strftime(analysed_at, '%Y-%m-%d %H:%M:%S') AS analysed_at FROM line_articles""")
B3_RAW_SQL = S.with_ctes("line_articles", """
    SELECT lpad(regexp_extract(ticker, '[0-9]+'), 4, '0') AS ticker, count(*) AS article_count,
           strftime(min(published_at), '%Y-%m-%d %H:%M:%S') AS earliest, strftime(max(published_at), '%Y-%m-%d %H:%M:%S') AS latest,
           count(DISTINCT source_name) AS unique_sources, 'ok' AS status FROM line_articles GROUP BY 1""")


def versions(spark, sf_dir):
    """Prices of the open batch merged into a stored table by month, then those of the finished batch."""
    stored = loading.price_table(spark, fresh_path(spark, "prices"))
    for status in ("O", "F"):
        stored.merge(_batch_prices(spark, sf_dir, status), lambda old, new: upsert.upsert_prices(old, new))
    return with_day(stored.read(), "trading_date")


VERSIONS_SQL = "SELECT * EXCLUDE (action) FROM (" + B8_SQL + ")"

QUERIES = {
    "a1_feed_articles": (a1, A1_SQL),
    "a2_archive_articles": (a2, A2_SQL),
    "a1_rejected_items": (a1_rejects, A1_REJECTS_SQL),
    "a3_company_phrases": (a3, A3_SQL),
    "a3_company_phrases_table": (a3_table, A3_TABLE_SQL),
    "a3_phrases_in_documents": (a3_items, A3_ITEMS_SQL),
    "a4_backfill_coverage": (a4, A4_SQL),
    "a5_csv_features": (a5, DAILY_SQL),
    "a6_file_names": (a6, A6_SQL),
    "a6_named_files": (a6_files, A6_FILES_SQL),
    "a7_article_window": (a7, A7_SQL),
    "a8_price_range": (a8, A8_SQL),
    "a9_label_prices": (a9, A9_SQL),
    "a10_quotes": (a10, A10_SQL),
    "b1_feature_sink": (b1, DAILY_SQL),
    "b2_dataset_sink": (b2, P3_SQL),
    "b3_enriched_sink": (b3, B3_SQL),
    "b3_raw_and_summary_sinks": (b3_raw, B3_RAW_SQL),
    "b6_upsert_articles": (b6, B6_SQL),
    "b6_upsert_articles_small_batch": (b6_small, B6_SQL),
    "b7_upsert_sentiments": (b7, B7_SQL),
    "b8_upsert_prices": (b8, B8_SQL),
    "b8_overlapping_batch": (b8_overlapping, VERSIONS_SQL),
    "b8_published_versions": (versions, VERSIONS_SQL),
    "b9_upsert_accounting": (b9, B9_SQL),
    "b9_null_url": (b9_null_url, B9_NULL_SQL),
    "c1_nan_to_null": (c1, C1_SQL),
    "c2_lenient_timestamp": (c2, C2_SQL),
    "c3_article_records": (c3, C3_SQL),
    "c4_sentiment_records": (c4, C4_SQL),
    "c5_text_or_null": (c5, C5_SQL),
    "c6_ticker_symbols": (c6, C6_SQL),
    "c8_model_text": (c8, C8_SQL),
    "c9_column_order": (c9, C9_SQL),
    "c10_rounding": (c10, C10_SQL),
    "c13_predicates": (c13, C13_SQL),
    "w15_keep_first": (w15, W15_SQL),
    "w16_latest_prices": (w16, W16_SQL),
    "j1_scored_articles": (j1, J1_SQL),
    "j2_without_sentiment": (_unscored(), J2_SQL),
    "j2_without_sentiment_model": (_unscored(MODEL), J2_MODEL_SQL),
    "j2_without_sentiment_strict": (_unscored(MODEL, True), J2_STRICT_SQL),
    "j3_url_lookup": (j3, J3_SQL),
    "j7_merge_outcomes": (j7, J7_SQL),
    "j8_label_scores": (j8, J8_SQL),
    "s1_newest_first": (s1, S1_SQL),
    "s2_oldest_first": (s2, S2_SQL),
    "s3_latest_price": (s3, S3_SQL),
    "s5_date_ticker_order": (s5, S5_SQL),
    "u1_united_days": (u1, U1_SQL),
    "u2_united_fetches": (u2, U2_SQL),
    "u3_two_feeds": (u3, U3_SQL),
    "g4_sentiment_distribution": (g4, G4_SQL),
    "g4_sentiment_distribution_filtered": (g4_filtered, G4_FILTERED_SQL),
    "g5_counts": (g5, G5_SQL),
    "g6_ingestion_summary": (g6, G6_SQL),
    "g7_sentiment_summary": (g7, G7_SQL),
    "g8_load_summary": (g8, G8_SQL),
    "g9_price_summary": (g9, G9_SQL),
    "g10_feature_summary": (g10, G10_SQL),
    "g11_dataset_summary": (g11, G11_SQL),
    "g14_drop_report": (g14, G14_SQL),
}
