import datetime as dt
import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from newstape.errors import LoadError
from newstape.operators import records, tagging
from newstape.operators.tagging import phrase_of
from newstape.schemas import ARCHIVE_PAYLOAD, ARTICLE, ENRICHED_ARTICLE, FEATURES, PRICE
from newstape.plans import loading
from newstape.sources import files, payloads, quotes, scans, sinks

NOW = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)


def feed_item(**changes):
    item = {
        "category": "company", "datetime": 1704877200, "headline": " Apple Q4 Earnings Beat Expectations ", "id": 100001,
        "image": "", "related": "AAPL", "source": "Reuters", "summary": "", "url": "https://example.com/a",
    }
    return {k: v for k, v in (item | changes).items() if v != "absent"}


def test_feed_array_file(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([
        feed_item(), feed_item(id=None, datetime="soon", url="absent", source="  "),
    ]))
    rows = payloads.feed_articles(payloads.read_feed(spark, str(tmp_path)), " aapl", NOW).orderBy("source_id").collect()
    bad, good = rows
    assert good["ticker"] == "AAPL" and good["source_id"] == "100001"
    assert good["title"] == "Apple Q4 Earnings Beat Expectations" and good["description"] is None
    assert good["published_at"] == dt.datetime(2024, 1, 10, 9, 0)
    assert good["author"] is None and good["content"] is None
    assert bad["source_id"] is None and bad["published_at"] is None and bad["url"] == "" and bad["source_name"] is None


def test_empty_feed_keeps_the_schema(spark, tmp_path):
    (tmp_path / "a.json").write_text("[]")
    out = payloads.feed_articles(payloads.read_feed(spark, str(tmp_path)), "AAPL", NOW)
    assert out.isEmpty() and out.columns == ARTICLE.names


def test_archive_file(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"articles": [
        {"url": "https://reuters.com/1", "title": " One ", "seendate": "20250115T120000Z", "domain": "reuters.com"},
        {"url": "", "title": "Two", "seendate": "yesterday", "domain": ""},
        {"title": "Three", "seendate": None},
    ]}))
    (tmp_path / "b.json").write_text(json.dumps({"articles": None}))
    rows = payloads.archive_articles(payloads.read_archive(spark, str(tmp_path)), "TSLA", NOW).orderBy("title").collect()
    one, three, two = rows
    assert one["source_id"] == hashlib.sha256(b"https://reuters.com/1").hexdigest()[:16]
    assert one["published_at"] == dt.datetime(2025, 1, 15, 12, 0) and one["source_name"] == "reuters.com"
    assert two["source_id"] == "" and two["published_at"] is None and two["source_name"] is None
    assert three["url"] == "" and three["source_id"] == ""


def test_broken_items_are_kept_apart(spark, tmp_path):
    whole = json.dumps([feed_item(), feed_item(id=2, datetime="late")])
    (tmp_path / "a.json").write_text(whole)
    (tmp_path / "b.json").write_text(whole[:-40])
    items = payloads.read_feed(spark, str(tmp_path))
    assert {(r["id"], r["datetime"]) for r in items.collect()} == {("100001", 1704877200), ("2", None)}
    assert [tuple(r) for r in payloads.rejected(spark, str(tmp_path)).collect()] == [("b.json", whole[:-40])]
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "lines.json").write_text('{"articles": []}\n{"articles": [{"url"\n')
    folder = str(tmp_path / "c")
    assert payloads.read_archive(spark, folder, multi_line=False).count() == 1
    assert payloads.rejected(spark, folder, ARCHIVE_PAYLOAD, multi_line=False).first()["record"] == '{"articles": [{"url"'


def test_phrases_match_whole_words(spark):
    titles = spark.createDataFrame([
        (1, "APPLE INC. beats"), (2, "Applebee's opens"), (3, "apple, inc and Tesla"), (4, "Pineapple Inc"), (5, None),
    ], "id int, title string")
    phrases = {t: phrase_of(t) for t in ("AAPL", "TSLA", "GOOGL")}
    assert phrases["GOOGL"] == "GOOGL"
    want = {(1, "AAPL"), (3, "AAPL"), (3, "TSLA")}
    known = tagging.phrase_table(spark, ["aapl", "TSLA", "GOOGL"])
    assert {(r["id"], r["ticker"]) for r in tagging.tag(titles, known, "id").collect()} == want
    many = known.unionByName(spark.range(500).selectExpr("concat('X', id) AS ticker", "concat('apple phrase ', id) AS phrase"))
    for limit in (tagging.AUTOMATON_BYTES, 0):  # an automaton; a bit table and a join
        assert {(r["id"], r["ticker"]) for r in tagging.tag(titles, many, "id", limit=limit).collect()} == want
    nothing = spark.createDataFrame([("A", " .. "), ("B", None)], "ticker string, phrase string")
    assert tagging.tag(titles, nothing, "id").isEmpty() and tagging.tag(titles, nothing.limit(0), "id").isEmpty()


@pytest.mark.parametrize("limit", [tagging.AUTOMATON_BYTES, 0])
def test_phrases_inside_phrases(spark, limit):
    r = random.Random(3)
    word = lambda: r.choice(["a", "b", "ab", "ba", "é", "1"])
    phrases = [(f"T{k % 9}", r.choice([" ", "-"]).join(word() for _ in range(r.randint(1, 5)))) for k in range(40)]
    texts = [(k, "!".join(word().upper() for _ in range(r.randint(0, 25)))) for k in range(150)]
    plain = lambda t: f" {' '.join(''.join(c if c.isalnum() else ' ' for c in t.lower()).split())} "
    want = {(k, t) for k, text in texts for t, p in phrases if plain(p) in plain(text)}
    known, docs = spark.createDataFrame(phrases, "ticker string, phrase string"), spark.createDataFrame(texts, "id int, title string")
    assert {tuple(x) for x in tagging.tag(docs.union(docs), known, "id", limit=limit).collect()} == want


def test_no_text_is_exploded_broadcast_or_shuffled_by_word(spark, sample):
    docs = spark.read.parquet(f"{sample}/documents.parquet").select("doc_id", "text")
    known = spark.createDataFrame([("A", "of the")], "ticker string, phrase string")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    one = plan(tagging.tag(docs, known, "doc_id", "text"))
    assert "Generate" not in one and "Join" not in one and one.count("Exchange") == 1  # the distinct of the pairs
    assert "hashpartitioning(doc_id" in one
    other = plan(tagging.tag(docs, known, "doc_id", "text", limit=0))
    assert "Generate" not in other and "hashpartitioning(_words" not in other


def test_coverage_keeps_empty_windows_and_flags_the_cap(spark):
    start, end = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc), dt.datetime(2025, 1, 20, tzinfo=dt.timezone.utc)
    rows = [("AAPL", dt.datetime(2025, 1, 7, 23, 59, 59)), ("AAPL", dt.datetime(2025, 1, 8)), ("AAPL", dt.datetime(2025, 1, 8)),
            ("AAPL", dt.datetime(2025, 1, 21))]
    articles = spark.createDataFrame(rows, "ticker string, published_at timestamp")
    tickers = spark.createDataFrame([("AAPL",), ("TSLA",)], "ticker string")
    out = {(r["ticker"], r["chunk"]): r for r in tagging.coverage(articles, tickers, start, end, cap=2).collect()}
    assert len(out) == 6
    assert [out["AAPL", i]["article_count"] for i in range(3)] == [1, 2, 0]
    assert out["AAPL", 1]["possibly_truncated"] and not out["AAPL", 0]["possibly_truncated"]
    assert out["AAPL", 0]["chunk_end"] == dt.datetime(2025, 1, 7, 23, 59, 59)
    assert out["AAPL", 2]["chunk_end"] == dt.datetime(2025, 1, 20)


def test_csv_checks_and_types(spark, tmp_path):
    (tmp_path / "f.csv").write_text("ticker,date,article_count,positive_ratio,extra\nAAPL,2026-06-16,3,0.5,x\nAAPL,oops,nan,,y\n")
    out = files.load_table(spark, str(tmp_path / "f.csv"), FEATURES).orderBy("extra").collect()
    assert out[0]["date"] == dt.date(2026, 6, 16) and out[0]["article_count"] == 3 and out[0]["positive_ratio"] == 0.5
    assert out[1]["date"] is None and out[1]["article_count"] is None and out[1]["positive_ratio"] is None
    with pytest.raises(LoadError, match="label_direction"):
        files.load_table(spark, str(tmp_path / "f.csv"), FEATURES, ["label_direction"])
    with pytest.raises(LoadError, match="cannot read"):
        files.load_table(spark, str(tmp_path / "absent.csv"), FEATURES)


def test_files_are_found_and_read_by_name(spark, tmp_path):
    line = "ticker,url,title,published_at\n{0},http://x/{0},\"a, \"\"b\"\"\nc\",2025-01-01T10:00:00+00:00\n"
    (tmp_path / "AAPL_news_2025-01-01.csv").write_text(line.format("AAPL"))
    (tmp_path / "TSLA_gdelt_2024-01-01_2025-01-01.csv").write_text(line.format("TSLA"))
    rows = files.load_named_files(spark, f"{tmp_path}/*.csv", ENRICHED_ARTICLE).orderBy("ticker").collect()
    assert [(r["file_ticker"], r["kind"], r["tag"]) for r in rows] == [
        ("AAPL", "feed", "2025-01-01"), ("TSLA", "archive", "2024"),
    ]
    assert rows[0]["title"] == 'a, "b"\nc' and rows[0]["published_at"] == dt.datetime(2025, 1, 1, 10)
    only = files.load_named_files(spark, f"{tmp_path}/*.csv", ENRICHED_ARTICLE, ["TSLA"])
    assert len(only.inputFiles()) == 1 and "TSLA" in only.inputFiles()[0]  # the others are not opened
    assert files.load_named_files(spark, f"{tmp_path}/*.csv", ENRICHED_ARTICLE, ["NONE"]).isEmpty()
    assert only.count() == 1
    (tmp_path / "notes.csv").write_text(line.format("X"))
    with pytest.raises(Exception, match="cannot infer a ticker"):
        files.load_named_files(spark, f"{tmp_path}/*.csv", ENRICHED_ARTICLE).collect()


def test_quotes(spark, tmp_path):
    (tmp_path / "q.csv").write_text(
        "Date,Open,High,Low,Close,Adj Close,Volume\n2026-01-05 00:00:00-05:00,1,2,0.5,1.5,1.4,100\n"
        "2026-01-06,1,2,0.5,1.5,,nan\nnever,1,1,1,1,1,1\n"
    )
    raw = spark.read.option("header", True).csv(str(tmp_path / "q.csv"))
    out = quotes.normalised_quotes(raw, " aapl ").orderBy("trading_date").collect()
    assert [r["trading_date"] for r in out] == [dt.date(2026, 1, 5), dt.date(2026, 1, 6)]
    assert out[0]["adjusted_close"] == 1.4 and out[1]["adjusted_close"] == 1.5
    assert out[0]["volume"] == 100 and out[1]["volume"] is None and out[0]["ticker"] == "AAPL"
    plain = quotes.normalised_quotes(raw.drop("Adj Close"), "AAPL")
    assert plain.columns == PRICE.names and plain.orderBy("trading_date").first()["adjusted_close"] == 1.5
    with pytest.raises(LoadError, match="Volume"):
        quotes.normalised_quotes(raw.drop("Volume"), "AAPL")


def test_window_bounds_and_models(spark):
    articles = spark.createDataFrame([
        ("a", "AAPL", "s", dt.datetime(2026, 6, 9, 0, 0)), ("b", "AAPL", "s", dt.datetime(2026, 6, 16, 23, 59, 59, 999999)),
        ("c", "AAPL", "s", dt.datetime(2026, 6, 17)), ("d", "TSLA", "s", dt.datetime(2026, 6, 16)), ("e", "AAPL", "s", None),
    ], "article_id string, ticker string, source_name string, published_at timestamp")
    results = spark.createDataFrame(
        [(i, m, "positive", 1, 0.9) for i in "abcde" for m in ("m1", "m2")],
        "article_id string, model_name string, sentiment_label string, sentiment_score int, sentiment_confidence double",
    )
    window = (articles, results, dt.date(2026, 6, 9), dt.date(2026, 6, 16))
    assert scans.article_window(*window).count() == 6
    assert scans.article_window(*window, ["aapl"], "m1").count() == 2


def test_label_prices_without_tickers_is_empty(spark):
    rows = spark.createDataFrame([("AAPL", dt.date(2026, 1, 1), 1.0)], "ticker string, trading_date date, close_price double")
    assert scans.label_prices(rows, [], dt.date(2026, 1, 1), dt.date(2026, 1, 2)).isEmpty()
    assert scans.label_prices(rows, ["aapl"], dt.date(2026, 1, 1), dt.date(2026, 1, 1)).count() == 1


def test_partitioned_sinks_and_tags(spark, tmp_path):
    day = dt.date(2026, 1, 1)
    rows = spark.createDataFrame([("AAPL", day, 1)], "ticker string, date date, n int")
    path = sinks.write_features(rows, str(tmp_path), day, day)
    assert path.endswith("feature_dataset_2026-01-01_2026-01-01") and spark.read.parquet(path).count() == 1
    assert sinks.write_dataset(rows, str(tmp_path), day, day).endswith("ml_dataset_2026-01-01")


def test_csv_sinks_keep_line_breaks_and_numeric_tickers(spark, tmp_path):
    rows = spark.createDataFrame([("0700", 'a "b",\nc', 1.5), ("0005", "x", None), ("0005", None, 2.0)], "ticker string, title string, n double")
    path = sinks.write_enriched(rows, str(tmp_path), "t", "csv")
    back = sinks.read_written(spark, path, rows.schema, "csv")
    assert back.schema == rows.schema
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))


def test_csv_sinks_are_compressed(spark, tmp_path):
    rows = spark.range(2000).select(F.lit("0700").alias("ticker"), F.concat(F.lit("http://news.example/"), "id").alias("url"))
    path = sinks.write_enriched(rows, str(tmp_path), "t", "csv")
    files_ = [f for f in (tmp_path / "news_sentiment_t").rglob("part-*")]
    assert files_ and all(f.name.endswith(".csv.gz") for f in files_)
    assert sum(f.stat().st_size for f in files_) < 2000 * 10
    assert sinks.read_written(spark, path, rows.schema, "csv").exceptAll(rows).isEmpty()


def test_parquet_is_conformed_too(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([("A", dt.datetime(2026, 1, 1), float("nan"), 3)], "ticker string, trading_date timestamp, close_price double, volume int").write.parquet(path)
    row = files.load_table(spark, path, PRICE, ("ticker",), "parquet").collect()[0]
    assert row["trading_date"] == dt.date(2026, 1, 1) and row["close_price"] is None and row["volume"] == 3


def test_files_by_tag_and_missing_tickers(spark, tmp_path):
    for name in ("AAPL_news_2025-01-01", "AAPL_news_2025-01-02", "TSLA_news_2025-01-01"):
        (tmp_path / f"{name}.csv").write_text(f"ticker,url,title\n,http://x/{name},t\n")
    rows, report = loading.articles_from_files(spark, str(tmp_path), "2025-01-01", ["aapl", "MSFT"])
    assert [(r["ticker"], r["tag"]) for r in rows.collect()] == [("AAPL", "2025-01-01")]
    assert {(r["ticker"], r["files"], r["status"]) for r in report.collect()} == {("AAPL", 1, "ok"), ("MSFT", 0, "missing")}
    everything, report = loading.articles_from_files(spark, str(tmp_path))
    assert everything.count() == 3 and {r["ticker"]: r["files"] for r in report.collect()} == {"AAPL": 2, "TSLA": 1}


def test_scans_push_filters_and_columns(spark, tmp_path):
    rows = spark.createDataFrame([("AAPL", dt.date(2026, 1, 1), 1.0, 2.0)], "ticker string, trading_date date, close_price double, other double")
    rows.write.parquet(str(tmp_path / "p"))
    out = scans.label_prices(spark.read.parquet(str(tmp_path / "p")), ["AAPL"], dt.date(2026, 1, 1), dt.date(2026, 1, 2))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(trading_dat" in plan.split("PushedFilters")[1]
    assert "other" not in plan.split("ReadSchema")[1]


def test_records(spark):
    raw = spark.createDataFrame([("AAPL", None, "bad", "x")], "ticker string, title string, published_at string, junk string")
    row = records.article_records(raw).collect()[0]
    assert row["title"] == "" and row["url"] == "" and row["source_id"] == "" and row["published_at"] is None
    assert list(row.asDict()) == ARTICLE.names
    plain = records.sentiment_records(spark.createDataFrame([("u", "")], "url string, sentiment_label string")).collect()[0]
    assert (plain["sentiment_label"], plain["sentiment_score"], plain["sentiment_confidence"]) == ("neutral", 0, 0.0)
