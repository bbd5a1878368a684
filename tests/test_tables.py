import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from helpers import one
from newstape.operators import lookups, records, reports, tagging, upsert
from newstape.plans import loading
from newstape.schemas import ARTICLE, PRICE, SENTIMENT_RESULT
from newstape.sources import sinks
from newstape.sources.keyed import KeyedTable, by_hash, by_month

T0, T1 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)
SCHEMA = "seq int, " + ", ".join(
    f"{f.name} {f.dataType.simpleString()}" for f in ARTICLE.fields
) + ", sentiment_label string, sentiment_score int, sentiment_confidence double, analysed_at timestamp"


def article(seq, url, title="t", ticker="AAPL", source="Reuters", label="positive", fetched=T0):
    return (seq, ticker, f"id{seq}", source, None, title, "d", url, T0, None, fetched, label, 1, 0.9, fetched)


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def stored(spark):
    return spark.createDataFrame([], ARTICLE)


def test_insert_update_skip(spark):
    first = upsert.upsert_articles(stored(spark), batch(spark, article(1, "u1"), article(2, "u2")), "seq")
    table = spark.createDataFrame(first.drop("_action", "_copies").collect(), ARTICLE)
    second = batch(spark, article(1, "u1", "new", "TSLA", "CNBC", fetched=T1), article(2, "u3"), article(3, ""))
    merged = upsert.upsert_articles(table, second, "seq")
    counts = one(upsert.accounting(merged, second.where(F.col("url") == "")))
    assert counts == {"inserted": 1, "updated": 1, "skipped": 1, "total": 2}
    row = merged.where("url = 'u1'").collect()[0]
    assert (row["title"], row["source_name"], row["fetched_at"]) == ("new", "CNBC", T1)
    assert (row["ticker"], row["source_id"]) == ("AAPL", "id1")
    assert merged.count() == 3


def test_copies_inside_a_batch(spark):
    rows = batch(spark, article(2, "u", "second", "TSLA"), article(1, "u", "first", "AAPL"), article(3, "u", None, "MSFT"))
    merged = upsert.upsert_articles(stored(spark), rows, "seq")
    row = one(merged)
    assert row["ticker"] == "AAPL" and row["title"] is None  # the last row wins even with NULL
    assert one(upsert.accounting(merged)) == {"inserted": 1, "updated": 2, "skipped": 0, "total": 3}


def test_a_repeated_key_needs_an_order(spark):
    twice = batch(spark, article(1, "u", "first"), article(2, "u", "second"))
    with pytest.raises(Exception, match="repeats a key"):
        upsert.upsert_articles(stored(spark), twice).collect()
    assert one(upsert.upsert_articles(stored(spark), twice, "seq"))["title"] == "second"


def test_a_null_url_is_skipped_and_counted(spark):
    rows = batch(spark, article(1, "u"), article(2, None), article(3, ""))
    merged = upsert.upsert_articles(stored(spark), rows, "seq")
    counts = one(upsert.accounting_by(rows, "ticker", F.col("url") != "", merged.where("_action = 'insert'")))
    assert (counts["inserted"], counts["updated"], counts["skipped"]) == (1, 0, 2)
    linked = upsert.attach_articles(rows, spark.createDataFrame([("u", "id")], "url string, article_id string"))
    assert sorted(str(r["article_id"]) for r in linked.collect()) == ["None", "None", "id"]


def keyed(spark, tmp_path, parts=8):
    schema = spark.createDataFrame([], "k string, n int").schema
    return KeyedTable(spark, str(tmp_path / "keyed"), schema, ["k"], by_hash(["k"], parts))


def put(table, rows):
    frame = table.spark.createDataFrame(rows, "k string, n int")
    return table.merge(frame, lambda old, new: upsert.upsert(old, new, ["k"], ["n"]))


def files_of(folder):
    return {str(p) for p in folder.rglob("*.parquet")}


def test_a_merge_rewrites_only_what_the_batch_touches(spark, tmp_path):
    table = keyed(spark, tmp_path)
    assert table.read().count() == 0
    put(table, [(f"k{i}", i) for i in range(50)])
    before = files_of(tmp_path / "keyed")
    part = lambda p: p.rsplit("_part=")[1].split("/")[0]
    assert len({part(p) for p in before}) == 8
    out = put(table, [("k7", 700)])
    after = files_of(tmp_path / "keyed")
    assert len({part(p) for p in after - before}) == 1 and {part(p) for p in before - after} == {part(p) for p in after - before}
    assert out.where("_action = 'update'").count() == 1 and out.count() < 50
    rows = {r["k"]: r["n"] for r in table.read().collect()}
    assert rows == {f"k{i}": 700 if i == 7 else i for i in range(50)}


def test_a_failed_merge_changes_nothing(spark, tmp_path):
    table = keyed(spark, tmp_path)
    put(table, [("a", 1), ("b", 2)])
    before = files_of(tmp_path / "keyed")

    def broken(old, new):
        late = F.when(F.col("k") == "a", F.raise_error(F.lit("lost"))).otherwise(F.col("n"))
        return upsert.upsert(old, new, ["k"], ["n"]).withColumn("n", late.cast("int"))

    with pytest.raises(Exception, match="lost"):
        table.merge(spark.createDataFrame([("a", 3)], "k string, n int"), broken)
    assert files_of(tmp_path / "keyed") == before and table.read().count() == 2


def test_a_merge_killed_while_partitions_switch_is_run_again(spark, tmp_path):
    first, second = [(f"k{i}", i) for i in range(20)], [(f"k{i}", 100 + i) for i in range(10, 30)]
    table = keyed(spark, tmp_path, 4)
    put(table, first)
    shutil.copytree(tmp_path / "keyed", tmp_path / "old")
    put(table, second)
    whole = {tuple(r) for r in table.read().collect()}
    shutil.rmtree(tmp_path / "keyed" / "_part=1")  # as if only the other partitions had been switched
    shutil.copytree(tmp_path / "old" / "_part=1", tmp_path / "keyed" / "_part=1")
    assert {tuple(r) for r in keyed(spark, tmp_path, 4).read().collect()} != whole
    put(keyed(spark, tmp_path, 4), second)
    assert {tuple(r) for r in keyed(spark, tmp_path, 4).read().collect()} == whole and len(whole) == 30


def test_a_stored_row_stays_in_its_month(spark, tmp_path):
    schema = spark.createDataFrame([], "k string, day date, n int").schema
    table = KeyedTable(spark, str(tmp_path / "keyed"), schema, ["k"], by_month("day"), part_of_key=False)
    merge = lambda rows: table.merge(spark.createDataFrame(rows, schema), lambda old, new: upsert.upsert(old, new, ["k"], ["n"]))
    merge([("a", dt.date(2026, 1, 1), 1), ("b", dt.date(2026, 2, 1), 2), ("c", dt.date(2026, 3, 1), 3), ("d", None, 4)])
    before = files_of(tmp_path / "keyed")
    merge([("a", dt.date(2026, 2, 9), 10), ("e", dt.date(2026, 2, 2), 5), ("d", dt.date(2026, 2, 2), 40)])
    rows = {tuple(r) for r in table.read().collect()}
    assert rows == {("a", dt.date(2026, 1, 1), 10), ("b", dt.date(2026, 2, 1), 2), ("c", dt.date(2026, 3, 1), 3), ("d", None, 40), ("e", dt.date(2026, 2, 2), 5)}
    assert {p for p in before if "2026-03" in p} <= files_of(tmp_path / "keyed")


def test_tasks_of_a_shuffle_by_key_meet_few_hash_partitions(spark):
    dealt = spark.range(5000).select(F.col("id").cast("string").alias("k")).repartition(16, "k")
    met = dealt.groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct(by_hash(["k"], 8)).alias("parts"))
    assert {r["parts"] for r in met.collect()} == {1}


def test_a_new_table_is_written_without_landing_its_batch(spark, tmp_path, monkeypatch):
    from newstape.sources import keyed as module

    landed = []
    fresh = module.fresh_path
    monkeypatch.setattr(module, "fresh_path", lambda session, name: landed.append(name) or fresh(session, name))
    table = KeyedTable(spark, str(tmp_path / "keyed"), spark.createDataFrame([], "k string, n int").schema, ["k"],
                       by_hash(["k"], 8), rebalance=False)
    assert put(table, [(f"k{i}", i) for i in range(50)]).where("_action = 'insert'").count() == 50 and not landed
    assert {p.rsplit(".", 2)[1] for p in files_of(tmp_path / "keyed")} == {"zstd"}
    put(table, [("k7", 700), ("k99", 99)])
    assert landed == ["incoming"]
    assert {r["k"]: r["n"] for r in table.read().collect()} == {**{f"k{i}": i for i in range(50)}, "k7": 700, "k99": 99}


def test_keys_are_looked_up_only_in_months_the_batch_does_not_touch(spark, tmp_path):
    schema = spark.createDataFrame([], "k string, day date, n int").schema
    table = KeyedTable(spark, str(tmp_path / "keyed"), schema, ["k"], by_month("day"), part_of_key=False)
    frame = lambda *rows: spark.createDataFrame(list(rows), schema)
    merge = lambda *rows: table.merge(frame(*rows), lambda old, new: upsert.upsert(old, new, ["k"], ["n"]))
    merge(("a", dt.date(2026, 1, 1), 1), ("b", dt.date(2026, 2, 1), 2), ("c", dt.date(2026, 3, 1), 3))
    both = frame(("a", dt.date(2026, 2, 1), 5), ("d", dt.date(2026, 3, 1), 4)).withColumn("_part", by_month("day"))
    assert sorted(table._touched(both)) == ["2026-01", "2026-02", "2026-03"]
    assert sorted(table._touched(both.where("k = 'd'"))) == ["2026-03"]
    assert merge(("a", dt.date(2026, 2, 1), 5)).where("_action = 'update'").count() == 1
    assert {tuple(r) for r in table.read().collect()} == {
        ("a", dt.date(2026, 1, 1), 5), ("b", dt.date(2026, 2, 1), 2), ("c", dt.date(2026, 3, 1), 3)}


def test_derived_columns_are_computed_as_files_are_written(spark, tmp_path):
    schema = spark.createDataFrame([], "k string, n int, twice int").schema
    table = KeyedTable(spark, str(tmp_path / "keyed"), schema, ["k"], by_hash(["k"], 2), derived={"twice": F.col("n") * 2})
    seen = []

    def merge(old, new):
        seen.append("twice" in old.columns)
        return upsert.upsert(old, new, ["k"], ["n"])

    for rows in ([("a", 1), ("b", 2)], [("a", 5)]):
        table.merge(spark.createDataFrame(rows, "k string, n int"), merge)
    assert seen == [False, False] and {tuple(r) for r in table.read().collect()} == {("a", 5, 10), ("b", 2, 4)}


def test_a_unique_batch_is_not_folded_and_the_last_row_is_told(spark):
    old = spark.createDataFrame([("a", "x", 1)], "k string, s string, n int")
    new = spark.createDataFrame([("a", "y", 2, "p", 1), ("a", "z", 3, "q", 2), ("b", "w", 4, "r", 3)], "k string, s string, n int, t string, seq int")
    out = upsert.upsert(old, new, ["k"], ["n"], "seq", carry=["t"], latest=["t", "s"])
    assert {tuple(r) for r in out.collect()} == {
        ("a", "x", 3, "update", 2, "p", "q", "z"), ("b", "w", 4, "insert", 1, "r", "r", "w")}
    one_each = upsert.upsert(old, new.where("t <> 'p'"), ["k"], ["n"], carry=["t"], unique=True)
    assert {tuple(r) for r in one_each.collect()} == {("a", "x", 3, "update", 1, "q"), ("b", "w", 4, "insert", 1, "r")}
    assert "Aggregate" not in one_each._jdf.queryExecution().executedPlan().toString()


def test_results_follow_the_articles_of_a_second_load(spark, tmp_path):
    loading.load_articles(spark, batch(spark, article(1, "u1"), article(2, "u2", ticker="TSLA")), str(tmp_path), "a")
    rows = batch(spark, article(3, "u1", ticker="MSFT", label="negative"), article(4, "u1", ticker="AMZN", label="neutral"), article(5, "u3"))
    for model, inserted in (("b", {"MSFT": 1, "AAPL": 1}), ("a", {"AAPL": 1})):
        out = loading.load_articles(spark, rows, str(tmp_path), model)
        summary = {r["ticker"]: r["sentiment_inserted"] for r in out.summary.where("is_total = 0").collect()}
        assert {k: v for k, v in summary.items() if v} == inserted
    ids = {r["article_id"]: r["url"] for r in out.articles.collect()}
    assert {(ids[r["article_id"]], r["model_name"], r["sentiment_label"]) for r in out.sentiments.collect()} == {
        ("u1", "a", "neutral"), ("u2", "a", "positive"), ("u3", "a", "positive"), ("u1", "b", "neutral"), ("u3", "b", "positive")}
    assert {r["url"]: r["ticker"] for r in out.articles.collect()} == {"u1": "AAPL", "u2": "TSLA", "u3": "AAPL"}


def test_a_load_reduces_the_copies_of_a_url_once(spark, tmp_path, monkeypatch):
    folds = []
    fold = upsert._folded
    monkeypatch.setattr(upsert, "_folded", lambda rows, keys, fixed, refresh, seq, unique: folds.append(unique) or fold(rows, keys, fixed, refresh, seq, unique))
    loading.load_articles(spark, batch(spark, article(1, "u"), article(2, "u")), str(tmp_path), "m")
    assert folds == [False, True]


def test_rows_laid_by_partition_are_merged_with_one_shuffle(spark):
    old = spark.createDataFrame([("p", "a", "x", 1), ("p", "b", "y", 2), ("q", "c", None, 3)], "_part string, k string, s string, n int")
    new = spark.createDataFrame([("p", "a", "z", 5, "t"), ("q", "d", None, 6, "u"), ("q", "c", "w", None, "v")],
                                "_part string, k string, s string, n int, t string")
    out = upsert.upsert_within(old, new, ["k"], ["n"], ("_part",), carry=["t"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
    want = upsert.upsert(old, new, ["k"], ["n"], carry=["t"], unique=True).select(*out.columns)
    assert {tuple(r) for r in out.collect()} == {tuple(r) for r in want.collect()} == {
        ("p", "a", "x", 5, "update", 1, "t"), ("p", "b", "y", 2, "keep", 0, None),
        ("q", "c", None, None, "update", 1, "v"), ("q", "d", None, 6, "insert", 1, "u")}


def test_results_are_merged_inside_their_months(spark, tmp_path, monkeypatch):
    from newstape.sources import keyed as module

    monkeypatch.setattr(module, "TOGETHER", 3)
    shuffled = []
    within = upsert.upsert_within
    monkeypatch.setattr(upsert, "upsert_within", lambda *a, **b: shuffled.append(within(*a, **b)) or shuffled[-1])
    day = lambda i: f"2026-0{1 + i % 3}-05"
    rows = lambda *ids: batch(spark, *[article(i, f"u{i}") for i in ids]).withColumn(
        "published_at", F.element_at(F.array(*[F.lit(day(i)).cast("timestamp") for i in range(3)]), (F.col("seq") % 3 + 1).cast("int")))
    loading.load_articles(spark, rows(*range(30)), str(tmp_path), "m")
    assert not shuffled
    again = rows(*range(20, 50)).withColumn("sentiment_label", F.lit("negative"))
    out = loading.load_articles(spark, again, str(tmp_path), "m")
    assert len(shuffled) == 1
    labels = {r["article_id"]: r["sentiment_label"] for r in out.sentiments.collect()}
    urls = {r["url"]: labels[r["article_id"]] for r in out.articles.collect()}
    assert urls == {f"u{i}": "positive" if i < 20 else "negative" for i in range(50)} and out.sentiments.count() == 50
    total = one(out.summary.where("is_total = 1"))
    assert (total["sentiment_inserted"], total["sentiment_updated"]) == (20, 10)
    months = {p.name for p in (tmp_path / "sentiments").iterdir() if p.is_dir()}
    assert months == {p.name for p in (tmp_path / "articles").iterdir() if p.is_dir()} and len(months) == 3


def test_a_load_drops_the_shuffle_files_of_each_step(spark, tmp_path, monkeypatch):
    """When a step is done, what it shuffled is not kept for the steps after it."""
    steps = []
    monkeypatch.setattr(loading, "tidy", lambda session: steps.append(session))
    loading.load_articles(spark, batch(spark, article(1, "u")), str(tmp_path), "m")
    assert steps == [spark] * 3


def test_small_reads_bound_what_a_task_reads(spark, tmp_path):
    from newstape.session import small_reads

    spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("x")).coalesce(1).write.option("parquet.block.size", 1 << 20).parquet(str(tmp_path / "t"))
    key = "spark.sql.files.maxPartitionBytes"
    before, tasks = spark.conf.get(key), lambda: spark.read.parquet(str(tmp_path / "t")).rdd.getNumPartitions()
    with small_reads(spark, 1 << 20):
        assert tasks() > 8
        with small_reads(spark, 1 << 30):
            assert spark.conf.get(key) == str(1 << 20)
    assert spark.conf.get(key) == before


def test_the_scorer_sees_each_text_once(spark, tmp_path):
    from newstape.operators import sentiment

    seen = str(tmp_path / "seen")

    def load():
        def score(texts):
            with open(seen, "a") as log:
                log.write("x" * len(texts))
            return [("positive", 0.5)] * len(texts)

        return score

    rows = batch(spark, *[article(i, f"u{i}") for i in range(20)]).drop(
        "sentiment_label", "sentiment_score", "sentiment_confidence", "analysed_at")
    result = loading.load_articles(spark, sentiment.with_sentiment(rows, sentiment.batched(load)), str(tmp_path), "m")
    assert result.sentiments.count() == 20 and len(open(seen).read()) == 20


def test_two_models_keep_two_results(spark):
    articles = records.with_article_id(records.article_records(batch(spark, article(1, "u"))))
    rows = batch(spark, article(1, "u"), article(2, "unknown")).select(
        "url", "sentiment_label", "sentiment_score", "sentiment_confidence", "analysed_at", "seq")
    empty = spark.createDataFrame([], SENTIMENT_RESULT)
    first = upsert.upsert_sentiments(empty, rows, articles, "a", "seq").drop("_action", "_copies")
    both = upsert.upsert_sentiments(first, rows, articles, "b", "seq")
    assert sorted((r["model_name"], r["_action"]) for r in both.collect()) == [("a", "keep"), ("b", "insert")]


def test_prices_refresh_every_value(spark):
    old = spark.createDataFrame([("AAPL", dt.date(2026, 1, 1), 1.0, 1.0, 1.0, 1.0, 1.0, 1)], PRICE)
    new = spark.createDataFrame([("AAPL", dt.date(2026, 1, 1), 2.0, None, 2.0, 2.0, 2.0, 2)], PRICE)
    row = one(upsert.upsert_prices(old, new))
    assert row["close_price"] == 2.0 and row["high_price"] is None and row["volume"] == 2


def test_keep_first_treats_missing_keys_as_one(spark):
    rows = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), (None, 3, "p"), (None, 4, "q")], "url string, seq int, v string")
    assert {(r["url"], r["v"]) for r in upsert.keep_first(rows, ["url"], "seq").collect()} == {("a", "x"), (None, "p")}


def test_keep_first_of_rows_that_came_twice(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, "z")], "url string, seq int, v string")
    out = upsert.keep_first(rows.unionByName(rows), ["url"], "seq")
    assert sorted(map(tuple, out.collect())) == [("a", 1, "x"), ("b", 3, "z")]


def test_keep_first_shuffles_each_row_once(spark):
    rows = spark.range(1000).select((F.col("id") % 500).alias("url"), F.struct("id").alias("seq"), F.lit("v").alias("v"))
    plan = upsert.keep_first(rows, ["url"], "seq").drop("seq")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1 and "partial_min(" not in plan


def test_hot_key_reduces_before_the_shuffle(spark):
    rows = spark.range(1000).select(F.lit("u").alias("url"), F.col("id").alias("seq"), F.lit("v").alias("v"))
    plan = upsert.keep_first(rows, ["url"], "seq")._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def unscored_fixture(spark):
    articles = spark.createDataFrame([(i,) for i in "abcd"], "article_id string")
    results = spark.createDataFrame(
        [("a", "m"), ("b", "m"), ("b", "other"), ("c", "other")], "article_id string, model_name string")
    return articles, results


@pytest.mark.parametrize("options,want", [
    ({}, "d"), ({"model_name": "m"}, "bcd"), ({"model_name": "m", "strict": True}, "cd"),
])
def test_articles_without_sentiment(spark, options, want):
    out = lookups.without_sentiment(*unscored_fixture(spark), **options)
    assert "".join(sorted(r[0] for r in out.collect())) == want


def test_latest_price(spark):
    rows = spark.createDataFrame([("AAPL", dt.date(2026, 1, d), 0.0, 0.0, 0.0, float(d), 0.0, d) for d in (1, 3, 2)], PRICE)
    assert one(lookups.latest_prices(rows))["close_price"] == 3.0
    assert one(lookups.latest_price(rows, "aapl"))["volume"] == 3
    assert lookups.latest_price(rows, "TSLA").isEmpty()


def test_unknown_labels_are_neutral(spark):
    rows = spark.createDataFrame([("POSITIVE",), ("bullish",), (None,)], "sentiment_label string")
    assert [(r[0], r[1]) for r in lookups.with_score(rows).collect()] == [("positive", 1), ("neutral", 0), ("neutral", 0)]


def test_load_job_is_repeatable(spark, tmp_path):
    rows = batch(spark, article(1, "u1"), article(2, "u2", ticker="TSLA"), article(3, ""))
    first = loading.load_articles(spark, rows, str(tmp_path), "m")
    total = one(first.summary.where("is_total = 1"))
    assert (total["articles_inserted"], total["articles_updated"], total["articles_skipped"]) == (2, 0, 1)
    assert total["sentiment_inserted"] == 2 and total["tickers"] == 2
    again = loading.load_articles(spark, rows, str(tmp_path), "m")
    total = one(again.summary.where("is_total = 1"))
    assert (total["articles_inserted"], total["articles_updated"], total["sentiment_updated"]) == (0, 2, 2)
    assert again.articles.count() == 2 and again.sentiments.count() == 2
    assert reports.sentiment_distribution(again.articles, again.sentiments).collect()[0]["count"] == 2


def test_price_job(spark, tmp_path):
    rows = spark.createDataFrame([("AAPL", dt.date(2026, 1, d), 0.0, 0.0, 0.0, 1.0, 0.0, d) for d in (1, 2)], PRICE)
    table, summary = loading.load_prices(spark, rows, str(tmp_path))
    assert table.count() == 2 and one(summary)["date_max"] == dt.date(2026, 1, 2)
    from newstape.errors import LoadError

    with pytest.raises(LoadError):
        loading.load_prices(spark, rows.limit(0), str(tmp_path))
    twice = rows.withColumn("seq", F.lit(1)).unionByName(rows.withColumn("seq", F.lit(2)).withColumn("close_price", F.lit(9.0)))
    table, _ = loading.load_prices(spark, twice, str(tmp_path), "seq")
    assert {r["close_price"] for r in table.collect()} == {9.0}
    with pytest.raises(Exception, match="repeats a key"):
        loading.load_prices(spark, twice.drop("seq"), str(tmp_path))


def test_requested_tickers_without_rows(spark):
    rows = batch(spark, article(1, "u"))
    asked = spark.createDataFrame([("AAPL",), ("NONE",)], "ticker string")
    out = {r["ticker"]: r for r in reports.ingestion_summary(rows, asked).collect()}
    assert (out["NONE"]["article_count"], out["NONE"]["status"], out["NONE"]["latest"]) == (0, "empty", None)
    assert out["AAPL"]["status"] == "ok"
    scored = {r["ticker"]: r for r in reports.sentiment_summary(rows, asked).collect()}
    assert scored["NONE"]["mean_score"] is None and scored["AAPL"]["mean_score"] == 1.0
    assert sinks.range_tag(dt.date(2026, 1, 1), dt.date(2026, 1, 2)) == "2026-01-01_2026-01-02"


def test_pairs_of_unique_articles_are_not_shuffled(spark):
    """What the automaton finds in articles of different keys needs no second look."""
    articles = spark.createDataFrame([(1, "Blue ring, blue ring"), (2, None), (3, "hot blue ring")], "k long, title string")
    phrases = spark.createDataFrame([("A", "blue ring"), ("A", "hot"), ("B", "ring")], "ticker string, phrase string")
    found = tagging.tag(articles, phrases, "k", unique=True)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, found.collect())) == [(1, "A"), (1, "B"), (3, "A"), (3, "B")]


def test_texts_are_cut_into_words_once(spark):
    articles = spark.createDataFrame([(1, "blue ring"), (2, "  "), (3, None)], "k long, title string")
    phrases = spark.createDataFrame([("A", "ring"), ("B", " - ")], "ticker string, phrase string")
    for limit in (1 << 20, 0):
        found = tagging.tag(articles, phrases, "k", limit=limit)
        assert found._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1
        assert [tuple(r) for r in found.collect()] == [(1, "A")]
