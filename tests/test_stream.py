import datetime as dt

from newstape.sources.keyed import KeyedTable, by_month
from newstape.streaming import intake

SCHEMA = "seq int, ticker string, url string, published_at timestamp, sentiment_label string, sentiment_score int"


def land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def row(seq, url, label, day=1, ticker="AAPL"):
    return (seq, ticker, url, dt.datetime(2026, 1, day, 12), label, {"positive": 1, "negative": -1}.get(label, 0))


def stream(spark, folder):
    return intake.file_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema)


def test_upserts_survive_a_restart_and_a_replay(spark, tmp_path):
    landing, root, state = (str(tmp_path / n) for n in ("landing", "table", "state"))
    table = KeyedTable(spark, root, spark.createDataFrame([], SCHEMA).drop("seq").schema, ["url"], by_month("published_at"), part_of_key=False)
    merge = intake.upsert_batches(table, ["url"], ["sentiment_label", "sentiment_score"], "seq")
    land(spark, landing, [row(1, "u1", "positive"), row(2, "u2", "neutral")])
    intake.run_available(stream(spark, landing), state, merge)
    land(spark, landing, [row(3, "u1", "negative", ticker="TSLA"), row(4, "u3", "neutral")])
    intake.run_available(stream(spark, landing), state, merge)
    intake.run_available(stream(spark, landing), str(tmp_path / "fresh-state"), merge)
    out = {r["url"]: r for r in table.read().collect()}
    assert set(out) == {"u1", "u2", "u3"}
    assert out["u1"]["sentiment_label"] == "negative" and out["u1"]["ticker"] == "AAPL"


def test_late_days_are_dropped_from_the_counts(spark, tmp_path):
    landing, root, state = (str(tmp_path / n) for n in ("landing", "table", "state"))
    land(spark, landing, [row(1, "a", "positive"), row(2, "b", "negative")])
    counts = intake.daily_label_counts(stream(spark, landing), "1 day")
    refresh = [c for c in counts.columns if c not in ("ticker", "date")]
    table = KeyedTable(spark, root, counts.schema, ["ticker", "date"], by_month("date"))
    merge = intake.upsert_batches(table, ["ticker", "date"], refresh)
    intake.run_available(counts, state, merge, "update")
    for rows in ([row(3, "c", "neutral", day=9)], [row(4, "d", "neutral", day=1), row(5, "e", "positive", day=9)]):
        land(spark, landing, rows)
        intake.run_available(intake.daily_label_counts(stream(spark, landing), "1 day"), state, merge, "update")
    out = {r["date"].day: r for r in table.read().collect()}
    assert out[1]["article_count"] == 2 and out[1]["daily_mean"] == 0.0
    assert out[9]["article_count"] == 2 and out[9]["positive_count"] == 1


def test_each_url_once(spark, tmp_path):
    landing, root, state = (str(tmp_path / n) for n in ("landing", "table", "state"))
    land(spark, landing, [row(1, "u", "positive"), row(2, "u", "positive"), row(3, "", "positive")])
    seen = []
    intake.run_available(
        intake.new_urls(stream(spark, landing)), state, lambda batch, _: seen.extend(r["url"] for r in batch.collect()))
    assert seen == ["u"] and root
