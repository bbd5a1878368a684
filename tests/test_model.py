import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import one
from newstape.errors import DataPreparationError, ModelNotFoundError
from newstape.operators import metrics, model as M, reports, sentiment, split
from newstape.plans import training
from newstape.schemas import DIRECTIONS

SHORT = {"trees": 5, "depth": 3}


def dataset(spark, rows=240):
    """One feature decides the direction, one is noise, one is often missing."""
    base = spark.range(rows).select(
        F.concat(F.lit("T"), F.col("id") % 4).alias("ticker"), F.date_add(F.lit(dt.date(2026, 1, 1)), (F.col("id") / 4).cast("int")).alias("date"),
        (F.col("id") % 3).cast("double").alias("signal"), F.rand(1).alias("noise"),
        F.when(F.col("id") % 2 == 0, F.lit(float("nan"))).otherwise(1.0).alias("gappy"),
        F.lit(1.0).alias("price_chg_1d"), F.lit(0.1).alias("return_5d"), F.lit(2.0).alias("future_close_1d"), F.lit(1).alias("label_up_1d"),
    )
    way = F.when(F.col("signal") == 0, "BUY").when(F.col("signal") == 1, "HOLD").otherwise("SELL")
    return base.withColumn("label_direction", way)


def test_feature_detection(spark):
    assert M.feature_columns(dataset(spark)) == ["signal", "noise", "gappy", "price_chg_1d"]
    with pytest.raises(DataPreparationError):
        M.feature_columns(dataset(spark).select("ticker", "date", "return_5d"))


def test_alignment(spark):
    out = M.aligned(dataset(spark), ["noise", "signal"])
    assert out.dtypes == [("noise", "double"), ("signal", "double")]
    with pytest.raises(DataPreparationError, match="absent"):
        M.aligned(dataset(spark), ["absent"])


@pytest.mark.parametrize("counts", [{"BUY": 200, "HOLD": 73, "SELL": 200}, {"BUY": 10, "SELL": 3}, {"HOLD": 1}])
def test_stratified_sizes(spark, counts):
    rows = [(k, f"{k}{i}", dt.date(2026, 1, 1)) for k, n in counts.items() for i in range(n)]
    df = spark.createDataFrame(rows, "label_direction string, ticker string, date date")
    out = split.stratified_split(df)
    assert out.count() == len(rows)
    total = sum(counts.values())
    test = {r[0]: r[1] for r in out.where("is_test").groupBy("label_direction").count().collect()}
    assert sum(test.values()) == -(-total // 5)
    assert all(abs(test.get(k, 0) - n * sum(test.values()) / total) < 1 for k, n in counts.items())
    again = split.stratified_split(df.repartition(3))
    assert out.exceptAll(again).isEmpty()


def test_published_split_size(spark):
    rows = spark.range(473).select(F.element_at(F.array(*map(F.lit, DIRECTIONS)), (F.col("id") % 3 + 1).cast("int")).alias("label_direction"),
                                   F.col("id").cast("string").alias("ticker"), F.lit(dt.date(2026, 1, 1)).alias("date"))
    assert split.stratified_split(rows).where("is_test").count() == 95


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_train_predict_save_load(spark, tmp_path, kind):
    rows = dataset(spark)
    fitted = M.train(rows, kind=kind, params=SHORT)
    out = fitted.predict(rows.drop("label_direction").withColumn("extra", F.lit("kept")))
    probs = [f"prob_{c}" for c in DIRECTIONS]
    assert out.columns[-5:] == ["extra", "predicted_direction", *probs]
    sums = out.select(F.round(sum((F.col(p) for p in probs), F.lit(0.0)), 9).alias("s")).distinct().collect()
    assert [r["s"] for r in sums] == [1.0]
    scored = fitted.predict(rows)
    assert scored.where("predicted_direction = label_direction").count() > 200
    top = fitted.importances(spark).orderBy("rank").collect()
    assert top[0]["feature"] == "signal" and len(top) == 4
    assert sum(r["importance"] for r in top) == pytest.approx(1.0)
    fitted.save(spark, str(tmp_path / "m"))
    loaded = M.load_model(spark, str(tmp_path / "m"))
    assert loaded.features == fitted.features
    assert loaded.predict(rows).select("predicted_direction").exceptAll(scored.select("predicted_direction")).isEmpty()


def test_boosting_keeps_all_trees_unless_asked_to_stop(spark):
    rows = dataset(spark).withColumn("signal", F.rand(7)).withColumn("noise", F.rand(8))  # trees that hardly help
    params = {"trees": 40, "depth": 2, "learning_rate": 0.3}
    assert M.train(rows, kind="boosted", params=params).stages[0].rounds == 40
    fitted = M.train(rows, kind="boosted", params=params | {"validation_share": 0.3})
    assert 0 < fitted.stages[0].rounds < 40


def test_missing_model(spark, tmp_path):
    with pytest.raises(ModelNotFoundError):
        M.load_model(spark, str(tmp_path / "nothing"))


def test_training_job(spark, tmp_path):
    result = training.train_and_evaluate(spark, dataset(spark), str(tmp_path), params=SHORT)
    assert result.model.metadata["train_rows"] == 192 and result.model.metadata["test_rows"] == 48
    accuracy = one(result.metrics.where("metric = 'accuracy'"))["value"]
    assert accuracy > 0.9
    written, summary = training.predict_job(spark, f"{tmp_path}/model", dataset(spark), str(tmp_path / "p"))
    assert written.count() == 240 and {r["direction"] for r in summary.collect()} == set(DIRECTIONS)
    with pytest.raises(DataPreparationError):
        training.train_and_evaluate(spark, dataset(spark).withColumn("label_direction", F.lit(None).cast("string")))
    timed = training.train_and_evaluate(
        spark, dataset(spark), params=SHORT, split="time", first_test_day=dt.date(2026, 2, 1))
    assert timed.predictions.agg(F.min("date")).first()[0] == dt.date(2026, 2, 1)


MIXED = [("BUY", "BUY"), ("BUY", "HOLD"), ("HOLD", "HOLD"), ("HOLD", "BUY"), ("SELL", "SELL"), ("SELL", "BUY")]


def pairs(spark, rows):
    return spark.createDataFrame(rows, "label_direction string, predicted_direction string")


def test_confusion_and_metrics(spark):
    confusion = metrics.confusion_matrix(pairs(spark, MIXED))
    cells = {(r["actual"], r["predicted"]): r["n"] for r in confusion.collect()}
    assert len(cells) == 9 and cells["BUY", "HOLD"] == 1 and cells["SELL", "BUY"] == 1 and cells["SELL", "HOLD"] == 0
    per = {r["class"]: r for r in metrics.class_metrics(confusion).collect()}
    assert per["BUY"]["precision"] == pytest.approx(1 / 3) and per["SELL"]["precision"] == 1.0
    overall = one(metrics.overall_metrics(confusion))
    assert overall["accuracy"] == 0.5 and overall["macro_recall"] == 0.5


def test_absent_class_has_zero_metrics_under_its_own_name(spark):
    confusion = metrics.confusion_matrix(pairs(spark, [("BUY", "BUY"), ("SELL", "BUY")]))
    per = {r["class"]: r for r in metrics.class_metrics(confusion).collect()}
    assert per["HOLD"]["f1"] == 0.0 and per["HOLD"]["support"] == 0 and per["SELL"]["recall"] == 0.0
    assert per["BUY"]["precision"] == 0.5
    assert one(metrics.overall_metrics(confusion))["macro_precision"] == 0.25


def test_prediction_summary_of_nothing(spark):
    out = {r["direction"]: (r["predictions"], r["percent"]) for r in reports.prediction_summary(pairs(spark, MIXED).limit(0)).collect()}
    assert out == {c: (0, 0.0) for c in DIRECTIONS}


def scored(spark, rows, **options):
    df = spark.createDataFrame(rows, "title string, description string")
    return sentiment.with_sentiment(df, **options).collect()


def test_blank_texts_do_not_reach_the_scorer(spark):
    def load():
        def score(texts):
            assert all(t and t.strip() for t in texts)
            return [("POSITIVE", 0.123456789) if "up" in t else ("bullish", 0.5) for t in texts]
        return score

    rows = scored(spark, [("up", "x"), (" ", None), (None, "sideways")], scorer=sentiment.batched(load, batch=2))
    assert [(r["sentiment_label"], r["sentiment_score"], r["sentiment_confidence"]) for r in rows] == [
        ("positive", 1, 0.123457), ("neutral", 0, 0.0), ("neutral", 0, 0.5)]
    assert len({r["analysed_at"] for r in rows}) == 1


def test_word_scorer(spark):
    rows = scored(spark, [("Record profit", "but one loss"), ("weak", None), ("plain", None)])
    assert [(r["sentiment_label"], r["sentiment_confidence"]) for r in rows] == [
        ("positive", 0.333333), ("negative", 1.0), ("neutral", 0.0)]


def test_empty_articles_keep_the_schema(spark):
    df = spark.createDataFrame([], "title string, description string")
    out = sentiment.with_sentiment(df)
    assert out.isEmpty() and out.columns[-4:] == ["sentiment_label", "sentiment_score", "sentiment_confidence", "analysed_at"]


def test_a_learnt_scorer(spark, tmp_path):
    from newstape.operators import learned

    texts = [(f"the {good} quarter number {k}", "POSITIVE") for k in range(40) for good in ("record", "strong")]
    texts += [(f"a weak outlook and loss {k}", "negative") for k in range(60)] + [(f"shares of company {k}", "neutral") for k in range(60)]
    rows = spark.createDataFrame([*texts, ("no label", None), ("odd label", "great"), (None, "neutral")], "title string, known string")
    scorer = learned.train_scorer(rows, "title", "known")
    fresh = spark.createDataFrame([("the record quarter", None), ("a weak outlook", "loss"), (None, " "), ("word " * 600 + "record", None)],
                                  "title string, description string")
    out = sentiment.with_sentiment(fresh, scorer).collect()
    assert [r["sentiment_label"] for r in out[:3]] == ["positive", "negative", "neutral"] and out[2]["sentiment_confidence"] == 0.0
    cut = sentiment.with_sentiment(spark.createDataFrame([("word " * 512, None), ("word " * 511 + "word record record", None)], fresh.schema), scorer).collect()
    assert cut[0]["sentiment_confidence"] == cut[1]["sentiment_confidence"]  # beyond 512 words nothing counts
    scorer.save(str(tmp_path / "s"))
    again = sentiment.with_sentiment(fresh, learned.LearnedScorer.load(str(tmp_path / "s"))).collect()
    keep = lambda rows: [(r["sentiment_label"], r["sentiment_confidence"]) for r in rows]
    assert keep(again) == keep(out)
    with pytest.raises(DataPreparationError):
        learned.train_scorer(rows.where("known = 'great'"), "title", "known")


def test_labels_of_a_learned_scorer_are_computed_once(spark):
    """The learner goes over its rows more than once, what they are made of does not run again."""
    from pyspark.sql import functions as F
    from newstape.operators import learned

    seen = spark.sparkContext.accumulator(0)

    def label(text):
        seen.add(1)
        return "positive" if "up" in text else "negative"

    rows = spark.createDataFrame([(f"{'up' if k % 2 else 'down'} word{k}",) for k in range(40)], "title string").repartition(2)
    made = rows.withColumn("known", F.udf(label, "string")("title"))
    scorer = learned.train_scorer(made, "title", "known", iterations=3)
    assert seen.value <= 80  # the label stands in the filter and in the row
    out = scorer.attach(rows, "title", "out").select("title", "out.label").collect()
    assert all((r.label == "positive") == r.title.startswith("up") for r in out)


def test_a_label_is_computed_once_a_row(spark):
    """No filter asks for the scorer of the labels again: its two counts of words stand in the plan once each."""
    from newstape.operators import learned, sentiment

    rows = spark.createDataFrame([("a strong rise",), ("weak",), (None,)], "title string")
    scored = sentiment.with_sentiment(rows, sentiment.word_scorer()).withColumnRenamed("sentiment_label", "known")
    ready = learned._labelled(scored, "title", "known")
    plan = ready._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") + plan.count("regexp_count") == 2
    assert sorted(r["_label"] for r in ready.collect()) == [0.0, 1.0, 2.0]


def test_a_scorer_is_learnt_in_small_pieces(spark, monkeypatch):
    """Pieces and blocks that the learner keeps are of bounded size, and the session's settings come back."""
    from newstape.operators import learned

    seen, keys = [], ("spark.sql.files.maxPartitionBytes", "spark.sql.parquet.columnarReaderBatchSize")
    before = [spark.conf.get(k) for k in keys]

    class Learner(learned.LogisticRegression):
        def fit(self, rows):
            seen.append([int(spark.conf.get(k)) for k in keys] + [self.getMaxBlockSizeInMB()])
            return super().fit(rows)

    monkeypatch.setattr(learned, "LogisticRegression", Learner)
    rows = spark.createDataFrame([(w, k) for w, k in (("up", "positive"), ("down", "negative"), ("shares", "neutral"))] * 5, "title string, known string")
    learned.train_scorer(rows, "title", "known", iterations=2)
    (pieces, batch, block), = seen
    assert pieces <= 16 << 20 and batch <= 512 and block <= 1
    assert [spark.conf.get(k) for k in keys] == before
