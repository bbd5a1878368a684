"""Registered queries: scoring, encoding, split, training, metrics, model jobs, streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from newstape.checks import sql as S
from newstape.checks.daily_queries import dated, with_day
from newstape.checks.table_queries import (
    DATASET_CTES, DATASET_FROM, STAMP, VERSIONS_SQL, WS, _batch_prices, _dataset, _incoming_lines, as_text,
)
from newstape.checks.views import MODEL, line_articles, line_prices, table
from newstape.functions.numeric import half_even
from newstape.operators import daily, indicators, labels, learned, metrics, model as M, reports, sentiment, split
from newstape.plans import loading, training
from newstape.schemas import DAILY_FEATURES, DIRECTIONS, SENTIMENT_SCORES, TECHNICAL_FEATURES
from newstape.session import fresh_path, tune
from newstape.sources import sinks
from newstape.sources.keyed import KeyedTable, by_hash, by_month
from newstape.streaming import intake

#: words that occur in the sample texts
GOOD, BAD = ["the", "on", "is", "le", "la"], ["of", "and", "in", "un", "elle"]

# --- scoring ---------------------------------------------------------------------


def _texts(spark, sf_dir) -> DataFrame:
    """Documents as articles, some titles blank, and for every tenth document one more article without a text."""
    docs = table(spark, sf_dir, "documents")
    title = F.when(F.col("lang") == "en", "The news").otherwise("  ").alias("title")
    whole = docs.select("doc_id", title, F.col("text").alias("description"))
    blank = docs.where(F.col("doc_id") % 10 == 0).select((-F.col("doc_id") - 1).alias("doc_id"), title, F.lit(None).cast("string").alias("description"))
    return whole.unionByName(blank)


def _scored(df: DataFrame) -> DataFrame:
    out = df.select("doc_id", "sentiment_label", F.col("sentiment_score").cast("long").alias("sentiment_score"),
                    "sentiment_confidence", "analysed_at")
    return as_text(out, "analysed_at")


def m1(spark, sf_dir):
    return _scored(sentiment.with_sentiment(_texts(spark, sf_dir), sentiment.word_scorer(GOOD, BAD), STAMP))


def m1_learned(spark, sf_dir):
    """A scorer learnt from four fifths of the scored texts agrees with the others more often than their commonest label."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("title"))
    landed = sentiment.with_sentiment(docs, sentiment.word_scorer(GOOD, BAD), STAMP)
    landed = landed.withColumnRenamed("sentiment_label", "known")
    held = F.col("doc_id") % 5 == 0
    scorer = learned.train_scorer(landed.where(~held), "title", "known")
    scored = sentiment.with_sentiment(landed.where(held), scorer, STAMP)
    right = F.count_if(F.col("sentiment_label") == F.col("known"))
    most = F.greatest(*[F.count_if(F.col("known") == k) for k in SENTIMENT_SCORES])
    odd = F.count_if(~F.col("sentiment_confidence").between(0, 1) | ~F.col("sentiment_label").isin(list(SENTIMENT_SCORES)))
    return scored.agg(F.count(F.lit(1)).alias("held_out"), (right > most).cast("long").alias("better"), odd.alias("odd"))


M1_LEARNED_SQL = """SELECT count(*) AS held_out, CAST(1 AS BIGINT) AS better, CAST(0 AS BIGINT) AS odd
    FROM documents WHERE doc_id % 5 = 0"""


def m1_batched(spark, sf_dir):
    """The same counts from a Python scorer behind the batch interface."""
    good, bad = frozenset(GOOD), frozenset(BAD)

    def load():
        import re

        cut = re.compile("[^a-z]+")

        def score(texts):
            out = []
            for text in texts:
                words = cut.split(text.lower())
                g, b = sum(w in good for w in words), sum(w in bad for w in words)
                label = "POSITIVE" if g > b else "Negative" if g < b else "other"
                out.append((label, abs(g - b) / (g + b) if g + b else 0.0))
            return out

        return score

    return _scored(sentiment.with_sentiment(_texts(spark, sf_dir), sentiment.batched(load), STAMP))


def _in(words):
    return ", ".join(repr(w) for w in words)


M1_SQL = f"""
    WITH t AS (SELECT doc_id, nullif(concat_ws('. ', CASE WHEN lang = 'en' THEN 'The news' END, nullif(trim(text, {WS}), '')), '') AS txt
                 FROM documents
               UNION ALL SELECT -doc_id - 1, CASE WHEN lang = 'en' THEN 'The news' END FROM documents WHERE doc_id % 10 = 0),
         w AS (SELECT doc_id, txt, regexp_split_to_array(lower(txt), '[^a-z]+') AS ws FROM t),
         c AS (SELECT doc_id, txt, len(list_filter(ws, lambda x: x IN ({_in(GOOD)}))) AS g,
                      len(list_filter(ws, lambda x: x IN ({_in(BAD)}))) AS b FROM w),
         s AS (SELECT doc_id, CASE WHEN g > b THEN 'positive' WHEN g < b THEN 'negative' ELSE 'neutral' END AS sentiment_label,
                      CASE WHEN g + b > 0 THEN abs(g - b) / (g + b) ELSE 0e0 END AS conf FROM c)
    SELECT doc_id, sentiment_label,
           CAST(CASE sentiment_label WHEN 'positive' THEN 1 WHEN 'negative' THEN -1 ELSE 0 END AS BIGINT) AS sentiment_score,
           {S.r('conf', 6)} AS sentiment_confidence, '2025-01-01 00:00:00' AS analysed_at FROM s"""

# --- encoding, columns, split ---------------------------------------------------------


def m2(spark, sf_dir):
    rows = labels.price_labels(line_prices(spark, sf_dir))
    return with_day(rows.select(
        "ticker", "trading_date", M.encoded().alias("class"), M.decoded(M.encoded()).alias("direction")
    ), "trading_date")


M2_SQL = S.with_ctes(
    "line_prices future returns labels_of",
    """SELECT ticker, CAST(trading_date AS VARCHAR) AS trading_date,
              CASE label_direction WHEN 'BUY' THEN 0e0 WHEN 'HOLD' THEN 1e0 WHEN 'SELL' THEN 2e0 END AS class,
              label_direction AS direction FROM labels_of""",
)


def c11(spark, sf_dir):
    """The detected feature columns, with how many values each has."""
    rows = _dataset(spark, sf_dir)
    names = M.feature_columns(rows)
    one = rows.agg(*[F.count(c).alias(c) for c in names])
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("n")) for c in names])
    return one.select(F.explode(cells).alias("r")).select("r.feature", "r.n")


C11_SQL = S.with_ctes(
    DATASET_CTES,
    f", d AS (SELECT count(*) AS n {DATASET_FROM}) SELECT unnest([{_in(DAILY_FEATURES)}]) AS feature, n FROM d",
)


def c12(spark, sf_dir):
    """Training order, doubles, extra columns ignored."""
    rows = daily.daily_sentiment(dated(spark, sf_dir))
    return M.aligned(rows, ["negative_count", "article_count", "positive_ratio"])


C12_SQL = S.with_ctes(
    "line_articles line_daily",
    f"""SELECT CAST(negative_count AS DOUBLE) AS negative_count, CAST(article_count AS DOUBLE) AS article_count,
               {S.daily_sql('positive_ratio')} FROM line_daily""",
)


def _labelled(spark, sf_dir) -> DataFrame:
    return labels.price_labels(line_prices(spark, sf_dir)).where(F.col("label_direction").isNotNull()).select(
        "ticker", F.col("trading_date").alias("date"), "label_direction"
    )


def w17(spark, sf_dir):
    out = split.stratified_split(_labelled(spark, sf_dir))
    return with_day(out.withColumn("is_test", F.col("is_test").cast("long")))


W17_CTES = """, rows_ AS (SELECT ticker, CAST(trading_date AS VARCHAR) AS date, label_direction,
                  row_number() OVER (PARTITION BY label_direction
                    ORDER BY md5(ticker || '|' || CAST(trading_date AS VARCHAR) || '|42')) AS nth
           FROM labels_of WHERE label_direction IS NOT NULL),
       counts AS (SELECT label_direction, count(*) AS n FROM rows_ GROUP BY 1),
       shares AS (SELECT label_direction, ceil(sum(n) OVER () * 0.2e0 - 1e-9) AS test,
                  ceil(sum(n) OVER () * 0.2e0 - 1e-9) * n / sum(n) OVER () AS exact FROM counts),
       quotas AS (SELECT label_direction, floor(exact) + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, label_direction)
                    <= test - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS quota FROM shares)
    """
W17_SQL = S.with_ctes(
    "line_prices future returns labels_of",
    W17_CTES + """SELECT ticker, date, r.label_direction, CAST(CASE WHEN nth <= quota THEN 1 ELSE 0 END AS BIGINT) AS is_test
    FROM rows_ r JOIN quotas q ON q.label_direction = r.label_direction""",
)


def w17_time(spark, sf_dir):
    out = split.time_split(_labelled(spark, sf_dir), dt.date(2000, 7, 1))
    return out.groupBy("label_direction", F.col("is_test").cast("long").alias("is_test")).agg(F.count(F.lit(1)).alias("n"))


W17_TIME_SQL = S.with_ctes(
    "line_prices future returns labels_of",
    """SELECT label_direction, CAST(CASE WHEN trading_date >= DATE '2000-07-01' THEN 1 ELSE 0 END AS BIGINT) AS is_test,
              count(*) AS n FROM labels_of WHERE label_direction IS NOT NULL GROUP BY 1, 2""",
)

# --- metrics on a rule-of-thumb prediction ---------------------------------------------


def _guesses(spark, sf_dir) -> DataFrame:
    """Predict that the last move goes on; compare with the label."""
    prices = line_prices(spark, sf_dir)
    moves = indicators.with_returns(prices, (1,)).select("ticker", "trading_date", "price_chg_1d")
    truth = labels.price_labels(prices).select("ticker", "trading_date", "label_direction")
    both = moves.join(truth, ["ticker", "trading_date"]).where(F.col("label_direction").isNotNull())
    change = F.col("price_chg_1d")
    guess = F.when(change > 0.02, "BUY").when(change < -0.02, "SELL").otherwise("HOLD")
    return both.withColumn("predicted_direction", guess)


GUESS_CTES = "line_prices series future returns labels_of"
GUESS_SQL = f""", g AS (SELECT l.ticker, label_direction AS a,
        CASE WHEN {S.r('c / pc - 1', 8)} > 0.02e0 THEN 'BUY' WHEN {S.r('c / pc - 1', 8)} < -0.02e0 THEN 'SELL' ELSE 'HOLD' END AS p
      FROM labels_of l JOIN series s ON s.ticker = l.ticker AND s.trading_date = l.trading_date
      WHERE label_direction IS NOT NULL),
    cls AS (SELECT unnest(['BUY', 'HOLD', 'SELL']) AS k),
    m AS (SELECT k AS class, count(*) FILTER (a = k) AS support, count(*) FILTER (p = k) AS said,
                 count(*) FILTER (a = k AND p = k) AS hit FROM cls CROSS JOIN g GROUP BY k),
    pr AS (SELECT class, support, CASE WHEN said > 0 THEN hit / said ELSE 0e0 END AS prec,
                  CASE WHEN support > 0 THEN hit / support ELSE 0e0 END AS rec FROM m),
    pc AS (SELECT class, support, prec, rec, CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0e0 END AS f FROM pr)
    """


def _round(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: half_even(F.col(c), 10) for c in names})


def m5(spark, sf_dir):
    return metrics.confusion_matrix(_guesses(spark, sf_dir))


M5_SQL = S.with_ctes(GUESS_CTES, GUESS_SQL + """
    SELECT x.k AS actual, y.k AS predicted, count(g.a) AS n FROM cls x CROSS JOIN cls y
    LEFT JOIN g ON g.a = x.k AND g.p = y.k GROUP BY 1, 2""")


def m6(spark, sf_dir):
    return _round(metrics.class_metrics(metrics.confusion_matrix(_guesses(spark, sf_dir))), "precision", "recall", "f1")


PC = f"{S.r('prec', 10)} AS precision, {S.r('rec', 10)} AS recall, {S.r('f', 10)} AS f1"
M6_SQL = S.with_ctes(GUESS_CTES, GUESS_SQL + f"SELECT class, {PC}, support FROM pc")


def m6_overall(spark, sf_dir):
    out = metrics.overall_metrics(metrics.confusion_matrix(_guesses(spark, sf_dir)))
    return _round(out, "accuracy", "macro_precision", "macro_recall", "macro_f1")


M6_OVERALL_SQL = S.with_ctes(GUESS_CTES, GUESS_SQL + f"""
    SELECT (SELECT {S.r('count(*) FILTER (a = p) / count(*)', 10)} FROM g) AS accuracy, (SELECT count(*) FROM g) AS rows,
           {S.r('avg(prec)', 10)} AS macro_precision, {S.r('avg(rec)', 10)} AS macro_recall, {S.r('avg(f)', 10)} AS macro_f1
    FROM pc WHERE class IN (SELECT a FROM g UNION SELECT p FROM g)""")


def m7(spark, sf_dir):
    out = metrics.classification_report(metrics.confusion_matrix(_guesses(spark, sf_dir)))
    return _round(out, "precision", "recall", "f1")


M7_SQL = S.with_ctes(GUESS_CTES, GUESS_SQL + f"""
    SELECT class, {PC}, support FROM pc
    UNION ALL SELECT 'macro avg', {S.r('avg(prec)', 10)}, {S.r('avg(rec)', 10)}, {S.r('avg(f)', 10)}, CAST(sum(support) AS BIGINT) FROM pc
    UNION ALL SELECT 'weighted avg', {S.r('sum(prec * support) / sum(support)', 10)}, {S.r('sum(rec * support) / sum(support)', 10)},
              {S.r('sum(f * support) / sum(support)', 10)}, CAST(sum(support) AS BIGINT) FROM pc""")


def m8(spark, sf_dir):
    """The bundle written as the metrics file (B5) and read back."""
    path = sinks.write_report(metrics.metric_rows(_guesses(spark, sf_dir)), fresh_path(spark, "metrics"), "json")
    schema = "section string, name string, metric string, value double"
    return _round(tune(spark).read.schema(schema).json(path), "value")


M8_SQL = S.with_ctes(GUESS_CTES, GUESS_SQL + f"""
    SELECT 'confusion' AS section, x.k AS name, y.k AS metric, CAST(count(g.a) AS DOUBLE) AS value FROM cls x CROSS JOIN cls y
      LEFT JOIN g ON g.a = x.k AND g.p = y.k GROUP BY ALL
    UNION ALL SELECT 'per_class', class, 'precision', {S.r('prec', 10)} FROM pc
    UNION ALL SELECT 'per_class', class, 'recall', {S.r('rec', 10)} FROM pc
    UNION ALL SELECT 'per_class', class, 'f1', {S.r('f', 10)} FROM pc
    UNION ALL SELECT 'per_class', class, 'support', CAST(support AS DOUBLE) FROM pc
    UNION ALL SELECT 'report', 'macro avg', unnest(['precision', 'recall', 'f1', 'support']),
      unnest([{S.r('avg(prec)', 10)}, {S.r('avg(rec)', 10)}, {S.r('avg(f)', 10)}, CAST(sum(support) AS DOUBLE)]) FROM pc
    UNION ALL SELECT 'report', 'weighted avg', unnest(['precision', 'recall', 'f1', 'support']),
      unnest([{S.r('sum(prec * support) / sum(support)', 10)}, {S.r('sum(rec * support) / sum(support)', 10)},
              {S.r('sum(f * support) / sum(support)', 10)}, CAST(sum(support) AS DOUBLE)]) FROM pc
    UNION ALL SELECT 'overall', 'all', 'accuracy', {S.r('count(*) FILTER (a = p) / count(*)', 10)} FROM g
    UNION ALL SELECT 'overall', 'all', 'macro_precision', {S.r('avg(prec)', 10)} FROM pc
    UNION ALL SELECT 'overall', 'all', 'macro_recall', {S.r('avg(rec)', 10)} FROM pc
    UNION ALL SELECT 'overall', 'all', 'macro_f1', {S.r('avg(f)', 10)} FROM pc""")


def b4(spark, sf_dir):
    """Predictions of the rule of thumb, written and read back."""
    rows = _guesses(spark, sf_dir).select("ticker", "trading_date", "label_direction", "predicted_direction")
    path = sinks.write_predictions(rows, fresh_path(spark, "predictions"))
    return with_day(spark.read.parquet(path), "trading_date")


B4_SQL = S.with_ctes(GUESS_CTES, GUESS_SQL.replace("SELECT l.ticker,", "SELECT l.ticker, l.trading_date,") + """
    SELECT ticker, CAST(trading_date AS VARCHAR) AS trading_date, a AS label_direction, p AS predicted_direction FROM g""")


def b5(spark, sf_dir):
    """The per-class table as a CSV report."""
    table_ = metrics.class_metrics(metrics.confusion_matrix(_guesses(spark, sf_dir)))
    path = sinks.write_report(table_, fresh_path(spark, "report"), "csv")
    schema = "class string, precision double, recall double, f1 double, support long"
    return _round(tune(spark).read.schema(schema).option("header", True).csv(path), "precision", "recall", "f1")


def g12(spark, sf_dir):
    return reports.prediction_summary(_guesses(spark, sf_dir))


G12_SQL = S.with_ctes(GUESS_CTES, GUESS_SQL + f"""
    SELECT class AS direction, said AS predictions,
           {S.r('said * 100.0 / (SELECT count(*) FROM g)', 1)} AS percent FROM m""")


def g13(spark, sf_dir):
    bars = indicators.with_sma(indicators.with_returns(line_prices(spark, sf_dir)))
    return reports.missing_values(bars, ["price_chg_1d", "price_chg_10d", "sma_20"])


G13_SQL = S.with_ctes("line_prices series", """
    , n AS (SELECT count(*) FILTER (rn <= 1) AS a, count(*) FILTER (rn <= 10) AS b, count(*) FILTER (rn <= 19) AS c FROM series)
    SELECT 'price_chg_1d' AS feature, a AS missing FROM n UNION ALL SELECT 'price_chg_10d', b FROM n
    UNION ALL SELECT 'sma_20', c FROM n UNION ALL SELECT '(total)', a + b + c FROM n""")

# --- training and jobs: tree ensembles are not SQL, but what must hold of their results is ------

#: models trained in this program, by sample and kind: several queries look at the same one
_trained: dict = {}


def _training_set(spark, sf_dir) -> DataFrame:
    from newstape.checks.daily_queries import FIRST, LAST, feature_rows
    from newstape.plans.dataset import labelled_dataset

    return labelled_dataset(feature_rows(spark, sf_dir), line_prices(spark, sf_dir), FIRST, LAST)


def _model_of(spark, sf_dir, kind="forest"):
    """A model trained with the defaults on the whole labelled set, and those rows."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _trained:
        path = fresh_path(spark, "training")
        _training_set(spark, sf_dir).write.parquet(path)
        _trained[key] = (M.train(spark.read.parquet(path), kind=kind), path)
    fitted, path = _trained[key]
    return fitted, spark.read.parquet(path)


def _sound(out: DataFrame, *more) -> DataFrame:
    """Per prediction: its key, whether the class is known, and the sum of the probabilities."""
    total = sum((F.col(f"prob_{c}") for c in DIRECTIONS), F.lit(0.0))
    return with_day(out.select(
        "ticker", "date", *more, half_even(total, 6).alias("prob_sum"),
        F.col("predicted_direction").isin(DIRECTIONS).cast("long").alias("known"),
    ))


def _sound_sql(more: str = "") -> str:
    return S.with_ctes(
        DATASET_CTES,
        f"""SELECT d.ticker, CAST(date AS VARCHAR) AS date, {more} 1e0 AS prob_sum, CAST(1 AS BIGINT) AS known {DATASET_FROM}""",
    )


def m3(spark, sf_dir):
    """Train the forest on the whole labelled set and predict it from its features alone."""
    fitted, rows = _model_of(spark, sf_dir)
    return _sound(fitted.predict(rows.select("ticker", "date", *fitted.features)))


def m3_boosted(spark, sf_dir):
    fitted, rows = _model_of(spark, sf_dir, "boosted")
    return _sound(fitted.predict(rows))


def m4(spark, sf_dir):
    """Every row once, its own columns kept, a known class, probabilities that sum to one."""
    fitted, rows = _model_of(spark, sf_dir)
    return _sound(fitted.predict(rows), "article_count")


M3_SQL = _sound_sql()
M4_SQL = _sound_sql("article_count,")


def _importances(spark, sf_dir) -> DataFrame:
    """Importances with what must hold of them: none below zero, none above the one ranked before it."""
    fitted, _ = _model_of(spark, sf_dir)
    found = fitted.importances(spark)
    before = found.select((F.col("rank") + 1).alias("rank"), F.col("importance").alias("before"))
    held = (F.col("importance") >= 0) & (F.coalesce("before", F.lit(1.0)) >= F.col("importance"))
    return found.join(before, "rank", "left").withColumn("ordered", held.cast("long"))


def m9(spark, sf_dir):
    """Every feature once; ranks 1 to the number of features; importances that sum to one."""
    rows = _importances(spark, sf_dir)
    whole = rows.agg(
        F.collect_list("feature").alias("features"), half_even(F.sum("importance"), 6).alias("total"),
        F.sum("ordered").alias("ordered"), F.count_distinct("rank").alias("ranks"), F.max("rank").cast("long").alias("last_rank"),
    )
    return whole.select(F.explode("features").alias("feature"), "total", "ordered", "ranks", "last_rank")


FEATURE_NAMES = [*DAILY_FEATURES, *TECHNICAL_FEATURES]
M9_SQL = f"""SELECT unnest([{_in(FEATURE_NAMES)}]) AS feature, 1e0 AS total, CAST({len(FEATURE_NAMES)} AS BIGINT) AS ordered,
    CAST({len(FEATURE_NAMES)} AS BIGINT) AS ranks, CAST({len(FEATURE_NAMES)} AS BIGINT) AS last_rank"""


def s4(spark, sf_dir):
    """The twenty most important features: their ranks, and that none exceeds the one before it."""
    top = _importances(spark, sf_dir).orderBy("rank").limit(20)
    return top.select(F.col("rank").cast("long").alias("rank"), "ordered", F.col("feature").isin(FEATURE_NAMES).cast("long").alias("known"))


S4_SQL = "SELECT range AS rank, CAST(1 AS BIGINT) AS ordered, CAST(1 AS BIGINT) AS known FROM range(1, 21)"


def m10(spark, sf_dir):
    """A model saved, loaded and applied by the predict job says what it said before (M4, B4)."""
    fitted, rows = _model_of(spark, sf_dir)
    path = fitted.save(spark, fresh_path(spark, "model"))
    written, _ = training.predict_job(spark, path, rows, fresh_path(spark, "predictions"))
    names = ["predicted_direction", *[f"prob_{c}" for c in DIRECTIONS]]
    kept = written.select("ticker", "date", F.struct(*names).alias("loaded"))
    own = fitted.predict(rows).select("ticker", "date", F.struct(*names).alias("own"))
    return with_day(own.join(kept, ["ticker", "date"], "full_outer").select(
        "ticker", "date", F.col("own").eqNullSafe(F.col("loaded")).cast("long").alias("same")
    ))


M10_SQL = S.with_ctes(
    DATASET_CTES, f"SELECT d.ticker, CAST(date AS VARCHAR) AS date, CAST(1 AS BIGINT) AS same {DATASET_FROM}"
)


def p9(spark, sf_dir):
    """Split, train, predict and measure: the test rows of each class, and ratios between 0 and 1."""
    measured = training.train_and_evaluate(spark, _training_set(spark, sf_dir), fresh_path(spark, "run")).metrics
    support = measured.where((F.col("section") == "per_class") & (F.col("metric") == "support"))
    ratios = measured.where(F.col("section").isin("overall", "report") & (F.col("metric") != "support"))
    inside = ratios.agg(F.count_if(F.col("value").between(0, 1)).cast("double").alias("value"))
    return support.select("name", "value").unionByName(inside.select(F.lit("ratios").alias("name"), "value"))


P9_SQL = S.with_ctes(DATASET_CTES, f"""
    , counts AS (SELECT label_direction, count(*) AS n {DATASET_FROM} WHERE label_direction IS NOT NULL GROUP BY 1),
      shares AS (SELECT label_direction, ceil(sum(n) OVER () * 0.2e0 - 1e-9) AS test,
                 ceil(sum(n) OVER () * 0.2e0 - 1e-9) * n / sum(n) OVER () AS exact FROM counts),
      quotas AS (SELECT label_direction, floor(exact) + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, label_direction)
                   <= test - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS quota FROM shares)
    SELECT k AS name, coalesce(CAST(quota AS DOUBLE), 0e0) AS value
    FROM (SELECT unnest(['BUY', 'HOLD', 'SELL']) AS k) LEFT JOIN quotas ON label_direction = k
    UNION ALL SELECT 'ratios', 10e0""")


def p10(spark, sf_dir):
    """The predict job's summary: a row per class, together all rows."""
    fitted, rows = _model_of(spark, sf_dir)
    path = fitted.save(spark, fresh_path(spark, "model"))
    summary = training.predict_job(spark, path, rows, fresh_path(spark, "predictions"))[1]
    whole = summary.agg(F.collect_list("direction").alias("directions"), F.sum("predictions").alias("predictions"))
    return whole.select(F.explode("directions").alias("direction"), "predictions")


P10_SQL = S.with_ctes(
    DATASET_CTES, f"SELECT unnest([{_in(DIRECTIONS)}]) AS direction, n AS predictions FROM (SELECT count(*) AS n {DATASET_FROM})"
)


def p6(spark, sf_dir):
    """Load the open batch, then the finished one; the second load's totals."""
    folder = fresh_path(spark, "tables")
    stored = line_articles(spark, sf_dir).where(F.col("batch") == "O").drop("batch")
    loading.load_articles(spark, stored, folder, MODEL)
    out = loading.load_articles(spark, _incoming_lines(spark, sf_dir), folder, MODEL).summary
    return out.withColumns({"tickers": F.col("tickers").cast("long"), "is_total": F.col("is_total").cast("long")})


P6_SQL = S.with_ctes("line_articles", """, ex AS (SELECT DISTINCT url FROM line_articles WHERE batch = 'O'),
       raw AS (SELECT *, CASE WHEN source_name IS NULL THEN '' ELSE url END AS u FROM line_articles WHERE batch = 'F'),
       firsts AS (SELECT u, arg_min(ticker, seq) AS ticker FROM raw WHERE u <> '' GROUP BY 1),
       ins AS (SELECT ticker, count(*) AS ins FROM firsts WHERE u NOT IN (SELECT url FROM ex) GROUP BY 1),
       per AS (SELECT raw.ticker, coalesce(any_value(ins), 0) AS ins, count(*) FILTER (u <> '') AS used,
                      count(*) FILTER (u = '') AS skip FROM raw LEFT JOIN ins ON ins.ticker = raw.ticker GROUP BY 1)
    SELECT ticker, CAST(sum(ins) AS BIGINT) AS articles_inserted, CAST(sum(used - ins) AS BIGINT) AS articles_updated,
           CAST(sum(skip) AS BIGINT) AS articles_skipped, CAST(sum(ins) AS BIGINT) AS sentiment_inserted,
           CAST(sum(used - ins) AS BIGINT) AS sentiment_updated, CAST(sum(skip) AS BIGINT) AS sentiment_skipped,
           count(DISTINCT ticker) AS tickers, CAST(grouping(ticker) AS BIGINT) AS is_total,
           CAST(sum(used) AS BIGINT) AS articles_total, CAST(sum(used) AS BIGINT) AS sentiment_total
    FROM per GROUP BY ROLLUP (ticker)""")


def p7(spark, sf_dir):
    """Score the documents, one directory per language, and summarise."""
    docs = table(spark, sf_dir, "documents").select(
        F.upper("lang").alias("ticker"), F.lit(None).cast("string").alias("title"), F.col("text").alias("description")
    )
    return loading.score_articles(
        docs, fresh_path(spark, "scored"), "2025", sentiment.word_scorer(GOOD, BAD), STAMP
    )[1]


def p7_csv(spark, sf_dir):
    """The same as CSV: texts with quotes and line breaks, and tickers of digits, come back as they were."""
    docs = table(spark, sf_dir, "documents").select(
        F.lpad(F.col("doc_id") % 7, 4, "0").alias("ticker"), F.col("doc_id").cast("string").alias("title"),
        F.concat(F.lit('say "x", '), F.col("text"), F.lit("\n, end")).alias("description"),
    )
    written, _ = loading.score_articles(
        docs, fresh_path(spark, "scored"), "2025", sentiment.word_scorer(GOOD, BAD), STAMP, fmt="csv"
    )
    return written.select("ticker", "title", F.md5("description").alias("description"), "sentiment_label",
                          F.col("sentiment_score").cast("long").alias("sentiment_score"), "sentiment_confidence")


P7_CSV_SQL = f"""
    WITH w AS (SELECT lpad(CAST(doc_id % 7 AS VARCHAR), 4, '0') AS ticker, CAST(doc_id AS VARCHAR) AS title,
                      'say "x", ' || text || chr(10) || ', end' AS description FROM documents),
         s AS (SELECT *, regexp_split_to_array(lower(title || '. ' || trim(description, {WS})), '[^a-z]+') AS ws FROM w),
         c AS (SELECT *, len(list_filter(ws, lambda x: x IN ({_in(GOOD)}))) AS g,
                      len(list_filter(ws, lambda x: x IN ({_in(BAD)}))) AS b FROM s)
    SELECT ticker, title, md5(description) AS description,
           CASE WHEN g > b THEN 'positive' WHEN g < b THEN 'negative' ELSE 'neutral' END AS sentiment_label,
           CAST(CASE WHEN g > b THEN 1 WHEN g < b THEN -1 ELSE 0 END AS BIGINT) AS sentiment_score,
           {S.r('CASE WHEN g + b > 0 THEN abs(g - b) / (g + b) ELSE 0e0 END', 6)} AS sentiment_confidence FROM c"""

P7_SQL = f"""
    WITH w AS (SELECT upper(lang) AS ticker, regexp_split_to_array(lower(trim(text, {WS})), '[^a-z]+') AS ws FROM documents),
         c AS (SELECT ticker, len(list_filter(ws, lambda x: x IN ({_in(GOOD)}))) AS g,
                      len(list_filter(ws, lambda x: x IN ({_in(BAD)}))) AS b FROM w)
    SELECT ticker, count(*) AS article_count, count(*) FILTER (g > b) AS positive, count(*) FILTER (g = b OR g IS NULL) AS neutral,
           count(*) FILTER (g < b) AS negative,
           {S.r('avg(CASE WHEN g > b THEN 1e0 WHEN g < b THEN -1e0 ELSE 0e0 END)', 4)} AS mean_score, 'ok' AS status
    FROM c GROUP BY 1"""


def p8(spark, sf_dir):
    """Load both price batches; the merged table."""
    folder = fresh_path(spark, "tables")
    loading.load_prices(spark, _batch_prices(spark, sf_dir, "O"), folder)
    return with_day(loading.load_prices(spark, _batch_prices(spark, sf_dir, "F"), folder)[0], "trading_date")


# --- streams ------------------------------------------------------------------------------


def _event_stream(spark, sf_dir) -> DataFrame:
    """The events file as a stream of articles."""
    schema = tune(spark).read.parquet(f"{sf_dir}/events.parquet").schema
    kind = F.col("event_type")
    return intake.file_stream(spark, sf_dir, schema, "events.parquet").select(
        F.concat(F.lit("T"), F.col("user_id") % 10).alias("ticker"),
        F.concat(F.lit("http://news.example/u/"), F.col("user_id")).alias("url"),
        F.col("ts").cast("timestamp").alias("published_at"),
        F.when(kind.isin("purchase", "signup"), "positive").when(kind == "error", "negative").otherwise("neutral").alias("sentiment_label"),
        F.when(kind.isin("purchase", "signup"), 1).when(kind == "error", -1).otherwise(0).alias("sentiment_score"),
    )


def t1(spark, sf_dir):
    """Every user's url once, however often it arrives."""
    root = fresh_path(spark, "stream")
    seen = intake.new_urls(_event_stream(spark, sf_dir), "60 days").select("url", "ticker")
    stored = KeyedTable(spark, f"{root}/table", seen.schema, ["url"], by_hash(["url"], 8), rebalance=False)
    intake.run_available(seen, f"{root}/checkpoint", intake.upsert_batches(stored, ["url"], []))
    return stored.read()


T1_SQL = "SELECT DISTINCT 'http://news.example/u/' || user_id AS url, 'T' || (user_id % 10) AS ticker FROM events"


def t2(spark, sf_dir):
    """Daily counts in update mode, merged by (ticker, date) as they grow."""
    root = fresh_path(spark, "stream")
    counts = intake.daily_label_counts(_event_stream(spark, sf_dir))
    refresh = [c for c in counts.columns if c not in ("ticker", "date")]
    stored = KeyedTable(spark, f"{root}/table", counts.schema, ["ticker", "date"], by_month("date"))
    merge = intake.upsert_batches(stored, ["ticker", "date"], refresh)
    intake.run_available(counts, f"{root}/checkpoint", merge, "update")
    return with_day(stored.read().withColumn("daily_mean", half_even(F.col("daily_mean"), 8)))


T2_SQL = S.with_ctes("event_articles", f"""
    SELECT ticker, CAST(date AS VARCHAR) AS date, count(*) AS article_count,
           count(*) FILTER (sentiment_label = 'positive') AS positive_count,
           count(*) FILTER (sentiment_label = 'neutral') AS neutral_count,
           count(*) FILTER (sentiment_label = 'negative') AS negative_count,
           {S.r('avg(CAST(sentiment_score AS DOUBLE))', 8)} AS daily_mean FROM event_articles GROUP BY ALL""")


def t3(spark, sf_dir):
    """Articles of the stream merged by url: first ticker and time stay, the label is refreshed."""
    root = fresh_path(spark, "stream")
    stream = _event_stream(spark, sf_dir)
    stored = KeyedTable(spark, f"{root}/table", stream.schema, ["url"], by_month("published_at"), part_of_key=False)
    merge = intake.upsert_batches(stored, ["url"], ["sentiment_label", "sentiment_score"], "seq")
    intake.run_available(stream.withColumn("seq", F.struct("published_at", "sentiment_label")), f"{root}/checkpoint", merge)
    out = stored.read().withColumn("sentiment_score", F.col("sentiment_score").cast("long"))
    return as_text(out, "published_at")


T3_SQL = S.with_ctes("event_articles", """, a AS (SELECT ticker, 'http://news.example/u/' || user_id AS url, published_at,
              sentiment_label, sentiment_score FROM event_articles JOIN (SELECT event_id, user_id FROM events) USING (event_id))
    SELECT url, arg_min(ticker, (published_at, sentiment_label)) AS ticker,
           strftime(min(published_at), '%Y-%m-%d %H:%M:%S') AS published_at,
           arg_max(sentiment_label, (published_at, sentiment_label)) AS sentiment_label,
           CAST(arg_max(sentiment_score, (published_at, sentiment_label)) AS BIGINT) AS sentiment_score FROM a GROUP BY url""")

QUERIES = {
    "m1_sentiment": (m1, M1_SQL),
    "m1_sentiment_batched": (m1_batched, M1_SQL),
    "m1_learned_scorer": (m1_learned, M1_LEARNED_SQL),
    "m2_class_numbers": (m2, M2_SQL),
    "c11_feature_columns": (c11, C11_SQL),
    "c12_aligned_features": (c12, C12_SQL),
    "w17_stratified_split": (w17, W17_SQL),
    "w17_time_split": (w17_time, W17_TIME_SQL),
    "m5_confusion_matrix": (m5, M5_SQL),
    "m6_class_metrics": (m6, M6_SQL),
    "m6_overall_metrics": (m6_overall, M6_OVERALL_SQL),
    "m7_classification_report": (m7, M7_SQL),
    "m8_metric_bundle": (m8, M8_SQL),
    "g12_prediction_summary": (g12, G12_SQL),
    "g13_missing_values": (g13, G13_SQL),
    "b4_prediction_sink": (b4, B4_SQL),
    "b5_report_sink": (b5, M6_SQL),
    "m4_batch_predict": (m4, M4_SQL),
    "m3_forest": (m3, M3_SQL),
    "m3_boosted": (m3_boosted, M3_SQL),
    "m9_importances": (m9, M9_SQL),
    "s4_top_features": (s4, S4_SQL),
    "m10_saved_model_predictions": (m10, M10_SQL),
    "p6_load_articles": (p6, P6_SQL),
    "p7_score_articles": (p7, P7_SQL),
    "p7_score_articles_csv": (p7_csv, P7_CSV_SQL),
    "p8_load_prices": (p8, VERSIONS_SQL),
    "p9_train_and_evaluate": (p9, P9_SQL),
    "p10_predict": (p10, P10_SQL),
    "t1_new_urls": (t1, T1_SQL),
    "t2_daily_counts": (t2, T2_SQL),
    "t3_upsert_stream": (t3, T3_SQL),
}
