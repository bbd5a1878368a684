"""Sentiment columns for articles: blank texts stay neutral, the rest goes to a scorer.

A scorer is a native expression (text column in, struct of label and confidence out), a
Python callable over batches of texts, or a model learnt from labelled articles
(:mod:`newstape.operators.learned`).  No model ships with the package: the default scorer
counts words of a short list, which is a stand-in behind the same interface.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, functions as F

from newstape.functions.numeric import half_even
from newstape.functions.text import model_text, stripped
from newstape.operators.learned import LearnedScorer
from newstape.schemas import SENTIMENT_SCORES

#: The stand-in scorer's words.
POSITIVE_WORDS = ["beat", "gain", "growth", "profit", "record", "rise", "strong", "surge", "up", "win"]
NEGATIVE_WORDS = ["cut", "decline", "drop", "fall", "fraud", "loss", "miss", "risk", "weak", "down"]

BATCH = 32

Expression = Callable[[Column], Column]
BatchScorer = Callable[[list[str]], list[tuple[str, float]]]


def word_scorer(
    positive: list[str] = POSITIVE_WORDS, negative: list[str] = NEGATIVE_WORDS
) -> Expression:
    """Label by the majority of listed words; confidence is the margin over the words found."""
    def count(text: Column, words: list[str]) -> Column:
        # whole words of a-z, as no other word can stand in a text cut at all other characters
        plain = sorted({w for w in words if re.fullmatch("[a-z]+", w)})
        return F.regexp_count(text, F.lit(f"(?<![a-z])(?:{'|'.join(plain)})(?![a-z])")) if plain else F.lit(0)

    def judged(found: Column) -> Column:
        good, bad = found["good"], found["bad"]
        label = F.when(good > bad, "positive").when(good < bad, "negative").otherwise("neutral")
        margin = F.coalesce(F.try_divide(F.abs(good - bad), good + bad), F.lit(0.0))
        return F.struct(label.alias("label"), margin.alias("score"))

    def score(text: Column) -> Column:
        low = F.lower(text)
        found = F.struct(count(low, positive).cast("double").alias("good"), count(low, negative).cast("double").alias("bad"))
        # through an array, so the counts are taken once, however often label and score are asked for
        return F.element_at(F.transform(F.array(found), judged), 1)

    return score


def batched(load: Callable[[], BatchScorer], batch: int = BATCH) -> Expression:
    """A Python scorer as an Arrow-batched UDF.

    ``load`` runs once per Python worker and returns a function from a list of
    texts to (label, score) pairs.
    """
    import pandas as pd

    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = load()
        for texts in series:
            values = texts.tolist()
            results = []
            for start in range(0, len(values), batch):
                chunk = values[start:start + batch]
                known = [t for t in chunk if t is not None]
                answers = iter(scorer(known) if known else [])
                results.extend((None, None) if t is None else next(answers) for t in chunk)
            yield pd.DataFrame(
                {"label": [r[0] for r in results], "score": [r[1] for r in results]}, index=texts.index
            ).astype({"score": "float64"})

    run.__annotations__ = {"series": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, "label string, score double")


def with_sentiment(
    articles: DataFrame,
    scorer: Expression | LearnedScorer | None = None,
    analysed_at: dt.datetime | None = None,
    title: str = "title",
    description: str = "description",
) -> DataFrame:
    """The articles plus label, score, confidence and one time stamp for the whole run."""
    scorer = scorer or word_scorer()
    stamp = analysed_at or dt.datetime.now(dt.timezone.utc)
    text = model_text(
        F.col(title) if title in articles.columns else F.lit(None).cast("string"),
        F.col(description) if description in articles.columns else F.lit(None).cast("string"),
    )
    plain = articles.withColumn("_text", stripped(text))
    if isinstance(scorer, LearnedScorer):
        scored = scorer.attach(plain, "_text", "_result")
    else:
        scored = plain.withColumn("_result", scorer(F.col("_text")))
    blank = F.col("_text").isNull()
    lowered = F.lower("_result.label")
    label = F.when(~blank & lowered.isin(list(SENTIMENT_SCORES)), lowered).otherwise(F.lit("neutral"))
    confidence = F.when(blank, F.lit(0.0)).otherwise(half_even(F.coalesce("_result.score", F.lit(0.0)), 6))
    value = F.lit(0)
    for name, number in SENTIMENT_SCORES.items():
        value = F.when(F.col("sentiment_label") == name, number).otherwise(value)
    return scored.withColumns({
        "sentiment_label": label, "sentiment_confidence": confidence, "analysed_at": F.lit(stamp).cast("timestamp"),
    }).withColumn("sentiment_score", value).select(
        *[c for c in articles.columns if c not in ("sentiment_label", "sentiment_score", "sentiment_confidence", "analysed_at")],
        "sentiment_label", "sentiment_score", "sentiment_confidence", "analysed_at",
    )
