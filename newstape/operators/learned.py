"""A sentiment scorer learnt from labelled articles: hashed words and word pairs, logistic regression over the labels.

Everything is a Spark ML pipeline, so scoring stays in the JVM and a model is saved and
loaded as any other.  Only the first :data:`TOKENS` words of a text are looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram, SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from newstape.errors import DataPreparationError
from newstape.schemas import SENTIMENT_SCORES
from newstape.session import fresh_path, remove, small_reads

#: Fixed value: words of a text that count.
TOKENS = 512
#: hash buckets of words and word pairs
BUCKETS = 1 << 15
#: rows are learnt from in blocks of so many MB, which the learner keeps; its memory is not counted as exactly for larger ones
BLOCK_MB = 1.0
TEXT, WORDS = "_text", "_words"


def _stages() -> list:
    # words of the text (it is cut no further than they are needed), their pairs, and both counted by hash
    words = SQLTransformer(statement=(
        f"SELECT *, filter(slice(split(lower(coalesce({TEXT}, '')), '[^\\\\p{{L}}\\\\p{{N}}]+', {TOKENS + 2}), 1, {TOKENS + 1}), w -> w <> '') AS {WORDS} FROM __THIS__"
    ))
    pairs = NGram(n=2, inputCol=WORDS, outputCol="_pairs")
    both = SQLTransformer(statement=f"SELECT *, concat(slice({WORDS}, 1, {TOKENS}), _pairs) AS _grams FROM __THIS__")
    return [words, pairs, both, HashingTF(inputCol="_grams", outputCol="_counts", numFeatures=BUCKETS, binary=True)]


class LearnedScorer:
    """Attaches a struct of label and confidence; what :func:`~newstape.operators.sentiment.with_sentiment` takes as a scorer."""

    def __init__(self, model: PipelineModel, labels: Sequence[str] = tuple(SENTIMENT_SCORES)):
        self.model, self.labels = model, list(labels)

    def attach(self, df: DataFrame, text: str, output: str) -> DataFrame:
        """``df`` with ``output``: the likeliest label and its probability."""
        kept = [c for c in df.columns if c != output]
        scored = self.model.transform(df.withColumn(TEXT, F.col(text)))
        shares = vector_to_array("_probability")
        best = F.array_max(shares)
        label = F.element_at(F.array(*map(F.lit, self.labels)), F.array_position(shares, best).cast("int"))
        return scored.withColumn(output, F.struct(label.alias("label"), best.alias("score"))).select(*kept, output)

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)

    @classmethod
    def load(cls, path: str) -> "LearnedScorer":
        return cls(PipelineModel.load(path))


def _labelled(articles: DataFrame, text: str, label: str) -> DataFrame:
    """Texts with a known label and its number; labels are computed once (a filter would ask for each again)."""
    number = F.lit(None).cast("double")
    for k, name in enumerate(SENTIMENT_SCORES):
        number = F.when(F.lower(label) == name, float(k)).otherwise(number)
    return articles.select(F.col(text).alias(TEXT), F.explode(F.array_compact(F.array(number))).alias("_label"))


def train_scorer(
    articles: DataFrame, text: str = "text", label: str = "sentiment_label", regularisation: float = 1e-2, iterations: int = 40
) -> LearnedScorer:
    """Learn from articles with a known label; others are left out, NULL texts count as empty.

    The learner keeps its rows in memory as far as they fit, on disk beyond.  It goes over
    pieces of bounded size, as a task holds a piece whole while it is kept or read back.
    """
    rows = _labelled(articles, text, label)
    stages = _stages()
    spark, path = articles.sparkSession, fresh_path(articles.sparkSession, "counts")
    # written once: the learner goes over its rows more than once, and texts and labels may be dear
    PipelineModel(stages=[s for s in stages]).transform(rows).select("_counts", "_label").write.parquet(path)
    ready = spark.read.parquet(path)
    if ready.isEmpty():
        raise DataPreparationError("no labelled articles to learn from")
    meta = {"ml_attr": {"type": "nominal", "name": "_label", "vals": list(SENTIMENT_SCORES)}}  # also where one does not occur
    learner = LogisticRegression(
        featuresCol="_counts", labelCol="_label", probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_predicted",
        family="multinomial", regParam=regularisation, maxIter=iterations, standardization=False, maxBlockSizeInMB=BLOCK_MB,
    )
    with small_reads(spark):
        fitted = learner.fit(ready.withMetadata("_label", meta))
    remove(spark, path)
    return LearnedScorer(PipelineModel(stages=[*stages, fitted]))
