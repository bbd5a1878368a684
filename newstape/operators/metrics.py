"""Classifier metrics from one grouping of (truth, prediction) pairs.

All of them start from the confusion counts, a table of at most classes x classes
rows, and are keyed by class name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from newstape.schemas import DIRECTIONS


def _share(part: Column, whole: Column) -> Column:
    """0 where the denominator is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _pairs(predictions: DataFrame, truth: str, predicted: str) -> DataFrame:
    return predictions.groupBy(F.col(truth).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(
    predictions: DataFrame, truth: str = "label_direction", predicted: str = "predicted_direction",
    classes: Sequence[str] = DIRECTIONS,
) -> DataFrame:
    """(actual, predicted, n) over the full grid of classes, zeros included."""
    cells = [
        F.struct(
            F.lit(a).alias("actual"), F.lit(p).alias("predicted"),
            F.coalesce(F.sum(F.when((F.col("actual") == a) & (F.col("predicted") == p), F.col("n"))), F.lit(0)).alias("n"),
        )
        for a in classes for p in classes
    ]
    one = _pairs(predictions, truth, predicted).agg(F.array(*cells).alias("cells"))
    return one.select(F.explode("cells").alias("c")).select("c.actual", "c.predicted", "c.n")


def _class_rows(confusion: DataFrame) -> DataFrame:
    """Per class: support, times predicted, hits, and the ratios built from them."""
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    sides = F.explode(F.array(
        F.struct(F.col("actual").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("said"), hit.cast("long").alias("hit")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("said"), F.lit(0).cast("long").alias("hit")),
    ))
    rows = confusion.select(sides.alias("s")).groupBy("s.class").agg(
        *[F.sum(f"s.{c}").alias(c) for c in ("support", "said", "hit")]
    ).withColumns({
        "precision": _share(F.col("hit"), F.col("said")), "recall": _share(F.col("hit"), F.col("support")),
    })
    p, r = F.col("precision"), F.col("recall")
    return rows.withColumn("f1", _share(2 * p * r, p + r))


def class_metrics(confusion: DataFrame) -> DataFrame:
    """Per class: precision, recall, F1 (0 where undefined) and support."""
    return _class_rows(confusion).select("class", "precision", "recall", "f1", "support")


def overall_metrics(confusion: DataFrame) -> DataFrame:
    """One row: accuracy and the macro means of precision, recall and F1.

    The macro means run over the classes that occur as truth or prediction.
    """
    seen = F.col("support") + F.col("said") > 0
    return _class_rows(confusion).agg(
        _share(F.sum("hit"), F.sum("support")).alias("accuracy"),
        F.sum("support").alias("rows"),
        *[F.coalesce(F.avg(F.when(seen, F.col(c))), F.lit(0.0)).alias(f"macro_{c}") for c in ("precision", "recall", "f1")],
    )


def classification_report(confusion: DataFrame) -> DataFrame:
    """The per-class table followed by the macro and support-weighted means."""
    rows = class_metrics(confusion)
    names = ("precision", "recall", "f1")
    total = F.sum("support")
    macro = rows.agg(*[F.avg(c).alias(c) for c in names], total.alias("support")).select(
        F.lit("macro avg").alias("class"), *names, "support"
    )
    weighted = rows.agg(
        *[_share(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c) for c in names], total.alias("support")
    ).select(F.lit("weighted avg").alias("class"), *names, "support")
    return rows.unionByName(macro).unionByName(weighted)


def all_metrics(predictions: DataFrame, truth: str = "label_direction", predicted: str = "predicted_direction") -> dict[str, DataFrame]:
    """The bundle: confusion matrix, per-class and overall metrics, and the report."""
    confusion = confusion_matrix(predictions, truth, predicted)
    return {
        "confusion": confusion,
        "per_class": class_metrics(confusion),
        "overall": overall_metrics(confusion),
        "report": classification_report(confusion),
    }


def metric_rows(predictions: DataFrame, truth: str = "label_direction", predicted: str = "predicted_direction") -> DataFrame:
    """The whole bundle as (section, name, metric, value) rows, ready for one JSON file."""
    bundle = all_metrics(predictions, truth, predicted)
    cells = bundle["confusion"].select(
        F.lit("confusion").alias("section"), "actual", F.col("predicted").alias("metric"), F.col("n").cast("double").alias("value")
    ).withColumnRenamed("actual", "name")

    def unpivoted(df: DataFrame, section: str, name: Column, metrics: Sequence[str]) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
        return df.select(F.lit(section).alias("section"), name.alias("name"), F.explode(pairs).alias("p")).select(
            "section", "name", "p.metric", "p.value"
        )

    per_class = unpivoted(bundle["per_class"], "per_class", F.col("class"), ("precision", "recall", "f1", "support"))
    overall = unpivoted(
        bundle["overall"], "overall", F.lit("all"), ("accuracy", "macro_precision", "macro_recall", "macro_f1")
    )
    means = bundle["report"].where(F.col("class").isin("macro avg", "weighted avg"))
    report = unpivoted(means, "report", F.col("class"), ("precision", "recall", "f1", "support"))
    return overall.unionByName(per_class).unionByName(report).unionByName(cells)
