"""A three-class direction classifier as Spark ML stages.

``boosted`` is gradient boosting with a softmax over the three classes
(:mod:`newstape.operators.boosting`): missing values take the side each split has learnt
for them, and all trees are trained on all labelled rows unless early stopping is asked
for.  ``forest`` is Spark's random forest, which does not accept missing values, so each
feature becomes two: the value with a sentinel where it is missing, and a flag that it was.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newstape.errors import DataPreparationError, ModelNotFoundError
from newstape.operators.boosting import SoftmaxBooster, SoftmaxBoosterModel
from newstape.schemas import DIRECTIONS
from newstape.session import workers_import

LABEL = "label_direction"
#: Columns that are never features.
NOT_FEATURES = ("ticker", "date")
NOT_FEATURE_PREFIXES = ("future_close_", "return_", "label_")
#: Training defaults.
DEFAULTS: dict[str, Any] = {
    "trees": 300, "depth": 6, "learning_rate": 0.05, "row_share": 0.8, "feature_share": 0.8, "seed": 42,
    # boosted only: bins of a feature, and the share of the rows to hold back, to stop when ten rounds do not
    # better the loss there by the tolerance; 0 for none
    "bins": 64, "validation_share": 0.0, "validation_tolerance": 0.0,
}
MISSING = -1.0e9


def feature_columns(df: DataFrame, label: str = LABEL) -> list[str]:
    """All columns that are not identity, label, or look-ahead columns."""
    names = [
        c for c in df.columns
        if c not in NOT_FEATURES and c != label and not c.startswith(NOT_FEATURE_PREFIXES) and c != "is_test"
    ]
    if not names:
        raise DataPreparationError(f"no feature columns among {df.columns}")
    return names


def aligned(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """The training columns as doubles, in training order; others are left out."""
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise DataPreparationError(f"the input lacks training columns: {missing}")
    return df.select(*[F.col(c).cast("double").alias(c) for c in features])


def encoded(label: str = LABEL, classes: Sequence[str] = DIRECTIONS) -> Column:
    """Class number by the canonical class list, not by what the data happen to hold."""
    out = F.lit(None).cast("double")
    for i, name in enumerate(classes):
        out = F.when(F.col(label) == name, F.lit(float(i))).otherwise(out)
    return out


def decoded(number: Column, classes: Sequence[str] = DIRECTIONS) -> Column:
    """Class name of a class number."""
    out = F.lit(None).cast("string")
    for i, name in enumerate(classes):
        out = F.when(number == i, F.lit(name)).otherwise(out)
    return out


def vectors(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add ``features``: values with a sentinel for missing ones (NULL, NaN, infinite), then the flags."""
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise DataPreparationError(f"the input lacks training columns: {missing}")
    infinite = (float("inf"), float("-inf"))
    parts: dict[str, Column] = {}
    for i, name in enumerate(features):
        value = F.col(name).cast("double")
        usable = value.isNotNull() & ~F.isnan(value) & ~value.isin(*infinite)
        parts[f"_f{i}"] = F.when(usable, value).otherwise(F.lit(MISSING))
        parts[f"_m{i}"] = F.when(usable, 0.0).otherwise(1.0)
    order = [f"_f{i}" for i in range(len(features))] + [f"_m{i}" for i in range(len(features))]
    assembled = VectorAssembler(inputCols=order, outputCol="features").transform(df.withColumns(parts))
    return assembled.drop(*order)


@dataclass
class DirectionModel:
    """Fitted trees with what is needed to apply them."""

    kind: str
    features: list[str]
    stages: list[Any]
    classes: list[str] = field(default_factory=lambda: list(DIRECTIONS))
    metadata: dict[str, Any] = field(default_factory=dict)

    def predict(self, df: DataFrame) -> DataFrame:
        """All input columns plus ``predicted_direction`` and ``prob_<class>``."""
        keep = list(df.columns)
        if self.kind == "forest":
            scored = self.stages[0].transform(vectors(df, self.features))
            shares = vector_to_array(F.col("probability"))
        else:
            missing = [c for c in self.features if c not in df.columns]
            if missing:
                raise DataPreparationError(f"the input lacks training columns: {missing}")
            workers_import(df.sparkSession)
            one = self.stages[0].copy()
            scored = one._set(probabilityCol="_probability").transform(df)
            shares = F.col("_probability")
        probs = [shares[i] for i in range(len(self.classes))]
        named = [p.alias(f"prob_{c}") for p, c in zip(probs, self.classes)]
        out = scored.select(*keep, *named)
        best = F.greatest(*[F.col(f"prob_{c}") for c in self.classes])
        winner = F.lit(None).cast("string")
        for name in reversed(self.classes):
            winner = F.when(F.col(f"prob_{name}") == best, F.lit(name)).otherwise(winner)
        return out.select(*keep, winner.alias("predicted_direction"), *[f"prob_{c}" for c in self.classes])

    def importances(self, spark: SparkSession) -> DataFrame:
        """(feature, importance, rank), most important first; a feature's flag counts towards it."""
        size = len(self.features)
        if self.kind == "forest":
            values = self.stages[0].featureImportances.toArray()
            if len(values) != 2 * size:
                raise ValueError(f"{len(values)} importances for {size} features")
            sums = [float(values[i] + values[i + size]) for i in range(size)]
        else:
            sums = [float(v) for v in self.stages[0].importances]
        whole = sum(sums) or 1.0
        ranked = sorted(zip(self.features, (s / whole for s in sums)), key=lambda p: -p[1])
        rows = [(name, value, i + 1) for i, (name, value) in enumerate(ranked)]
        return spark.createDataFrame(rows, "feature string, importance double, rank int")

    def save(self, spark: SparkSession, path: str) -> str:
        """Model directories plus one row with the feature list and metadata, written last."""
        for i, stage in enumerate(self.stages):
            stage.write().overwrite().save(f"{path}/stage-{i}")
        row = json.dumps({
            "kind": self.kind, "features": self.features, "classes": self.classes,
            "stages": len(self.stages), "metadata": self.metadata,
        })
        spark.createDataFrame([(row,)], "model string").coalesce(1).write.mode("overwrite").parquet(f"{path}/info")
        return path


def load_model(spark: SparkSession, path: str) -> DirectionModel:
    try:
        info = json.loads(spark.read.parquet(f"{path}/info").first()[0])
    except Exception as problem:
        raise ModelNotFoundError(f"no model at {path}") from problem
    reader = RandomForestClassificationModel if info["kind"] == "forest" else SoftmaxBoosterModel
    stages = [reader.load(f"{path}/stage-{i}") for i in range(info["stages"])]
    return DirectionModel(info["kind"], info["features"], stages, info["classes"], info["metadata"])


def train(
    rows: DataFrame,
    features: Sequence[str] | None = None,
    label: str = LABEL,
    kind: str = "forest",
    params: Mapping[str, Any] | None = None,
) -> DirectionModel:
    """Fit on labelled rows; ``params`` override :data:`DEFAULTS`."""
    settings = DEFAULTS | dict(params or {})
    features = list(features or feature_columns(rows, label))
    labelled = rows.where(F.col(label).isNotNull())
    if kind == "forest":
        ready = vectors(labelled, features).select(encoded(label).alias("_class"), "features")
        forest = RandomForestClassifier(
            labelCol="_class", featuresCol="features", numTrees=settings["trees"], maxDepth=settings["depth"],
            subsamplingRate=settings["row_share"], featureSubsetStrategy=str(settings["feature_share"]), seed=settings["seed"],
        )
        stages = [forest.fit(_with_classes(ready))]
    elif kind == "boosted":
        workers_import(rows.sparkSession)
        booster = SoftmaxBooster(
            featureNames=features, labelCol="_class", classCount=len(DIRECTIONS), settings=json.dumps(settings),
        )
        stages = [booster.fit(labelled.select(encoded(label).alias("_class"), *features))]
    else:
        raise ValueError("kind is 'forest' or 'boosted'")
    return DirectionModel(kind, features, stages, metadata={"label": label, "n_features": len(features), "seed": settings["seed"]})


def _with_classes(ready: DataFrame) -> DataFrame:
    """Tell the trees there are three classes even when one does not occur."""
    meta = {"ml_attr": {"type": "nominal", "name": "_class", "vals": list(DIRECTIONS)}}
    return ready.withMetadata("_class", meta)
