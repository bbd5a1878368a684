"""Histogram boosting against a plain numpy version that keeps all rows in one place."""

import json

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from newstape.errors import DataPreparationError
from newstape.operators import boosting as B
from newstape.session import workers_import

SETTINGS = {"trees": 13, "depth": 3, "learning_rate": 0.3, "row_share": 1.0, "feature_share": 1.0, "bins": 16}


def sample(n, seed=1):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, 4))
    x[:, 1] = r.integers(0, 5, n)
    y = (x[:, 0] + 0.5 * x[:, 1] > 1).astype(int) + (x[:, 2] > 0.8)
    x[r.random((n, 4)) < 0.2] = np.nan  # the label also depends on what is missing
    y[np.isnan(x[:, 3])] = 2
    x[:3, 0] = np.inf, -np.inf, np.nan
    return x, y


def plain(x, y, cuts, s):
    """The same rounds, node by node, with every split tried one after the other."""
    bins = np.stack([np.where(np.isfinite(v), np.searchsorted(c, v, "right"), -1) for v, c in zip(x.T, cuts)], 1)
    margin = np.zeros((len(x), 3))
    unit = B.UNIT
    for _ in range(s["trees"]):
        e = np.exp(margin - margin.max(1, keepdims=True))
        p = e / e.sum(1, keepdims=True)
        step = np.zeros_like(margin)
        for c in range(3):
            g = np.rint((p[:, c] - (y == c)) * unit) / unit
            h = np.rint(np.maximum(2 * p[:, c] * (1 - p[:, c]), 1e-16) * unit) / unit
            score = lambda m: g[m].sum() ** 2 / (h[m].sum() + 1)
            def grow(mask, depth):
                best = (1e-6, None)
                for f in range(x.shape[1]) if depth else ():
                    for lost in (False, True):
                        for cut in range(s["bins"]):
                            left = mask & ((bins[:, f] <= cut) & (bins[:, f] >= 0) | (bins[:, f] < 0) & lost)
                            right = mask & ~left
                            if h[left].sum() >= 1 and h[right].sum() >= 1:
                                gain = score(left) + score(right) - score(mask)
                                if gain > best[0] + 1e-9:
                                    best = (gain, left)
                if best[1] is None:
                    step[mask, c] = -s["learning_rate"] * g[mask].sum() / (h[mask].sum() + 1)
                else:
                    grow(best[1], depth - 1)
                    grow(mask & ~best[1], depth - 1)
            grow(np.ones(len(x), bool), s["depth"])
        margin += step
    e = np.exp(margin - margin.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@pytest.fixture(scope="module")
def fitted(spark):
    workers_import(spark)
    x, y = sample(400)
    data = [(k, *[None if np.isnan(v) else float(v) for v in row], int(c)) for k, (row, c) in enumerate(zip(x, y))]
    rows = spark.createDataFrame(data, "id int, a double, b double, c double, d double, label int").repartition(4)
    booster = B.SoftmaxBooster(featureNames=["a", "b", "c", "d"], settings=json.dumps(SETTINGS))
    return x, y, rows, booster.fit(rows), booster


def test_equals_plain_numpy(fitted):
    x, y, rows, model, _ = fitted
    got = {r.id: r.probability for r in model.transform(rows).collect()}
    expected = plain(x, y, model.cuts, SETTINGS)
    assert np.abs(np.array([got[k] for k in range(len(x))]) - expected).max() < 1e-9
    assert (expected.argmax(1) == y).mean() > 0.85 and model.rounds == 13


def test_same_trees_whatever_the_blocks(spark, fitted, monkeypatch):
    _, _, rows, model, booster = fitted
    monkeypatch.setattr(B, "BLOCK", 64)
    monkeypatch.setattr(B, "quantile_cuts", lambda *_: model.cuts)  # approximate ones depend on the order of rows
    params = {booster.settings: json.dumps(SETTINGS | {"trees": 3})}
    again = booster.fit(rows.orderBy("b", "id"), params)
    assert (again.trees.feature == model.trees.feature[:9]).all() and np.allclose(again.trees.value, model.trees.value[:9], atol=1e-9)


def test_missing_values_take_a_learnt_side(spark, fitted):
    model = fitted[3]
    row = spark.createDataFrame([(0.0, 1.0, 0.0, 0.0), (0.0, 1.0, 0.0, None)], "a double, b double, c double, d double")
    here, gone = [r.probability for r in model.transform(row).collect()]
    assert gone[2] > 0.8 > here[2]


def test_pipeline_round_trip(spark, fitted, tmp_path):
    _, _, rows, model, booster = fitted
    path = str(tmp_path / "p")
    PipelineModel([model]).save(path)
    loaded = PipelineModel.load(path)
    same = loaded.transform(rows).select("id", "probability").exceptAll(model.transform(rows).select("id", "probability"))
    assert same.isEmpty() and loaded.stages[0].uid == model.uid
    Pipeline(stages=[booster]).save(str(tmp_path / "e"))
    again = Pipeline.load(str(tmp_path / "e")).getStages()[0]
    assert again.extractParamMap().keys() == booster.extractParamMap().keys()


def test_importances_and_no_rows(spark, fitted):
    _, _, rows, model, booster = fitted
    assert model.importances.sum() == pytest.approx(1.0) and (model.importances >= 0).all()
    with pytest.raises(DataPreparationError):
        booster.fit(rows.where(F.lit(False)))


def _to_driver(spark) -> int:
    """Bytes of the results of all stages so far."""
    jvm, sc = spark._jvm, spark.sparkContext
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return sum(stages.apply(i).resultSize() for i in range(stages.size()))


def test_driver_sees_splits_and_no_histograms(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 20))
    rows = spark.createDataFrame(
        [(*map(float, r), int(r[0] + r[1] * r[2] > 0)) for r in x], ", ".join(f"f{k} double" for k in range(20)) + ", y int"
    )
    workers_import(spark)
    s = B.Settings(trees=2, depth=4)
    before = _to_driver(spark)
    trees, _ = B.grow(rows, [f"f{k}" for k in range(20)], "y", 2, s)
    # a level's histograms alone would be 2 classes * 16 features * 65 bins * 16 bytes a node
    assert (trees.feature >= 0).sum() > 20 and _to_driver(spark) - before < 300_000
