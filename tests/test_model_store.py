"""Models that are saved in one session and applied in another."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.operators import model_store as store
from tickloom.operators import models as m


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(4)
    rows = []
    for k, slope in (("A", 2.0), ("B", -1.0), (None, 0.5)):
        x = rng.normal(size=(60, 2))
        y = x @ [slope, 1.0] + 0.1 * rng.normal(size=60)
        rows += [(k, i, float(y[i]), float(x[i, 0]), float(x[i, 1])) for i in range(60)]
    rows += [("C", 0, 1.0, 1.0, 1.0), ("A", 60, None, 0.5, 0.5), ("A", 61, None, None, 0.5)]
    return spark.createDataFrame(rows, "instrument string, date int, y double, a double, b double")


def values(df):
    return sorted((str(r.instrument), r.date, r.prediction) for r in df.collect())


def test_grouped_ridge_survives_a_new_session(spark, panel, tmp_path):
    model = store.create("grouped_ridge", features=["a", "b"], target="y", alpha=0.5).fit(panel)
    before = values(model.transform(panel).where("prediction IS NOT NULL"))
    store.save_model(model, str(tmp_path), "grouped_ridge", "panel")
    other = spark.newSession()
    loaded = store.load_model(other, str(tmp_path), "grouped_ridge", "panel")
    assert loaded.uid == model.uid and loaded.getOrDefault("alpha") == 0.5 and loaded.getOrDefault("features") == ["a", "b"]
    again = other.createDataFrame(panel.collect(), panel.schema)
    assert values(loaded.transform(again).where("prediction IS NOT NULL")) == before
    assert len(before) == 181  # 60 rows of three keys (null is one) and the row without y; no fit for C, no prediction without a feature
    assert loaded.transform(again).count() == panel.count()


def test_predictions_equal_the_operator(spark, panel):
    model = store.create("grouped_ridge", features=["a", "b"], target="y", alpha=0.0, scale=True).fit(panel)
    fit = {r.instrument: r for r in m.grouped_ridge(panel, ["a", "b"], "y", alpha=0.0, scale=True).collect()}
    for r in model.transform(panel.where("instrument = 'B'")).collect():
        f = fit["B"]
        assert r.prediction == pytest.approx(f.intercept + f.coefficients[0] * r.a + f.coefficients[1] * r.b)


def test_estimator_keeps_its_parameters(spark, tmp_path):
    store.create("grouped_ridge", features=["a"], target="y", keys=["k", "l"], alpha=3.0).save(f"{tmp_path}/e")
    back = store.GroupedRidge.load(f"{tmp_path}/e")
    assert back.getOrDefault("keys") == ["k", "l"] and back.getOrDefault("alpha") == 3.0


def test_sweep_keeps_the_best_kind(spark, panel, tmp_path):
    rows = panel.where("instrument = 'A' AND y IS NOT NULL")
    model = store.create("sweep", features=["a", "b"], target="y", keys=["instrument", "date"], kinds=["linear", "random_forest"]).fit(rows)
    assert model.getOrDefault("best") == "linear" and dict(model.scores)["linear"] < dict(model.scores)["random_forest"]
    store.save_model(model, str(tmp_path), "sweep", "best")
    loaded = store.load_model(spark, str(tmp_path), "sweep", "best")
    assert loaded.scores == model.scores and loaded.getOrDefault("best") == "linear"
    assert values(loaded.transform(rows)) == values(model.transform(rows))


def test_text_model_and_overwriting(spark, tmp_path):
    texts = spark.createDataFrame([("good gain", 1.0), ("strong gain", 1.0), ("bad loss", 0.0), ("weak loss", 0.0)], "text string, label double")
    model = store.create("text", features=["text"], target="label").fit(texts)
    store.save_model(model, str(tmp_path), "text", "news")
    with pytest.raises(Exception, match="(?i)exist"):
        store.save_model(model, str(tmp_path), "text", "news")
    store.save_model(model, str(tmp_path), "text", "news", overwrite=True)
    loaded = store.load_model(spark, str(tmp_path), "text", "news")

    def scores(fitted):
        return [round(r.score, 9) for r in m.text_scores(fitted, texts, ["text"]).orderBy(F.col("text")).collect()]

    assert scores(loaded) == scores(model)


def test_unknown_names(spark):
    with pytest.raises(ValueError, match="known: grouped_ridge"):
        store.create("oracle")
