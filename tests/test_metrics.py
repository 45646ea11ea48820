import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tabspark.operators import metrics as MT


def _df(spark, y, p, batch=None):
    pdf = pd.DataFrame({"y": np.asarray(y, float), "p": np.asarray(p, float)})
    pdf["batch_id"] = batch if batch is not None else 0
    return spark.createDataFrame(pdf)


def test_pooled_metrics_brute_force(spark):
    rng = np.random.default_rng(0)
    y = (rng.random(500) < 0.3).astype(float)
    p = np.clip(y * 0.4 + rng.random(500) * 0.7, 0, 1)
    got = {(r.metric, r["class"]): r.value for r in MT.classification_metrics(_df(spark, y, p), "y", "p").collect()}
    yhat = np.rint(p)
    assert abs(got[("accuracy", None)] - np.mean(yhat == y)) < 1e-12
    for c in (0.0, 1.0):
        tp = np.sum((yhat == c) & (y == c))
        prec, rec = tp / np.sum(yhat == c), tp / np.sum(y == c)
        assert abs(got[("precision", c)] - prec) < 1e-12
        assert abs(got[("recall", c)] - rec) < 1e-12
        assert abs(got[("f1", c)] - 2 * prec * rec / (prec + rec)) < 1e-12
    cm = MT.confusion_matrix(_df(spark, y, p), "y", "p").toPandas()
    assert abs(cm["value"].sum() - 1.0) < 1e-12 and len(cm) == 4


def test_single_class_zero_fill(spark):
    got = {(r.metric, r["class"]): r.value for r in MT.classification_metrics(_df(spark, [0, 0, 0], [0.1, 0.2, 0.9]), "y", "p").collect()}
    assert got[("precision", 1.0)] == 0.0 and got[("recall", 1.0)] == 0.0 and got[("f1", 1.0)] == 0.0


def test_batch_average_with_missing_class(spark):
    df = _df(spark, [1, 0, 0, 0], [0.9, 0.1, 0.2, 0.7], batch=[0, 0, 1, 1])
    got = {(r.metric, r["class"]): r.value for r in MT.batch_metrics(df, "y", "p").collect()}
    # batch 0: acc 1, precision1 1; batch 1: acc 0.5, precision1 0 (no true class 1)
    assert got[("accuracy", None)] == 0.75
    assert got[("precision", 1.0)] == 0.5
    assert len(got) == 8


def test_custom_metric_and_losses(spark):
    df = _df(spark, [1, 0, 1, 0], [0.8, 0.4, 0.6, 0.0], batch=[0, 0, 1, 1])
    mae = MT.custom_metric(df, "y", "p", lambda a, b: np.mean(np.abs(a - b)), name="mae").first()
    assert abs(mae.value - np.mean([0.3, 0.2])) < 1e-12
    ll = MT.log_loss(df, "y", "p").first()[0]
    q = np.clip([0.8, 0.4, 0.6, 0.0], 1e-7, 1 - 1e-7)
    yy = np.array([1, 0, 1, 0])
    assert abs(ll - np.mean(-(yy * np.log(q) + (1 - yy) * np.log(1 - q)))) < 1e-12
    rm = {r.metric: r.value for r in MT.regression_metrics(df, "y", "p").collect()}
    assert abs(rm["mse"] - np.mean((np.array([0.8, 0.4, 0.6, 0.0]) - yy) ** 2)) < 1e-12


def test_score_model_batch_and_pooled(spark):
    from tabspark.operators import mlp as M
    from tabspark.plans import score_model
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"id": np.arange(640), "a": rng.normal(size=640), "b": rng.normal(size=640)})
    pdf["y"] = (pdf["a"] + 0.3 * rng.normal(size=640) > 0).astype(float)
    df = spark.createDataFrame(pdf)
    model = M.MLPModel(M.MLPSpec(2), [np.array([[3.0], [0.0]])], [np.array([0.0])])
    pooled = {(r.metric, r["class"]): r.value for r in score_model(df, model, ["a", "b"], "y", average="pooled").collect()}
    exp = np.mean(np.rint(1 / (1 + np.exp(-3 * pdf["a"]))) == pdf["y"])
    assert abs(pooled[("accuracy", None)] - exp) < 1e-12
    batch = {(r.metric, r["class"]): r.value for r in score_model(df, model, ["a", "b"], "y", batch_size=32, keys=["id"]).collect()}
    assert abs(batch[("accuracy", None)] - exp) < 0.02


def test_null_score_and_null_feature_stay_missing(spark):
    from tabspark.functions.numeric import bce, clip01, predicted_class
    from tabspark.operators import mlp as M
    from tabspark.operators import scoring as PR
    df = spark.createDataFrame([(1.0, 0.7), (0.0, None)], "y double, p double")
    r = df.select(clip01(F.col("p")).alias("c"), predicted_class(F.col("p")).alias("k"),
                  bce(F.col("y"), F.col("p")).alias("l")).collect()
    assert r[1]["c"] is None and r[1]["k"] is None and r[1]["l"] is None
    assert r[0]["k"] == 1.0
    model = M.init_model(M.MLPSpec(2, ((3, 0.0),), 1), 7)
    feats = spark.createDataFrame([(0, 1.0, 2.0), (1, None, 2.0)], "id int, a double, b double")
    out = PR.predict(feats, model, ["a", "b"], "s", method="expr").orderBy("id").collect()
    assert out[0]["s"] is not None and out[1]["s"] is None
