"""Stored workflows, metric lists, missing scores, ensembles."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabspark.operators import metrics as MT
from tabspark.operators import mlp as M
from tabspark.operators.losses import Metric
from tabspark.operators.sampling import stratified_sample
from tabspark.operators.scale import collect_stats, scaling_stats
from tabspark.operators.train import fit
from tabspark.plans import load_workflow, save_workflow, score_model, train_ensemble, train_workflow
from tabspark.plans.workflow import load_workflow_history, train_members


def _raw(spark, n=400, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=n)
    rows = [(i, "Yes" if v > 0.3 else "No", float(v), None if i % 50 == 7 else float(rng.normal()), bool(v + rng.normal() * 0.2 > 0), "free text")
            for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "id long, plan string, `a b` double, c double, Churn boolean, note string")


def test_stored_workflow_scores_raw_rows(spark, tmp_dir):
    df = _raw(spark).na.drop()
    wf = train_workflow(df, "Churn", drop=["note"], keys=["id"], hidden=((6, 0.0),), epochs=2, batch_size=32, partitions=2,
                        optimizer=M.OptimizerSpec("rmsprop", lr=0.01), metrics=("acc", "f1"), checkpoint=f"{tmp_dir}/state")
    path = save_workflow(spark, wf, f"{tmp_dir}/run")
    pipe = load_workflow(spark, path)
    assert pipe.features == wf.features == ["plan", "a b", "c"] and pipe.stats == wf.stats and pipe.label == "Churn"
    assert np.array_equal(pipe.model.flat(), wf.fit.best_model.flat())
    raw = df.drop("Churn").withColumn("extra", F.lit("x"))  # rows to score have no label
    got = pipe.score(raw, ["id"]).orderBy("id").toPandas()
    want = wf.pipeline().score(df, ["id"], method="udf").orderBy("id").toPandas()
    assert np.allclose(got["prediction"], want["prediction"]) and len(got) == df.count()
    assert sorted(map(tuple, load_workflow_history(spark, path).collect())) == sorted(wf.fit.history_rows)
    again = train_workflow(df, "Churn", drop=["note"], keys=["id"], hidden=((6, 0.0),), epochs=2, batch_size=32, partitions=2,
                           optimizer=M.OptimizerSpec("rmsprop", lr=0.01), metrics=("acc", "f1"), checkpoint=f"{tmp_dir}/state")
    assert np.array_equal(again.fit.model.flat(), wf.fit.model.flat())  # all epochs were there
    with pytest.raises(ValueError, match="no columns"):
        pipe.score(raw.drop("c"), ["id"]).count()
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        save_workflow(spark, wf, path)
    spark.createDataFrame([("format", "99")], "name string, value string").write.mode("overwrite").parquet(f"{path}/steps")
    with pytest.raises(ValueError, match="format 99"):
        load_workflow(spark, path)


def test_workflow_drops_missing_rows(spark):
    df = _raw(spark, 200, 1)
    kw = dict(drop=["note"], keys=["id"], hidden=(), epochs=1, strategy="sync", optimizer=M.OptimizerSpec("sgd", lr=0.1))
    with pytest.raises(Exception, match="missing value"):
        train_workflow(df, "Churn", **kw)
    one = train_workflow(df, "Churn", nulls="drop", **kw)
    two = train_workflow(df.na.drop(), "Churn", **kw)
    assert np.allclose(one.fit.model.flat(), two.fit.model.flat())


def _scored(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"y": (rng.random(120) < 0.4).astype(float), "p": rng.random(120), "batch_id": np.arange(120) % 5})
    rows = [(None if i % 11 == 0 else float(r.y), float("nan") if i % 13 == 0 else None if i % 17 == 0 else float(r.p), int(r.batch_id))
            for i, r in enumerate(pdf.itertuples())] + [(1.0, None, 9)]  # batch 9 has no score at all
    whole = pdf[[i % 11 != 0 and i % 13 != 0 and i % 17 != 0 for i in range(120)]]
    return spark.createDataFrame(rows, "y double, p double, batch_id int"), whole


def test_unscored_rows_do_not_count(spark):
    df, whole = _scored(spark)
    clean = spark.createDataFrame(whole)
    for average in ("pooled", "batch"):
        got = {(r.metric, r["class"]): r.value for r in MT.score(df, "y", "p", average).collect()}
        want = {(r.metric, r["class"]): r.value for r in MT.score(clean, "y", "p", average).collect()}
        assert got == pytest.approx(want) and ("mse", None) in got and len(got) == 8
    assert MT.unscored_rows(df, "y", "p").first()["value"] == 121 - len(whole)
    cells = MT.confusion_matrix(df, "y", "p").toPandas()["value"]
    assert cells.sum() == pytest.approx(1.0)
    assert MT.regression_metrics(df, "y", "p").first()["value"] == pytest.approx(((whole.p - whole.y) ** 2).mean())


def test_metric_lists(spark):
    df, whole = _scored(spark)

    def spread(y, p):
        return float(np.max(p) - np.min(p))

    def per_class(y, p):
        return np.array([np.mean(y == c) for c in (0, 1)])

    top = Metric("top", 2, lambda y, p: np.array([p.sum(), (p > 0.5).sum()]), lambda t, n: t[0] / n + t[1])
    got = {(r.metric, r["class"]): r.value for r in MT.score(df, "y", "p", "batch", metrics=["mae", spread, per_class, top]).collect()}
    by = whole.groupby("batch_id")
    assert got == pytest.approx({
        ("mae", None): by.apply(lambda g: np.mean(np.abs(g.p - g.y))).mean(), ("spread", None): by.apply(lambda g: spread(g.y, g.p)).mean(),
        ("per_class", 0.0): by.apply(lambda g: np.mean(g.y == 0)).mean(), ("per_class", 1.0): by.apply(lambda g: np.mean(g.y == 1)).mean(),
        ("top", None): by.apply(lambda g: g.p.mean() + (g.p > 0.5).sum()).mean()})
    pooled = {r.metric: r.value for r in MT.score(df, "y", "p", metrics=["log_loss", top]).collect()}
    assert pooled["top"] == pytest.approx(whole.p.mean() + (whole.p > 0.5).sum())
    with pytest.raises(ValueError, match="averaged over batches"):
        MT.score(df, "y", "p", metrics=[spread])
    with pytest.raises(ValueError, match="unknown metrics"):
        MT.score(df, "y", "p", metrics=["auc"])


def test_classes_beyond_one(spark):
    df = spark.createDataFrame([(2.0, 2.2), (1.0, 0.9), (0.0, -3.0), (2.0, 1.4)], "y double, p double")
    got = {(r.metric, r["class"]): r.value for r in MT.classification_metrics(df, "y", "p", classes=(0.0, 1.0, 2.0)).collect()}
    assert got["accuracy", None] == 0.75 and got["recall", 2.0] == 0.5 and got["precision", 1.0] == 0.5


def test_label_scaling(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"id": np.arange(200), "x": rng.normal(size=200)})
    pdf["y"] = 50 + 10 * pdf["x"] + rng.normal(size=200)
    df = spark.createDataFrame(pdf)
    stats = collect_stats(scaling_stats(df, ["x", "y"]))
    model = M.MLPModel(M.MLPSpec(1, output="linear"), [np.array([[0.9]])], [np.array([0.0])])
    z = lambda c: (pdf[c] - pdf[c].mean()) / pdf[c].std()
    kw = dict(stats=stats, average="pooled", metrics=["mse"], label_stats=stats["y"])
    scaled = score_model(df, model, ["x"], "y", **kw).first()["value"]
    original = score_model(df, model, ["x"], "y", units="original", **kw).first()["value"]
    assert scaled == pytest.approx(((0.9 * z("x") - z("y")) ** 2).mean())
    assert original == pytest.approx(scaled * pdf["y"].var())
    batches = score_model(df, model, ["x"], "y", stats, keys=["id"], n_batches=4, metrics=["mse"], label_stats=stats["y"])
    assert batches.first()["value"] == pytest.approx(scaled)  # four batches of one size


def test_ensemble_members_equal_their_own_fits(spark):
    df = _raw(spark, 300, 3).na.drop().select("id", F.col("a b").alias("a"), "c", F.col("Churn").cast("double").alias("y"))
    spec = M.MLPSpec(2, ((3, 0.0),), 1)
    kw = dict(epochs=2, batch_size=16, partitions=2)
    found = train_members(df, "y", ["a", "c"], ["id"], spec, members=2, seed=5, val=df, **kw)
    for k, result in enumerate(found):
        sample = stratified_sample(df, "y", ["id"], seed=5 + k)
        alone = fit(sample, spec, ["a", "c"], "y", df, keys=["id"], seed=5, init=M.init_model(spec, 5 + k),
                    optimizer=M.OptimizerSpec(), **kw)
        assert result.model.flat() == pytest.approx(alone.model.flat(), abs=1e-12)
        assert [h[2] for h in result.history_rows] == pytest.approx([h[2] for h in alone.history_rows])
    models = train_ensemble(df, "y", ["a", "c"], ["id"], spec, 2, seed=5, val=df, **kw)
    assert [m.flat().tolist() for m in models] == [pytest.approx(r.best_model.flat().tolist()) for r in found]
