import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabspark.operators import batches as B
from tabspark.operators import mlp as M
from tabspark.operators import scoring as PR
from tabspark.operators import train as T


def _numeric_grad(model, x, y, w, eps=1e-6):
    theta = model.flat()
    g = np.zeros_like(theta)
    for i in range(len(theta)):
        for s in (1, -1):
            t = theta.copy()
            t[i] += s * eps
            loss, _, _ = M.loss_and_grad(M.MLPModel.from_flat(model.spec, t), x, y, w)
            g[i] += s * loss / (2 * eps)
    return g


@pytest.mark.parametrize("output", ["sigmoid", "linear"])
def test_gradient_check(output):
    rng = np.random.default_rng(1)
    spec = M.MLPSpec(3, ((4, 0.0), (3, 0.0)), 1, l2=0.05, output=output)
    model = M.init_model(spec, seed=2)
    if output == "linear":  # keep scores inside (0, 1) where the clip is smooth
        model.weights[-1] *= 0.05
        model.biases[-1] += 0.5
    x = rng.normal(size=(20, 3))
    y = (rng.random(20) < 0.4).astype(float)
    w = np.where(y == 1, 3.0, 1.0)
    _, grad, _ = M.loss_and_grad(model, x, y, w)
    assert np.allclose(grad, _numeric_grad(model, x, y, w), rtol=1e-5, atol=1e-7)


def test_optimizer_rules():
    theta, g = np.array([1.0, -1.0]), np.array([0.5, 0.25])
    t, s = M.optimizer_step(M.OptimizerSpec("sgd", lr=0.1, momentum=0.9), theta, g, np.zeros(2), 0)
    assert np.allclose(t, theta - 0.1 * g) and np.allclose(s, -0.1 * g)
    t, s = M.optimizer_step(M.OptimizerSpec("rmsprop", lr=0.01), theta, g, np.zeros(2), 0)
    assert np.allclose(s, 0.1 * g * g) and np.allclose(t, theta - 0.01 * g / (np.sqrt(s) + 1e-8))
    t, s = M.optimizer_step(M.OptimizerSpec("adagrad", lr=0.01, decay=1.0), theta, g, np.zeros(2), 1)
    assert np.allclose(t, theta - 0.005 * g / (np.sqrt(g * g) + 1e-8))
    with pytest.raises(ValueError):
        M.OptimizerSpec("adam")


def _two_moons(n=600, seed=0):
    rng = np.random.default_rng(seed)
    t = rng.random(n) * np.pi
    lab = rng.random(n) < 0.5
    x1 = np.where(lab, 1 - np.cos(t), np.cos(t)) + rng.normal(0, 0.1, n)
    x2 = np.where(lab, 0.5 - np.sin(t), np.sin(t)) + rng.normal(0, 0.1, n)
    return pd.DataFrame({"id": np.arange(n), "x1": x1, "x2": x2, "y": lab.astype(float)})


def test_one_partition_fit_equals_numpy_loop(spark):
    pdf = _two_moons(200)
    df = spark.createDataFrame(pdf)
    spec = M.MLPSpec(2, ((5, 0.0),), 1, l2=0.01)
    opt = M.OptimizerSpec("rmsprop", lr=0.01)
    res = T.fit(df, spec, ["x1", "x2"], "y", epochs=2, batch_size=32, optimizer=opt,
                class_weight={0.0: 1.0, 1.0: 2.0}, keys=["id"], seed=4, partitions=1)
    b = B.assign_batches(df, 32, ["id"], seed=4, partitions=1).toPandas().sort_values(["batch_id", "batch_pos"])
    model = M.init_model(spec, 4)
    theta, state, it = model.flat(), np.zeros(spec.n_params()), 0
    for _ in range(2):
        for _, g in b.groupby("batch_id", sort=True):
            x, y = g[["x1", "x2"]].to_numpy(), g["y"].to_numpy()
            w = np.where(y == 1.0, 2.0, 1.0)
            _, grad, _ = M.loss_and_grad(M.MLPModel.from_flat(spec, theta), x, y, w)
            theta, state = M.optimizer_step(opt, theta, grad, state, it)
            it += 1
    assert np.allclose(res.model.flat(), theta, atol=1e-10)


def test_fit_reduces_loss_and_keeps_best(spark):
    df = spark.createDataFrame(_two_moons(800, 1))
    train, val = df.where(F.col("id") % 5 != 0), df.where(F.col("id") % 5 == 0)
    spec = M.MLPSpec(2, ((16, 0.0), (16, 0.1)), 1)
    res = T.fit(train, spec, ["x1", "x2"], "y", val, epochs=8, batch_size=32,
                optimizer=M.OptimizerSpec("rmsprop", lr=0.01), keys=["id"], seed=0, partitions=4)
    h = pd.DataFrame(res.history_rows, columns=["epoch", "metric", "value"])
    loss = h[h.metric == "loss"].sort_values("epoch")["value"].to_numpy()
    val_loss = h[h.metric == "val_loss"].sort_values("epoch")["value"].to_numpy()
    assert loss[-1] < loss[0] and val_loss.min() < val_loss[0]
    assert res.best_epoch == int(np.argmin(val_loss)) + 1
    ev = {(r.dataset, r.metric): r.value for r in T.evaluate(res.best_model, {"val": val}, ["x1", "x2"], "y").collect()}
    assert abs(ev[("val", "loss")] - val_loss.min()) < 1e-9
    assert ev[("val", "acc")] > 0.75


def test_sync_strategy_and_gradient(spark):
    df = spark.createDataFrame(_two_moons(300, 2))
    spec = M.MLPSpec(2, (), 1)
    model = M.init_model(spec, 0)
    g = T.sync_gradient(df, model, ["x1", "x2"], "y").orderBy("layer", "kind", "row").toPandas()
    pdf = df.toPandas()
    _, grad, _ = M.loss_and_grad(model, pdf[["x1", "x2"]].to_numpy(), pdf["y"].to_numpy())
    assert np.allclose(sorted(g["gradient"]), sorted(grad))
    res = T.fit(df, spec, ["x1", "x2"], "y", epochs=5, strategy="sync",
                optimizer=M.OptimizerSpec("sgd", lr=0.5))
    losses = [v for _, m, v in res.history_rows if m == "loss"]
    assert losses[-1] < losses[0]


def test_predict_expr_equals_udf(spark):
    df = spark.createDataFrame(_two_moons(100, 3))
    model = M.init_model(M.MLPSpec(2, ((3, 0.0),), 1), 7)
    a = PR.predict(df, model, ["x1", "x2"], "p", method="expr").orderBy("id").toPandas()["p"]
    b = PR.predict(df, model, ["x1", "x2"], "p", method="udf").orderBy("id").toPandas()["p"]
    assert np.allclose(a, b, atol=1e-12)
    e = PR.ensemble_predict(df, [model, model], ["x1", "x2"], "p").orderBy("id").toPandas()["p"]
    assert np.allclose(a, e)


def test_fit_independent_of_arrow_chunking(spark):
    df = spark.createDataFrame(_two_moons(300, 5))
    spec = M.MLPSpec(2, ((4, 0.0),), 1)
    kw = dict(epochs=2, batch_size=32, keys=["id"], seed=1, partitions=2)
    ref = T.fit(df, spec, ["x1", "x2"], "y", **kw).model.flat()
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "7")  # every 32-row batch is cut across Arrow chunks
    try:
        small = T.fit(df, spec, ["x1", "x2"], "y", **kw).model.flat()
    finally:
        spark.conf.set(key, old)
    assert np.allclose(ref, small, atol=1e-12)


def test_feature_matrix_and_null_vectors(spark):
    import pyarrow as pa

    arr = pa.array([[1.0, 2.0], [3.0, None], [5.0, 6.0], [7.0, 8.0]], pa.list_(pa.float64()))
    m = PR.feature_matrix(arr.slice(1, 2))
    assert m.shape == (2, 2) and np.isnan(m[0, 1]) and m[1, 0] == 5.0
    with pytest.raises(ValueError, match="different lengths"):
        PR.feature_matrix(pa.array([[1.0], [1.0, 2.0]], pa.list_(pa.float64())))
    with pytest.raises(ValueError, match="null"):
        PR.feature_matrix(pa.array([[1.0], None], pa.list_(pa.float64())))
    model = M.init_model(M.MLPSpec(2, ((3, 0.0),), 1), 7)
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, None), (2, [0.5, -1.0])], "id int, v array<double>")
    got = PR.predict(df, model, "v", "p", method="udf").orderBy("id").toPandas()["p"]
    assert got.isna().tolist() == [False, True, False]
    exp = M.predict_scores(model, np.array([[1.0, 2.0], [0.5, -1.0]]))[:, 0]
    assert np.allclose(got.dropna().to_numpy(), exp)


def test_fit_missing_values_raise_or_drop(spark):
    pdf = _two_moons(200, 6)
    pdf.loc[pdf.index[5], "x1"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("x2", F.when(F.col("id") == 9, None).otherwise(F.col("x2")))
    spec = M.MLPSpec(2, ((3, 0.0),), 1)
    kw = dict(epochs=1, batch_size=16, keys=["id"], seed=2, partitions=1)
    with pytest.raises(Exception, match="missing value"):
        T.fit(df, spec, ["x1", "x2"], "y", **kw)
    dropped = T.fit(df, spec, ["x1", "x2"], "y", nulls="drop", **kw).model.flat()
    clean = df.where(~F.col("id").isin(int(pdf["id"].iloc[5]), 9))
    assert clean.count() == 198
    assert np.allclose(dropped, T.fit(clean, spec, ["x1", "x2"], "y", **kw).model.flat(), atol=1e-12)


def test_batches_and_fit_independent_of_input_layout(spark):
    df = spark.createDataFrame(_two_moons(400, 8))
    shuffled = df.repartition(7, "x1")
    a = B.assign_batches(df, 32, ["id"], seed=5).select("id", "batch_id", "batch_pos").toPandas()
    b = B.assign_batches(shuffled, 32, ["id"], seed=5).select("id", "batch_id", "batch_pos").toPandas()
    assert a.sort_values("id").reset_index(drop=True).equals(b.sort_values("id").reset_index(drop=True))
    spec = M.MLPSpec(2, ((4, 0.1),), 1)
    kw = dict(epochs=2, batch_size=32, keys=["id"], seed=5, partitions=3)
    one = T.fit(df, spec, ["x1", "x2"], "y", **kw).model.flat()
    two = T.fit(shuffled, spec, ["x1", "x2"], "y", **kw).model.flat()
    assert np.allclose(one, two, rtol=0, atol=1e-12)


def test_sync_strategy_with_validation_records_each_epoch(spark):
    df = spark.createDataFrame(_two_moons(300, 4))
    train, val = df.where(F.col("id") % 4 != 0), df.where(F.col("id") % 4 == 0)
    spec = M.MLPSpec(2, ((3, 0.0),), 1, l2=0.01)
    init = M.init_model(spec, 3)
    res = T.fit(train, spec, ["x1", "x2"], "y", val, epochs=3, strategy="sync", init=init,
                optimizer=M.OptimizerSpec("sgd", lr=0.5))
    h = pd.DataFrame(res.history_rows, columns=["epoch", "metric", "value"])
    assert list(h["metric"]) == ["loss", "acc", "val_loss", "val_acc"] * 3
    val_loss = h[h.metric == "val_loss"]["value"].to_numpy()
    assert res.best_epoch == int(np.argmin(val_loss)) + 1
    ev = {(r.dataset, r.metric): r.value for r in T.evaluate(res.best_model, {"v": val}, ["x1", "x2"], "y").collect()}
    assert abs(ev[("v", "loss")] - val_loss.min()) < 1e-9
    ev0 = {(r.dataset, r.metric): r.value for r in T.evaluate(init, {"t": train}, ["x1", "x2"], "y").collect()}
    assert abs(h[(h.epoch == 1) & (h.metric == "acc")]["value"].iloc[0] - ev0[("t", "acc")]) < 1e-12
