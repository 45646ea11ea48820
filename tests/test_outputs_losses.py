"""Several outputs, losses, metrics, checkpoints and members of a fit."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabspark.operators import losses as L
from tabspark.operators import mlp as M
from tabspark.operators import scoring as S
from tabspark.operators import train as T

CASES = [("sigmoid", "bce"), ("sigmoid", "mse"), ("linear", "mse"), ("linear", "mae"), ("linear", "bce"),
         ("softmax", "cce"), ("softmax", "mse"), ("sigmoid", "mae")]


@pytest.mark.parametrize("output,loss", CASES)
@pytest.mark.parametrize("outputs", [2, 3])
def test_gradients_by_finite_differences(output, loss, outputs):
    rng = np.random.default_rng(1)
    model = M.init_model(M.MLPSpec(3, ((4, 0.0),), outputs, l2=0.05, output=output), 2)
    if output == "linear" and loss == "bce":
        model.weights[-1] *= 0.05
        model.biases[-1] += 0.5
    x, w = rng.normal(size=(20, 3)), rng.random(20) + 0.5
    y = np.eye(outputs)[rng.integers(0, outputs, 20)] if loss in ("cce", "bce") else rng.normal(size=(20, outputs))
    _, grad, _ = M.loss_and_grad(model, x, y, w, loss=loss)
    theta, eps = model.flat(), 1e-6
    for i in range(len(theta)):
        up, down = theta.copy(), theta.copy()
        up[i] += eps
        down[i] -= eps
        pair = [M.loss_and_grad(M.MLPModel.from_flat(model.spec, t), x, y, w, loss=loss)[0] for t in (up, down)]
        assert grad[i] == pytest.approx((pair[0] - pair[1]) / (2 * eps), rel=1e-4, abs=1e-6)


def test_specs_and_losses_that_do_not_fit():
    for bad in (dict(outputs=0), dict(output="softmax"), dict(output="tanh")):
        with pytest.raises(ValueError):
            M.MLPSpec(2, **bad)
    assert L.loss_name(None, "softmax") == "cce" and L.loss_name("mean_squared_error", "linear") == "mse"
    for loss, output in (("hinge", "linear"), ("cce", "sigmoid"), ("bce", "softmax")):
        with pytest.raises(ValueError):
            L.loss_name(loss, output)
    with pytest.raises(ValueError):
        L.resolve_metrics(["acc[2]"], "sigmoid", 2)
    with pytest.raises(ValueError):
        L.resolve_metrics(["acc", "acc"], "sigmoid", 1)


def _frame(spark, n=240, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2))
    rows = [(i, float(a), float(b), float(a > 0), float(a + b > 0.2), int(np.digitize(b, [-0.4, 0.4])))
            for i, (a, b) in enumerate(x)]
    return spark.createDataFrame(rows, "id int, a double, b double, y0 double, y1 double, c int")


def _matrix(df, *cols):
    return np.array([[r[c] for c in cols] for r in df.orderBy("id").collect()], dtype=float)


def test_two_outputs_equal_a_numpy_loop(spark):
    df = _frame(spark)
    spec = M.MLPSpec(2, ((3, 0.0),), 2, l2=0.01)
    start = M.init_model(spec, 3)
    opt = M.OptimizerSpec("sgd", lr=0.4)
    res = T.fit(df, spec, ["a", "b"], ["y0", "y1"], epochs=3, strategy="sync", init=start, optimizer=opt,
                metrics=("acc", "acc[1]", "mse", "f1[0]", "r2"))
    x, y = _matrix(df, "a", "b"), _matrix(df, "y0", "y1")
    theta, state = start.flat(), np.zeros(spec.n_params())
    got = {(e, m): v for e, m, v in res.history_rows}
    for epoch in (1, 2, 3):
        loss, grad, score = M.loss_and_grad(M.MLPModel.from_flat(spec, theta), x, y)
        hat = np.rint(score)
        tp = np.sum((hat[:, 0] == 1) & (y[:, 0] == 1))
        want = {"loss": loss, "acc": np.mean(hat == y), "acc[1]": np.mean(hat[:, 1] == y[:, 1]), "mse": np.mean((score - y) ** 2),
                "f1[0]": 2 * tp / (hat[:, 0].sum() + y[:, 0].sum()), "r2": 1 - np.sum((score - y) ** 2) / np.sum((y - y.mean()) ** 2)}
        assert {m: got[epoch, m] for m in want} == pytest.approx(want)
        theta, state = M.optimizer_step(opt, theta, grad, state, 0)
    assert res.model.flat() == pytest.approx(theta)
    arrays = df.withColumn("y", F.array("y0", "y1"))
    again = T.fit(arrays, spec, ["a", "b"], "y", epochs=3, strategy="sync", init=start, optimizer=opt)
    assert again.model.flat() == pytest.approx(theta)


def test_predict_every_output(spark):
    df = _frame(spark, 50).withColumn("a", F.when(F.col("id") == 7, None).otherwise(F.col("a")))
    for output in ("sigmoid", "linear", "softmax"):
        model = M.init_model(M.MLPSpec(2, ((4, 0.0),), 3, output=output), 5)
        want = M.predict_scores(model, np.nan_to_num(_matrix(df, "a", "b")))
        for method in ("expr", "udf"):
            got = [r["prediction"] for r in S.predict(df, model, ["a", "b"], method=method).orderBy("id").collect()]
            assert got[7] is None
            keep = [i for i in range(50) if i != 7]
            assert np.allclose([got[i] for i in keep], want[keep])
    pairs = S.predicted_actual(df, model, ["a", "b"], "c", ["id"]).orderBy("id", "output").collect()
    assert len(pairs) == 150 and pairs[21]["prediction"] is None
    assert [p["actual"] for p in pairs[:3]] == np.eye(3)[df.orderBy("id").first()["c"]].tolist()
    mean = S.ensemble_predict(df, [model, model], ["a", "b"]).orderBy("id").collect()
    assert np.allclose(mean[0]["prediction"], want[0]) and mean[7]["prediction"] is None


def test_softmax_learns_classes_and_wrong_classes_are_missing(spark):
    df = _frame(spark, 400, 1)
    spec = M.MLPSpec(2, ((8, 0.0),), 3, output="softmax")
    res = T.fit(df, spec, ["a", "b"], "c", df, epochs=6, batch_size=32, keys=["id"], seed=1, partitions=2,
                optimizer=M.OptimizerSpec("rmsprop", lr=0.02), class_weight={0.0: 1.0, 1.0: 1.5, 2.0: 1.0})
    h = {(e, m): v for e, m, v in res.history_rows}
    assert h[6, "val_loss"] < h[1, "val_loss"] and h[6, "val_acc"] > 0.85
    ev = {r["metric"]: r["value"] for r in T.evaluate(res.best_model, {"d": df}, ["a", "b"], "c", metrics=["acc", "recall[1]"]).collect()}
    assert ev["acc"] == pytest.approx(h[res.best_epoch, "val_acc"]) and ev["rows"] == 400
    with pytest.raises(Exception, match="missing value"):
        T.fit(df.withColumn("c", F.col("c") + 1), spec, ["a", "b"], "c", epochs=1, strategy="sync")


def test_own_metrics_are_summed_on_executors(spark):
    df = _frame(spark, 100)
    spec = M.MLPSpec(2, (), 1, output="linear")
    model = M.init_model(spec, 1)

    def worst(y, s):
        return np.abs(y - s)[:, 0]

    top = L.Metric("share_above", 1, lambda y, s: np.array([float((s > 0.5).sum())]), lambda t, n: t[0] / n)
    got = {r["metric"]: r["value"] for r in T.evaluate(model, {"d": df}, ["a", "b"], "y0", loss="mse", metrics=[worst, top]).collect()}
    score, y = M.predict_scores(model, _matrix(df, "a", "b")), _matrix(df, "y0")
    assert got == pytest.approx({"loss": np.mean((score - y) ** 2), "worst": np.mean(np.abs(score - y)),
                                 "share_above": np.mean(score > 0.5), "rows": 100.0})


@pytest.mark.parametrize("strategy", ["average", "sync"])
def test_resumed_fit_equals_an_uninterrupted_one(spark, tmp_dir, strategy):
    df = _frame(spark, 300, 2)
    train, val = df.where("id % 4 != 0"), df.where("id % 4 = 0")
    spec = M.MLPSpec(2, ((4, 0.2),), 1, l2=0.01)
    kw = dict(batch_size=32, keys=["id"], seed=3, partitions=2, strategy=strategy, metrics=("acc", "mse"),
              optimizer=M.OptimizerSpec("rmsprop", lr=0.02, decay=0.01))
    whole = T.fit(train, spec, ["a", "b"], "y0", val, epochs=4, **kw)
    path = f"{tmp_dir}/state"
    T.fit(train, spec, ["a", "b"], "y0", val, epochs=2, checkpoint=path, **kw)
    rest = T.fit(train, spec, ["a", "b"], "y0", val, epochs=4, checkpoint=path, **kw)
    assert rest.model.flat() == pytest.approx(whole.model.flat(), abs=1e-12)
    assert rest.best_epoch == whole.best_epoch and rest.best_model.flat() == pytest.approx(whole.best_model.flat(), abs=1e-12)
    assert [h[:2] for h in rest.history_rows] == [h[:2] for h in whole.history_rows]
    assert [h[2] for h in rest.history_rows] == pytest.approx([h[2] for h in whole.history_rows])
    assert T.best_checkpoint(spark, path, spec).flat() == pytest.approx(whole.best_model.flat(), abs=1e-12)
    with pytest.raises(ValueError, match="another fit"):
        T.fit(train, spec, ["a", "b"], "y0", val, epochs=5, checkpoint=path, **(kw | {"batch_size": 16}))
    with pytest.raises(ValueError, match="there is the state"):
        T.fit(train, spec, ["a", "b"], "y0", val, epochs=5, checkpoint=path, resume=False, **kw)


def test_state_lost_in_the_middle_of_an_epoch(spark, tmp_dir):
    """A driver that is lost while epoch 3 runs leaves the state of epoch 2, its validation still to come."""
    df = _frame(spark, 200, 4)
    spec = M.MLPSpec(2, ((3, 0.0),), 1)
    kw = dict(batch_size=32, keys=["id"], seed=3, partitions=2)
    calls = []

    def fails_later(y, s):
        return np.zeros(len(y))

    whole = T.fit(df, spec, ["a", "b"], "y0", df, epochs=4, metrics=(fails_later,), **kw)
    old = T._Member.step

    def step(self, *args):
        calls.append(1)
        if len(calls) == 3:
            raise KeyboardInterrupt
        return old(self, *args)

    T._Member.step = step
    try:
        with pytest.raises(KeyboardInterrupt):
            T.fit(df, spec, ["a", "b"], "y0", df, epochs=4, metrics=(fails_later,), checkpoint=f"{tmp_dir}/s", **kw)
    finally:
        T._Member.step = old
    rest = T.fit(df, spec, ["a", "b"], "y0", df, epochs=4, metrics=(fails_later,), checkpoint=f"{tmp_dir}/s", **kw)
    assert [h[2] for h in rest.history_rows] == pytest.approx([h[2] for h in whole.history_rows])


@pytest.mark.parametrize("strategy", ["average", "sync"])
def test_members_equal_separate_fits(spark, strategy):
    df = _frame(spark, 300, 5)
    spec = M.MLPSpec(2, ((4, 0.0),), 1)
    kw = dict(epochs=2, batch_size=32, keys=["id"], partitions=2, strategy=strategy, seed=7)
    samples = [df.where("id % 3 != 0"), df.where("id % 3 != 1")]
    both = samples[0].withColumn("k", F.lit(0)).unionByName(samples[1].withColumn("k", F.lit(1)))
    got = T.fit_members(both, "k", [7, 8], spec, ["a", "b"], "y0", df, **kw)
    for k, sample in enumerate(samples):
        one = T.fit(sample, spec, ["a", "b"], "y0", df, init=M.init_model(spec, 7 + k), **kw)
        assert got[k].model.flat() == pytest.approx(one.model.flat(), abs=1e-12)
        assert got[k].best_epoch == one.best_epoch
        assert [h[:2] for h in got[k].history_rows] == [h[:2] for h in one.history_rows]
        assert [h[2] for h in got[k].history_rows] == pytest.approx([h[2] for h in one.history_rows])
