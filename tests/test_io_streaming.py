import os

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tabspark.operators import mlp as M
from tabspark.operators import scale as S
from tabspark.operators import train as T
from tabspark.sources import load_model, load_table, save_model, save_run
from tabspark.streaming import score_stream, write_available_now

CHURN_COLUMNS = [
    ("State", "string"), ("Account length", "int"), ("Area code", "int"), ("International plan", "string"),
    ("Voice mail plan", "string"), ("Number vmail messages", "int"), ("Total day minutes", "double"),
    ("Total day calls", "int"), ("Total day charge", "double"), ("Total eve minutes", "double"),
    ("Total eve calls", "int"), ("Total eve charge", "double"), ("Total night minutes", "double"),
    ("Total night calls", "int"), ("Total night charge", "double"), ("Total intl minutes", "double"),
    ("Total intl calls", "int"), ("Total intl charge", "double"), ("Customer service calls", "int"),
    ("Churn", "boolean"),
]


def _churn_csv(path, n=300, seed=0):
    rng = np.random.default_rng(seed)
    data = {}
    for name, kind in CHURN_COLUMNS:
        if name == "State":
            data[name] = rng.choice(["CA", "NY", "TX"], n)
        elif kind == "string":
            data[name] = rng.choice(["Yes", "No"], n)
        elif kind == "int":
            data[name] = rng.integers(0, 200, n)
        elif kind == "double":
            data[name] = np.round(rng.random(n) * 300, 1)
        else:
            data[name] = rng.random(n) < 0.15
    pdf = pd.DataFrame(data)
    pdf["Total day charge"] = np.round(pdf["Total day minutes"] * 0.17, 2)
    pdf["Churn"] = pdf["Churn"].map({True: "True", False: "False"})
    pdf.to_csv(path, index=False)


def test_csv_workflow_roundtrip(spark, tmp_dir):
    from tabspark.operators import profile as P
    from tabspark.plans.workflow import train_workflow
    path = os.path.join(tmp_dir, "churn.csv")
    _churn_csv(path)
    df = load_table(spark, path)
    assert dict(df.dtypes)["Churn"] == "boolean" and dict(df.dtypes)["Total day minutes"] == "double"
    corr = {(r.col_a, r.col_b): r.corr for r in P.correlation_matrix(df, ["Total day minutes", "Total day charge"]).collect()}
    assert corr[("Total day minutes", "Total day charge")] > 0.9999
    drop = ["State", "Total day charge", "Total eve charge", "Total night charge", "Total intl charge", "Area code"]
    wf = train_workflow(df.withColumn("id", F.monotonically_increasing_id()), "Churn", drop=drop, keys=["id"],
                        hidden=((8, 0.0),), epochs=3, batch_size=32, class_weight={0.0: 1.0, 1.0: 6.0}, partitions=2)
    assert len(wf.features) == 13
    scores = {(r.dataset, r.metric) for r in wf.scores.collect()}
    assert ("validation", "loss") in scores
    run = save_run(spark, os.path.join(tmp_dir, "runs"), wf.fit)
    again = load_model(spark, f"{run}/best_model")
    assert np.allclose(again.flat(), wf.fit.best_model.flat())
    assert spark.read.parquet(f"{run}/history").count() == len(wf.fit.history_rows)


def test_model_roundtrip(spark, tmp_dir):
    m = M.init_model(M.MLPSpec(4, ((3, 0.2),), 2, l2=0.1, output="linear"), 5)
    save_model(spark, m, os.path.join(tmp_dir, "m"))
    m2 = load_model(spark, os.path.join(tmp_dir, "m"))
    assert m2.spec == m.spec and np.array_equal(m2.flat(), m.flat())


def test_streaming_scoring_matches_batch(spark, tmp_dir):
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").select("o_orderkey", "o_totalprice", "o_custkey")
    src = os.path.join(tmp_dir, "src")
    orders.repartition(4).write.parquet(src)
    stats = S.collect_stats(S.scaling_stats(orders, ["o_totalprice", "o_custkey"]))
    model = M.init_model(M.MLPSpec(2, ((4, 0.0),), 1), 1)
    stream = spark.readStream.schema(orders.schema).parquet(src)
    q = write_available_now(score_stream(stream, stats, model, ["o_totalprice", "o_custkey"]),
                            os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "chk"))
    q.awaitTermination(120)
    out = spark.read.parquet(os.path.join(tmp_dir, "out"))
    batch = score_stream(orders, stats, model, ["o_totalprice", "o_custkey"])
    assert out.count() == 15000
    a = out.orderBy("o_orderkey").toPandas()["prediction"].to_numpy()
    b = batch.orderBy("o_orderkey").toPandas()["prediction"].to_numpy()
    assert np.allclose(a, b)
