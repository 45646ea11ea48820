import math

import pytest
from pyspark.sql import functions as F

from tabspark.operators import scale as S


def test_standardize_mean0_sd1(spark):
    o = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    z = S.standardize(o, S.scaling_stats(o, ["o_totalprice"]))
    r = z.agg(F.avg("o_totalprice").alias("m"), F.stddev_samp("o_totalprice").alias("s")).first()
    assert abs(r["m"]) < 1e-9 and abs(r["s"] - 1.0) < 1e-9


def test_constant_column(spark):
    df = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 3.0)], "id int, c double, y double")
    st = S.collect_stats(S.scaling_stats(df, ["c", "y"]))
    assert st["c"].stddev == 0.0
    z = S.standardize(df, st).orderBy("id").collect()
    assert [r["c"] for r in z] == [0.0, 0.0]
    mm = S.minmax_scale(df, ["c", "y"]).orderBy("id").collect()
    assert [r["c"] for r in mm] == [0.0, 0.0] and [r["y"] for r in mm] == [0.0, 1.0]


def test_minmax_excludes_label(spark):
    df = spark.createDataFrame([(1.0, 10.0), (3.0, 20.0), (2.0, 30.0)], "x double, label double")
    out = S.minmax_scale(df, label="label").collect()
    assert sorted(r["x"] for r in out) == [0.0, 0.5, 1.0]
    assert sorted(r["label"] for r in out) == [10.0, 20.0, 30.0]


def test_empty_frame(spark):
    df = spark.createDataFrame([], "x double, y double")
    st = S.collect_stats(S.scaling_stats(df))
    assert st["x"].count == 0 and st["x"].mean is None
    assert S.standardize(df, st).count() == 0


def test_stats_keyed_by_name(spark):
    df = spark.createDataFrame([(1.0, 100.0), (3.0, 300.0)], "a double, b double")
    st = S.collect_stats(S.scaling_stats(df.select("b", "a")))
    assert st["a"].mean == 2.0 and st["b"].mean == 200.0
    assert math.isclose(st["a"].stddev, math.sqrt(2.0))


def test_wide_table_stats_long_path(spark):
    import numpy as np
    rng = np.random.default_rng(2)
    data = rng.normal(size=(200, 30))
    df = spark.createDataFrame([tuple(map(float, r)) for r in data], ", ".join(f"c{i} double" for i in range(30)))
    st = S.collect_stats(S.scaling_stats(df))
    assert len(st) == 30
    assert all(abs(st[f"c{i}"].mean - data[:, i].mean()) < 1e-12 for i in range(30))
    assert all(abs(st[f"c{i}"].stddev - data[:, i].std(ddof=1)) < 1e-12 for i in range(30))


def test_minmax_ignores_nan_in_the_range(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, 3.0), (4, 2.0)], "id int, x double")
    out = {r.id: r.x for r in S.minmax_scale(df, ["x"]).collect()}
    assert out[1] == 0.0 and out[3] == 1.0 and out[4] == 0.5 and math.isnan(out[2])
