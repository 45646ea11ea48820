import pytest
from pyspark.sql import functions as F

from tabspark.operators import columns as C


@pytest.fixture()
def method_names(spark):
    # Column names that are also DataFrame methods.
    return spark.createDataFrame([(1, "a", 2.0), (2, "b", 3.0)], "count int, schema string, x double")


def test_numeric_listing(spark):
    df = spark.createDataFrame([(1, 2, 1.5, 2.5, "s", True)],
                               "a int, b bigint, c double, d float, e string, f boolean")
    assert C.numeric_columns(df) == ["a", "b", "c", "d"]
    assert C.numeric_columns(df, strict=True) == ["a", "c"]
    assert C.non_numeric_columns(df) == ["e", "f"]
    assert C.column_dtype(df, "b") == "bigint"
    with pytest.warns(UserWarning):
        assert C.column_dtype(df, "zz") is None
    assert C.columns_of_type(df, "string") == ["e"]


def test_method_named_columns_are_columns(spark, method_names):
    out = C.modify_columns(method_names, [("count", F.col("count") * 10)])
    assert out.columns == ["count", "schema", "x"]
    assert sorted(r["count"] for r in out.collect()) == [10, 20]
    with pytest.warns(UserWarning):
        same = C.modify_columns(method_names, [("collect", F.lit(1))])
    assert same.columns == method_names.columns
    assert C.drop_columns(method_names, ["schema"]).columns == ["count", "x"]


def test_missing_column_raise(spark, method_names):
    with pytest.raises(KeyError):
        C.drop_columns(method_names, ["nope"], errors="raise")
    with pytest.raises(KeyError):
        C.rename_columns(method_names, [("nope", "x2")], errors="raise")


def test_rename_chain_and_swap(spark):
    df = spark.createDataFrame([(1, 2)], "a int, z int")
    assert C.rename_columns(df, [("a", "b"), ("b", "c")]).columns == ["c", "z"]
    with pytest.raises(ValueError):
        C.rename_columns(df, [("a", "z"), ("z", "a")])


def test_modify_sees_earlier_results_by_name(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    out = C.modify_columns(df, [("a", F.col("a") + 1), ("b", F.col("a") * 10)]).first()
    assert (out["a"], out["b"]) == (2.0, 20.0)


def test_feature_columns_exact_label(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0)], "`Churn rate` double, x double, Churn double")
    assert C.feature_columns(df, "Churn") == ["Churn rate", "x"]


def test_dtype_profile_counts_values_on_both_paths(spark, monkeypatch):
    df = spark.createDataFrame([(1, None, "a"), (2, 2.5, None), (3, 1.0, "c")], "k int, v double, s string")
    exp = [("k", "int", True, 3), ("v", "double", True, 2), ("s", "string", False, 2)]
    assert sorted(tuple(r) for r in C.dtype_profile(df).collect()) == sorted(exp)
    monkeypatch.setattr(C, "WIDE_MAX_COLUMNS", 0)
    assert sorted(tuple(r) for r in C.dtype_profile(df).collect()) == sorted(exp)
    assert sorted(r["non_null"] for r in C.dtype_profile(df.limit(0)).collect()) == [0, 0, 0]
