import pytest
from pyspark.sql import functions as F

from tabspark.operators import encode as E


@pytest.fixture()
def unknown_category(spark):
    return spark.createDataFrame([(1, "Yes"), (2, "No"), (3, "maybe"), (4, None)], "id int, plan string")


def test_unknown_to_null(spark, unknown_category):
    out = {r["id"]: r["plan"] for r in E.encode_strings(unknown_category).collect()}
    assert out == {1: 1.0, 2: 0.0, 3: None, 4: None}
    counts = {r["column_name"]: r["unknown"] for r in E.unknown_counts(unknown_category, ["plan"], E.DEFAULT_STRING_MAP).collect()}
    assert counts == {"plan": 1}


def test_unknown_raise(spark, unknown_category):
    with pytest.raises(Exception, match="unknown category"):
        E.encode_strings(unknown_category, unknown="raise").collect()
    ok = unknown_category.where(F.col("plan") != "maybe")
    assert E.encode_strings(ok, unknown="raise").count() == 2


def test_int_map_still_double(spark, unknown_category):
    # The reference's int-valued map gave null for every row; here it casts.
    out = E.encode_strings(unknown_category, mapping={"Yes": 1, "No": 0})
    assert dict(out.dtypes)["plan"] == "double"
    assert sorted(r["plan"] for r in out.collect() if r["plan"] is not None) == [0.0, 1.0]


def test_booleans_and_prepare(spark):
    df = spark.createDataFrame([("CA", "Yes", True, 1.0), ("NY", "No", False, 2.0)],
                               "State string, `International plan` string, Churn boolean, x double")
    out = E.prepare(df, drop=["State"])
    assert out.dtypes == [("International plan", "double"), ("Churn", "double"), ("x", "double")]
    assert [tuple(r) for r in out.orderBy("x").collect()] == [(1.0, 1.0, 1.0), (0.0, 0.0, 2.0)]


def test_prepare_is_one_projection(spark):
    df = spark.createDataFrame([("a", "Yes", True)], "s string, p string, b boolean")
    plan = E.prepare(df, drop=["s"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") == 1
