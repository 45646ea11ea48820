"""The `empty` fixture (FIXTURES.md §4): churn-shaped schema, zero rows."""

import pytest

from tabspark.operators import batches as B
from tabspark.operators import categories as CT
from tabspark.operators import encode as E
from tabspark.operators import metrics as MT
from tabspark.operators import profile as P
from tabspark.operators import sampling as S

SCHEMA = ("id bigint, `State` string, `Account length` int, `International plan` string, "
          "`Total day minutes` double, `Total day charge` double, `Churn` boolean")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_profiles_of_empty_input(spark, empty):
    assert P.row_count(empty).first()["rows"] == 0
    assert P.summary_table(empty).count() == 0
    assert P.describe_table(empty).count() >= 0
    assert P.unique_values(empty, "State").count() == 0
    assert P.size_estimate(empty).first()["rows"] == 0
    assert P.class_balance(empty, "Churn").count() == 0
    h = P.histogram(empty, ["Total day minutes"], bins=4).collect()
    assert sum(r["count"] for r in h) == 0
    assert P.correlation_matrix(empty, ["Total day minutes", "Total day charge"]).count() >= 0
    assert all(r["nulls"] == 0 for r in P.null_profile(empty).collect())


def test_row_operators_of_empty_input(spark, empty):
    prepared = E.prepare(empty, drop=["State"])
    assert prepared.count() == 0 and "State" not in prepared.columns
    train, val = S.hash_split(empty, ["id"])
    assert train.count() == 0 and val.count() == 0
    assert S.hash_sample(empty, ["id"], 0.5).count() == 0
    assert S.stratified_sample(empty, "Churn", ["id"]).count() == 0
    assert CT.index_categories(empty, "State").count() == 0


def test_batches_and_metrics_of_empty_input(spark, empty):
    out, nb = B.assign_batches_counted(empty, 256, ["id"])
    assert out.count() == 0 and nb == 1
    scored = empty.selectExpr("CAST(`Churn` AS DOUBLE) AS y", "0.3 AS p")
    m = {(r["metric"], r["class"]): r["value"] for r in MT.classification_metrics(scored, "y", "p").collect()}
    assert m[("accuracy", None)] is None or m[("accuracy", None)] == 0.0


def test_fit_on_empty_input_raises(spark, empty):
    from tabspark.operators import mlp as M
    from tabspark.operators import train as T
    spec = M.MLPSpec(2, ((2, 0.0),), 1)
    for strategy in ("average", "sync"):
        with pytest.raises(ValueError, match="empty training frame"):
            T.fit(empty, spec, ["Total day minutes", "Total day charge"], "Churn", epochs=1,
                  keys=["id"], strategy=strategy)
