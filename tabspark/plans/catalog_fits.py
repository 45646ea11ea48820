"""Checked queries of fits in closed form, stored workflows, metric lists and missing values.

A fit by full-batch steps from fixed parameters has a closed form, so its
history, its predictions and what is stored of it are compared with SQL.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import columns, encode, metrics, profile, sampling, scale, train
from ..operators.losses import Metric
from ..operators.mlp import OptimizerSpec
from ..operators.scoring import predicted_actual
from ..session import scratch_path
from ..sources import runs, tables
from . import fixed
from .catalog import SYNC_RATE, _lineitem_scaled, _orders_scored, _round, _t, query
from .workflow import load_workflow, save_workflow, score_model, train_members, train_workflow

SGD = OptimizerSpec("sgd", lr=SYNC_RATE)
KEYS = ["l_orderkey", "l_linenumber"]


def _labelled(spark, d) -> DataFrame:
    """Scaled lineitem with a second label (returned) and the return flag as a class number."""
    li = _lineitem_scaled(spark, d)
    return li.withColumns({"is_returned": (F.col("l_returnflag") == "R").cast("double"),
                           "flag": encode.string_code(F.col("l_returnflag"), fixed.FLAG_MAP)})


def _history(result: train.FitResult) -> DataFrame:
    return _round(result.history, "value")


@query("q43_two_outputs_history_lineitem")
def q43(spark, d):
    """M1, M4: two independent outputs, with metrics of both and of one."""
    start = fixed.started([fixed.TWO_OUTPUTS_W], [fixed.TWO_OUTPUTS_B], "sigmoid")
    return _history(train.fit(_labelled(spark, d), start.spec, fixed.LINE_FEATURES, ["l_linestatus", "is_returned"], epochs=2,
                              optimizer=SGD, init=start, strategy="sync", metrics=("acc", "acc[1]", "mse", "recall[0]")))


@query("q44_predicted_actual_lineitem")
def q44(spark, d):
    """Truth and score of every output."""
    model = fixed.started([fixed.TWO_OUTPUTS_W], [fixed.TWO_OUTPUTS_B], "sigmoid")
    out = predicted_actual(_labelled(spark, d), model, fixed.LINE_FEATURES, ["l_linestatus", "is_returned"], KEYS, "udf")
    return _round(out, "prediction")


@query("q45_mse_history_lineitem")
def q45(spark, d):
    """M4: mean squared error of a linear output, with the mean absolute error and R^2 as metrics."""
    start = fixed.started([fixed.GRAD_START_W], [fixed.GRAD_START_B], "linear")
    return _history(train.fit(_labelled(spark, d), start.spec, fixed.LINE_FEATURES, "l_linestatus", epochs=2,
                              optimizer=OptimizerSpec("sgd", lr=0.1), init=start, strategy="sync", loss="mean_squared_error",
                              class_weight=fixed.CLASS_WEIGHT, metrics=("mae", "r2")))


@query("q46_softmax_history_lineitem")
def q46(spark, d):
    """M1, M4: three classes by a softmax output."""
    start = fixed.started([fixed.CLASSES_W], [fixed.CLASSES_B], "softmax")
    return _history(train.fit(_labelled(spark, d), start.spec, fixed.LINE_FEATURES, "flag", epochs=2, optimizer=SGD,
                              init=start, strategy="sync", metrics=("mse",)))


@query("q47_resumed_history_lineitem")
def q47(spark, d):
    """A fit that stops after an epoch and goes on from its stored state."""
    li, start = _lineitem_scaled(spark, d), fixed.grad_start()
    state = scratch_path(spark, f"states/{uuid.uuid4().hex}")
    for epochs in (1, 2):
        result = train.fit(li, start.spec, fixed.LINE_FEATURES, "l_linestatus", epochs=epochs, optimizer=SGD, init=start,
                           class_weight=fixed.CLASS_WEIGHT, strategy="sync", checkpoint=state)
    return _history(result)


@query("q48_ensemble_history_lineitem")
def q48(spark, d):
    """Two members on balanced samples of their own, trained in the same jobs."""
    li = _lineitem_scaled(spark, d).drop("l_shipdate")
    start = fixed.grad_start()
    found = train_members(li, "l_linestatus", fixed.LINE_FEATURES, KEYS, start.spec, members=2, epochs=2, optimizer=SGD,
                          seed=fixed.SEED, inits=[start, fixed.line_scorer()], strategy="sync")
    parts = [_history(r).select(F.lit(k).alias("member"), "epoch", "metric", "value") for k, r in enumerate(found)]
    return parts[0].unionByName(parts[1])


@query("q49_hidden_l2_history_lineitem")
def q49(spark, d):
    """M2: a hidden ReLU layer with the L2 penalty on its kernel."""
    start = fixed.started([fixed.RELU_W0, fixed.RELU_W1], [fixed.RELU_B0, fixed.RELU_B1], "sigmoid", ((2, 0.0),), fixed.HIDDEN_L2)
    return _history(train.fit(_lineitem_scaled(spark, d), start.spec, fixed.LINE_FEATURES, "l_linestatus", epochs=2,
                              optimizer=SGD, init=start, strategy="sync"))


def _workflow(spark, d, epochs: int):
    drop = ["l_shipdate", "l_returnflag", "l_partkey", "l_suppkey"]
    return train_workflow(_t(spark, d, "lineitem"), "l_linestatus", drop=drop, mapping=fixed.STATUS_MAP, keys=KEYS,
                          seed=fixed.SEED, epochs=epochs, optimizer=SGD, class_weight=fixed.CLASS_WEIGHT, strategy="sync",
                          init=fixed.grad_start(), metrics=("acc", "mse"))


@query("q38b_sync_workflow_lineitem")
def q38b(spark, d):
    """M11 end to end by full-batch steps: prepare, split, scale by the training side, fit, validate, evaluate."""
    wf = _workflow(spark, d, 2)
    out = wf.fit.history.unionByName(
        wf.scores.select(F.lit(0).alias("epoch"), F.concat_ws("_", "dataset", "metric").alias("metric"), "value"))
    return _round(out, "value")


@query("q50_stored_workflow_lineitem")
def q50(spark, d):
    """A workflow stored as tables and loaded again scores raw rows."""
    path = save_workflow(spark, _workflow(spark, d, 1), scratch_path(spark, f"workflows/{uuid.uuid4().hex}"))
    return _round(load_workflow(spark, path).score(_t(spark, d, "lineitem"), KEYS), "prediction")


@query("q33c_stored_history_lineitem")
def q33c(spark, d):
    """The history of a run in its folder."""
    start = fixed.grad_start()
    result = train.fit(_lineitem_scaled(spark, d), start.spec, fixed.LINE_FEATURES, "l_linestatus", epochs=2, optimizer=SGD,
                       init=start, class_weight=fixed.CLASS_WEIGHT, strategy="sync")
    run = runs.save_run(spark, scratch_path(spark, "runs"), result)
    return _round(runs.load_history(spark, f"{run}/history"), "value")


# ---------------------------------------------------------------- scores

def _share_above_half() -> Metric:
    return Metric("share_above_half", 1, lambda y, p: np.array([float((p > 0.5).sum())]), lambda t, n: t[0] / n)


@query("q26c_pooled_score_orders")
def q26c(spark, d):
    """Pooled metrics by name and an accumulator."""
    names = ["accuracy", "f1", "mse", "mae", "log_loss", _share_above_half()]
    return _round(metrics.score(_orders_scored(spark, d), "y", "p", metrics=names), "value")


def _order_labels(spark, d):
    """Orders and the statistics of the customer key (feature) and the total price (label)."""
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return o, scale.collect_stats(scale.scaling_stats(o, ["o_custkey", "o_totalprice"]))


def worst_error(y, p):
    return float(np.max(np.abs(y - p)))


def mean_and_error(y, p):
    return np.array([np.mean(p), np.mean(np.abs(y - p))])


@query("q39b_score_regression_orders")
def q39b(spark, d):
    """A regression scored in batches against the scaled label, by names, functions and an accumulator."""
    o, stats = _order_labels(spark, d)
    model = fixed.started([fixed.ORDER_LINEAR_W], [fixed.ORDER_LINEAR_B], "linear")
    out = score_model(o, model, ["o_custkey"], "o_totalprice", stats, fixed.BATCH, ["o_orderkey"], fixed.SEED,
                      metrics=["mse", "mae", worst_error, mean_and_error, _share_above_half()], label_stats=stats["o_totalprice"])
    return _round(out, "value")


@query("q39c_score_original_units_orders")
def q39c(spark, d):
    """The same scores scaled back to the label's own units, pooled."""
    o, stats = _order_labels(spark, d)
    model = fixed.started([fixed.ORDER_LINEAR_W], [fixed.ORDER_LINEAR_B], "linear")
    out = score_model(o, model, ["o_custkey"], "o_totalprice", stats, average="pooled", metrics=["mse", "mae"],
                      label_stats=stats["o_totalprice"], units="original")
    return out.withColumn("value", F.round("value", 2))


# ---------------------------------------------------------------- missing values

def _orders_missing(spark, d, infinite: bool = False) -> DataFrame:
    """Orders with null and NaN prices (and infinite ones)."""
    price = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("double")).when(
        F.col("o_orderpriority") == "3-MEDIUM", F.lit(float("nan")))
    if infinite:
        price = price.when(F.col("o_orderstatus") == "P", F.lit(float("inf")))
    return _t(spark, d, "orders").withColumn("o_totalprice", price.otherwise(F.col("o_totalprice")))


@query("q01b_summary_customer")
def q01b(spark, d):
    """A3 with string columns."""
    return _round(profile.summary_table(_t(spark, d, "customer"), strings=True), "value")


@query("q01c_summary_missing_orders")
def q01c(spark, d):
    """A3: null and NaN are missing."""
    return _round(profile.summary_table(_orders_missing(spark, d), ["o_totalprice", "o_custkey"]), "value")


@query("q01d_summary_infinite_orders")
def q01d(spark, d):
    """A3: an infinite value is a value (its mean and deviation are no numbers and left out here)."""
    out = profile.summary_table(_orders_missing(spark, d, True), ["o_totalprice"])
    return _round(out.where(~F.col("statistic").isin("mean", "stddev")), "value")


@query("q02b_describe_missing_orders")
def q02b(spark, d):
    """A2: null and NaN are missing."""
    return _round(profile.describe_table(_orders_missing(spark, d), ["o_totalprice", "o_orderstatus"]), "value")


@query("q09c_label_profile_missing_orders")
def q09c(spark, d):
    """Null and NaN are missing."""
    out = profile.label_profile(_orders_missing(spark, d), "o_orderpriority", ["o_totalprice"])
    return _round(out, "mean", "q25", "q50", "q75")


@query("q09d_label_profile_keys_orders")
def q09d(spark, d):
    """A9 with a label per row of the table: as many groups as rows."""
    out = profile.label_profile(_t(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", ["o_totalprice"])
    return _round(out, "mean", "q25", "q50", "q75")


def _scored_missing(spark, d) -> DataFrame:
    """Scored orders without the scores of some and the labels of others."""
    s = _orders_scored(spark, d)
    return s.withColumns({"p": F.when(F.col("o_orderpriority") == "5-LOW", F.lit(float("nan"))).otherwise(F.col("p")),
                          "y": F.when(F.col("o_orderstatus") != "P", F.col("y"))})


@query("q26d_metrics_missing_orders")
def q26d(spark, d):
    """Rows without a score or a label do not count, and are counted apart."""
    s = _scored_missing(spark, d)
    return _round(metrics.score(s, "y", "p").unionByName(metrics.unscored_rows(s, "y", "p")), "value")


@query("q26e_confusion_missing_orders")
def q26e(spark, d):
    """Shares of the scored rows."""
    return _round(metrics.confusion_matrix(_scored_missing(spark, d), "y", "p"), "value")


@query("q26f_classes_lineitem")
def q26f(spark, d):
    """R3 to R6 with classes beyond 0 and 1: the tax in steps, predicted from the discount."""
    li = _t(spark, d, "lineitem").select(F.rint(F.col("l_tax") * 25).alias("y"), (F.col("l_discount") * 25).alias("p"))
    return _round(metrics.classification_metrics(li, "y", "p", classes=(0.0, 1.0, 2.0)), "value")


# ---------------------------------------------------------------- columns and tables

@query("q14c_non_numeric_part")
def q14c(spark, d):
    """P2."""
    part = _t(spark, d, "part")
    return part.select(*[F.col(f"`{c}`") for c in columns.non_numeric_columns(part)])


@query("q14d_feature_columns_part")
def q14d(spark, d):
    """Numeric columns but the label."""
    part = _t(spark, d, "part")
    return part.select(*[F.col(f"`{c}`") for c in columns.feature_columns(part, "p_size")])


@query("q00b_get_table_customer")
def q00b(spark, d):
    """S2."""
    return tables.get_table(spark, f"{d.rstrip('/')}/customer.parquet", format="parquet")


@query("q22b_take_nation")
def q22b(spark, d):
    """L2: any 100 rows, all of a table with fewer."""
    return sampling.head_rows(_t(spark, d, "nation"), 100)
