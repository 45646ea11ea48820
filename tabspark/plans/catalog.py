"""The checked query set: one Spark plan per operator, over the driver's tables.

Every query reads whole tables (or frames Spark derives from them).  Float
outputs are rounded to 6 places, the same as in the SQL oracle
(``oracle.py``), so that the two engines' last-bit differences do not count.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import predicted_class, round6
from ..operators import batches, categories, columns, encode, metrics, profile, sampling, scale, train
from ..operators.scoring import ensemble_predict, predict as score_rows
from ..operators.mlp import MLPSpec, OptimizerSpec, init_model
from ..session import ensure_checkpoint_dir, scratch_path
from ..sources import runs
from ..sources.tables import read_parquet_table
from . import fixed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet_table(spark, sf_dir, name)


def _round(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: round6(F.col(c)) for c in cols})


# ---------------------------------------------------------------- profiling

@query("q00_row_count_lineitem")
def q00(spark, d):
    return profile.row_count(_t(spark, d, "lineitem"))


@query("q01_summary_lineitem")
def q01(spark, d):
    return _round(profile.summary_table(_t(spark, d, "lineitem")), "value")


@query("q02_describe_customer")
def q02(spark, d):
    return _round(profile.describe_table(_t(spark, d, "customer")), "value")


@query("q03_unique_orderpriority")
def q03(spark, d):
    return profile.unique_values(_t(spark, d, "orders"), "o_orderpriority")


@query("q04a_size_documents")
def q04a(spark, d):
    return _round(profile.size_estimate(_t(spark, d, "documents")), "bytes_per_row")


@query("q04b_size_customer")
def q04b(spark, d):
    return _round(profile.size_estimate(_t(spark, d, "customer")), "bytes_per_row")


@query("q05_scaling_lineitem")
def q05(spark, d):
    li = _t(spark, d, "lineitem")
    return _round(scale.scaling_stats(li, columns.numeric_columns(li)), "count", "mean", "stddev", "min", "max")


@query("q06_histogram_lineitem")
def q06(spark, d):
    h = profile.histogram(_t(spark, d, "lineitem"), ["l_extendedprice", "l_quantity"], bins=10)
    return _round(h, "lower", "upper")


@query("q07_correlation_lineitem")
def q07(spark, d):
    return _round(profile.correlation_matrix(_t(spark, d, "lineitem")), "corr")


@query("q08_scatter_pairs_lineitem")
def q08(spark, d):
    return profile.scatter_pairs(_t(spark, d, "lineitem"), fixed.LINE_FEATURES, ["l_partkey"], 0.1, fixed.SEED)


@query("q09a_parallel_coordinates_orders")
def q09a(spark, d):
    pc = profile.parallel_coordinates(_t(spark, d, "orders"), "o_orderstatus", fixed.ORDER_FEATURES, ["o_orderkey"])
    return _round(pc, "value")


@query("q09b_label_profile_orders")
def q09b(spark, d):
    lp = profile.label_profile(_t(spark, d, "orders"), "o_orderstatus", fixed.ORDER_FEATURES)
    return _round(lp, "mean", "q25", "q50", "q75")


@query("q10a_class_balance_linestatus")
def q10a(spark, d):
    return _round(profile.class_balance(_t(spark, d, "lineitem"), "l_linestatus"), "share")


@query("q10b_class_weights_quality")
def q10b(spark, d):
    return _round(profile.class_weights(_t(spark, d, "labels"), "quality"), "weight")


@query("q36a_null_profile_orders")
def q36a(spark, d):
    return _round(profile.null_profile(_orders_with_nulls(spark, d)), "share")


@query("q36b_fill_nulls_orders")
def q36b(spark, d):
    filled = profile.fill_nulls(_orders_with_nulls(spark, d), {"o_orderpriority": "UNKNOWN", "o_orderstatus": "U"},
                                numeric="mean")
    return _round(filled, "o_totalprice")


def _orders_with_nulls(spark, d) -> DataFrame:
    o = _t(spark, d, "orders")
    return o.select(
        "o_orderkey",
        F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")).alias("o_orderpriority"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("o_orderstatus"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
    )


# ---------------------------------------------------------------- columns

@query("q11_drop_columns_orders")
def q11(spark, d):
    return columns.drop_columns(_t(spark, d, "orders"), ["o_orderdate", "o_orderpriority", "no_such_column"])


@query("q12_rename_columns_customer")
def q12(spark, d):
    pairs = [("c_name", "name"), ("name", "customer_name"), ("c_acctbal", "balance")]
    return columns.rename_columns(_t(spark, d, "customer"), pairs)


@query("q13_modify_columns_lineitem")
def q13(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_tax", "l_discount")
    out = columns.modify_columns(li, [
        ("l_extendedprice", F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))),
        ("l_tax", F.col("l_extendedprice") * F.col("l_tax")),  # sees the new l_extendedprice
        ("no_such_column", F.lit(0.0)),
    ])
    return _round(out, "l_extendedprice", "l_tax")


@query("q14a_dtypes_lineitem")
def q14a(spark, d):
    return columns.dtype_profile(_t(spark, d, "lineitem"))


@query("q14b_numeric_projection_lineitem")
def q14b(spark, d):
    return columns.select_numeric(_t(spark, d, "lineitem"))


# ---------------------------------------------------------------- encoding and scaling

@query("q15a_encode_linestatus")
def q15a(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus")
    return encode.encode_strings(li, ["l_linestatus"], fixed.STATUS_MAP)


@query("q15b_encode_orderstatus_unknown")
def q15b(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return encode.encode_strings(o, ["o_orderstatus"], fixed.STATUS_MAP)


@query("q15c_unknown_counts_orders")
def q15c(spark, d):
    return encode.unknown_counts(_t(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"], fixed.STATUS_MAP)


@query("q16_encode_booleans_orders")
def q16(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", (F.col("o_totalprice") > 250000).alias("is_big"))
    return encode.encode_booleans(o)


@query("q17_prepare_lineitem")
def q17(spark, d):
    return encode.prepare(_t(spark, d, "lineitem"), drop=["l_shipdate", "l_returnflag"], mapping=fixed.STATUS_MAP)


@query("q18_standardize_orders")
def q18(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return _round(scale.standardize(o, scale.scaling_stats(o, ["o_totalprice"])), "o_totalprice")


@query("q19_minmax_orders")
def q19(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return _round(scale.minmax_scale(o, ["o_totalprice"]), "o_totalprice")


# ---------------------------------------------------------------- sampling and batches

@query("q20a_hash_split_orders")
def q20a(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey")
    return sampling.hash_side(o, ["o_orderkey"], (0.8, 0.2), fixed.SEED)


@query("q20b_split_stats_orders")
def q20b(spark, d):
    o = _t(spark, d, "orders")
    sides = sampling.hash_side(o, ["o_orderkey"], (0.8, 0.2), fixed.SEED)
    out = sides.groupBy("side").agg(F.count(F.lit(1)).alias("rows"), F.avg("o_totalprice").alias("mean_totalprice"))
    return _round(out, "mean_totalprice")


@query("q20c_batch_counts_orders")
def q20c(spark, d):
    train_df, val_df = sampling.train_val_split(_t(spark, d, "orders"), 0.2, fixed.SEED, ["o_orderkey"])
    return batches.batch_counts({"train": train_df, "val": val_df}, fixed.BATCH)


@query("q21_hash_sample_events")
def q21(spark, d):
    ev = _t(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    return sampling.hash_sample(ev, ["event_id"], 0.1, fixed.SEED)


def _side_counts(df):
    sides = sampling.hash_side(df, ["o_orderkey"], (0.8, 0.2), fixed.SEED)
    return sides.groupBy("side", "o_orderstatus").agg(F.count(F.lit(1)).alias("rows"))


@query("q40_sample_then_split_orders")
def q40(spark, d):
    """L3 then L4 with the same keys and seed: the split of a sample is a split like any other."""
    return _side_counts(sampling.hash_sample(_t(spark, d, "orders"), ["o_orderkey"], 0.5, fixed.SEED))


@query("q41_stratified_then_split_orders")
def q41(spark, d):
    """T1 then L4 with the same keys and seed."""
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return _side_counts(sampling.stratified_sample(o, "o_orderstatus", ["o_orderkey"], seed=fixed.SEED))


@query("q22_head_customer")
def q22(spark, d):
    return sampling.head_rows(_t(spark, d, "customer"), 5, [F.col("c_acctbal").desc(), F.col("c_custkey")])


@query("q23a_batches_equal_orders")
def q23a(spark, d):
    o = _t(spark, d, "orders")
    return batches.assign_batches(o, fixed.BATCH, ["o_orderkey"], fixed.SEED, "equal")


@query("q23b_batches_fixed_orders")
def q23b(spark, d):
    o = _t(spark, d, "orders")
    return batches.assign_batches(o, fixed.BATCH, ["o_orderkey"], fixed.SEED, "fixed")


@query("q24_batch_profile_orders")
def q24(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_totalprice")
    z = scale.standardize(o, scale.scaling_stats(o, ["o_totalprice"]))
    b = batches.assign_batches(z, fixed.BATCH, ["o_orderkey"], fixed.SEED, "equal")
    return _round(batches.batch_profile(b, ["o_totalprice"]), "mean_o_totalprice")


@query("q34_stratified_lineitem")
def q34(spark, d):
    li = _t(spark, d, "lineitem")
    sample = sampling.stratified_sample(li, "l_linestatus", ["l_orderkey", "l_linenumber"], seed=fixed.SEED)
    return sample.drop("l_shipdate")


# ---------------------------------------------------------------- scoring and metrics

def _lineitem_scaled(spark, d) -> DataFrame:
    li = _t(spark, d, "lineitem")
    li = encode.encode_strings(li, ["l_linestatus"], fixed.STATUS_MAP)
    return scale.standardize(li, scale.scaling_stats(li, fixed.LINE_FEATURES), fixed.LINE_FEATURES)


def _orders_scored(spark, d) -> DataFrame:
    o = _t(spark, d, "orders")
    o = o.withColumn("y", F.when(F.col("o_orderstatus") == "F", F.lit(1.0)).otherwise(F.lit(0.0)))
    z = scale.standardize(o, scale.scaling_stats(o, fixed.ORDER_FEATURES), fixed.ORDER_FEATURES)
    return score_rows(z, fixed.order_scorer(), fixed.ORDER_FEATURES, "p")


@query("q25a_predict_relu_lineitem")
def q25a(spark, d):
    scored = score_rows(_lineitem_scaled(spark, d), fixed.relu_net(), fixed.LINE_FEATURES, method="expr")
    return _round(scored.select("l_orderkey", "l_linenumber", "prediction"), "prediction")


@query("q25b_predict_udf_embeddings")
def q25b(spark, d):
    m = init_model(MLPSpec(64, ((16, 0.0),), 1), seed=fixed.SEED)
    scored = score_rows(_t(spark, d, "embeddings"), m, "embedding", method="udf")
    return _round(scored.select("vec_id", "prediction"), "prediction")


@query("q26a_metrics_lineitem")
def q26a(spark, d):
    scored = score_rows(_lineitem_scaled(spark, d), fixed.line_scorer(), fixed.LINE_FEATURES, "p")
    return _round(metrics.classification_metrics(scored, "l_linestatus", "p"), "value")


@query("q26b_confusion_lineitem")
def q26b(spark, d):
    scored = score_rows(_lineitem_scaled(spark, d), fixed.line_scorer(), fixed.LINE_FEATURES, "p")
    return _round(metrics.confusion_matrix(scored, "l_linestatus", "p"), "value")


@query("q27_batch_metrics_orders")
def q27(spark, d):
    b = batches.assign_batches(_orders_scored(spark, d), fixed.BATCH, ["o_orderkey"], fixed.SEED, "equal")
    return _round(metrics.score(b, "y", "p", average="batch"), "value")


@query("q39_score_model_orders")
def q39(spark, d):
    """R1 as one plan: standardize with the table's statistics, score, cut batches, mean of per-batch metrics."""
    from .workflow import score_model
    o = _t(spark, d, "orders").withColumn("y", F.when(F.col("o_orderstatus") == "F", F.lit(1.0)).otherwise(F.lit(0.0)))
    stats = scale.collect_stats(scale.scaling_stats(o, fixed.ORDER_FEATURES))
    scored = score_model(o, fixed.order_scorer(), fixed.ORDER_FEATURES, "y", stats, batch_size=fixed.BATCH,
                         keys=["o_orderkey"], seed=fixed.SEED, average="batch")
    return _round(scored, "value")


@query("q28_losses_orders")
def q28(spark, d):
    s = _orders_scored(spark, d)
    ll = metrics.log_loss(s, "y", "p").select(F.lit("log_loss").alias("metric"), F.col("log_loss").alias("value"))
    wll = metrics.log_loss(s, "y", "p", train.weight_column("y", fixed.CLASS_WEIGHT)).select(
        F.lit("log_loss_weighted").alias("metric"), F.col("log_loss").alias("value"))
    mse = metrics.regression_metrics(s, "y", "p").where(F.col("metric") == "mse")
    # The regression label itself standardized, predicted from a scaled feature.
    o = _t(spark, d, "orders")
    zl = scale.standardize(o, scale.scaling_stats(o, ["o_totalprice", "o_custkey"]))
    zl = zl.withColumn("pred", F.col("o_custkey") * F.lit(0.1))
    mse_scaled = metrics.regression_metrics(zl, "o_totalprice", "pred").where(F.col("metric") == "mse").select(
        F.lit("mse_scaled_label").alias("metric"), "value")
    return _round(ll.unionByName(wll).unionByName(mse).unionByName(mse_scaled), "value")


@query("q29_sync_gradient_lineitem")
def q29(spark, d):
    g = train.sync_gradient(_lineitem_scaled(spark, d), fixed.grad_start(), fixed.LINE_FEATURES, "l_linestatus",
                            fixed.CLASS_WEIGHT)
    return _round(g, "gradient")


@query("q32_custom_metric_orders")
def q32(spark, d):
    b = batches.assign_batches(_orders_scored(spark, d), fixed.BATCH, ["o_orderkey"], fixed.SEED, "equal")

    def mean_absolute_error(y, p):
        return float(np.mean(np.abs(y - p)))

    return _round(metrics.custom_metric(b, "y", "p", mean_absolute_error), "value")


@query("q35_ensemble_orders")
def q35(spark, d):
    o = _t(spark, d, "orders")
    z = scale.standardize(o, scale.scaling_stats(o, fixed.ORDER_FEATURES), fixed.ORDER_FEATURES)
    e = ensemble_predict(z, fixed.ensemble_members(), fixed.ORDER_FEATURES)
    return _round(e.select("o_orderkey", "prediction"), "prediction")


@query("q37a_category_index_customer")
def q37a(spark, d):
    return categories.category_index(_t(spark, d, "customer"), "c_mktsegment")


@query("q37b_index_categories_customer")
def q37b(spark, d):
    c = _t(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return categories.index_categories(c, "c_mktsegment").select("c_custkey", "c_mktsegment_index")


# ---------------------------------------------------------------- training in closed form

SYNC_RATE = 0.5


def _sync_fit(spark, d) -> train.FitResult:
    """Two full-batch steps of logistic regression from fixed parameters: every number has a closed form."""
    start = fixed.grad_start()
    return train.fit(_lineitem_scaled(spark, d), start.spec, fixed.LINE_FEATURES, "l_linestatus", epochs=2,
                     optimizer=OptimizerSpec("sgd", lr=SYNC_RATE), class_weight=fixed.CLASS_WEIGHT, init=start,
                     strategy="sync")


@query("q30b_sync_history_lineitem")
def q30b(spark, d):
    """M5, M8: the history of a synchronous fit."""
    return _round(_sync_fit(spark, d).history, "value")


@query("q42_loss_curve_lineitem")
def q42(spark, d):
    """M9: the loss curve of the same fit."""
    return _round(train.loss_curve(_sync_fit(spark, d).history), "loss", "val_loss")


@query("q31b_evaluate_fixed_lineitem")
def q31b(spark, d):
    """M7: loss and accuracy of a fixed scorer on both sides of a hash split."""
    tr, va = sampling.train_val_split(_lineitem_scaled(spark, d), 0.2, fixed.SEED, ["l_orderkey", "l_linenumber"])
    return _round(train.evaluate(fixed.line_scorer(), {"train": tr, "validation": va}, fixed.LINE_FEATURES,
                                 "l_linestatus"), "value")


@query("q33b_save_load_score_lineitem")
def q33b(spark, d):
    """A saved model, loaded again, scores like the original."""
    path = scratch_path(spark, f"models/{uuid.uuid4().hex}")
    loaded = runs.load_model(spark, runs.save_model(spark, fixed.relu_net(), path))
    scored = score_rows(_lineitem_scaled(spark, d), loaded, fixed.LINE_FEATURES, method="udf")
    return _round(scored.select("l_orderkey", "l_linenumber", "prediction"), "prediction")


# ---------------------------------------------------------------- training (no SQL oracle)

def embeddings_fit(spark: SparkSession, d: str, epochs: int = 5) -> train.FitResult:
    """A small fit on ``embeddings`` (y = label 0) for Q30, Q31 and Q33."""
    emb = _t(spark, d, "embeddings").withColumn("y", (F.col("label") == 0).cast("double"))
    tr, va = sampling.train_val_split(emb, 0.2, fixed.SEED, ["vec_id"])
    spec = MLPSpec(64, ((16, 0.0),), 1, l2=0.001)
    return train.fit(tr, spec, "embedding", "y", va, epochs=epochs, batch_size=32,
                     optimizer=OptimizerSpec("rmsprop", lr=0.01), class_weight={0.0: 1.0, 1.0: 3.0},
                     keys=["vec_id"], seed=fixed.SEED)


@query("q30_fit_history_embeddings")
def q30(spark, d):
    return embeddings_fit(spark, d).history


@query("q31_evaluate_embeddings")
def q31(spark, d):
    res = embeddings_fit(spark, d)
    emb = _t(spark, d, "embeddings").withColumn("y", (F.col("label") == 0).cast("double"))
    tr, va = sampling.train_val_split(emb, 0.2, fixed.SEED, ["vec_id"])
    return train.evaluate(res.best_model, {"train": tr, "validation": va}, "embedding", "y")


@query("q33_save_load_embeddings")
def q33(spark, d):
    res = embeddings_fit(spark, d)
    ensure_checkpoint_dir(spark)
    path = runs.save_run(spark, scratch_path(spark, "runs"), res)
    loaded = runs.load_model(spark, f"{path}/best_model")
    if not np.allclose(loaded.flat(), res.best_model.flat()):
        raise AssertionError("model round trip changed the parameters")
    if runs.load_history(spark, f"{path}/history").count() != len(res.history_rows):
        raise AssertionError("history round trip lost rows")
    return spark.read.parquet(f"{path}/best_model/params").select("layer", "kind", "row", "col", "value")


@query("q38_train_workflow_lineitem")
def q38(spark, d):
    """M11 end to end: prepare lineitem, split, scale, fit, evaluate (label: line status O)."""
    from .workflow import train_workflow
    li = _t(spark, d, "lineitem")
    wf = train_workflow(li, "l_linestatus", drop=["l_shipdate", "l_returnflag", "l_partkey", "l_suppkey"],
                        mapping=fixed.STATUS_MAP, keys=["l_orderkey", "l_linenumber"], seed=fixed.SEED,
                        batch_size=fixed.BATCH, hidden=((16, 0.0), (16, 0.0)), epochs=2,
                        class_weight=fixed.CLASS_WEIGHT)
    return wf.fit.history.unionByName(
        wf.scores.select(F.lit(0).alias("epoch"), F.concat_ws("_", "dataset", "metric").alias("metric"), "value"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-feature summary of the prepared lineitem table."""
    prepared = encode.prepare(_t(spark, sf_dir, "lineitem"), drop=["l_shipdate", "l_returnflag"],
                              mapping=fixed.STATUS_MAP)
    return _round(profile.summary_table(prepared), "value")


from . import catalog_fits  # noqa: E402, F401  (registers the queries of fits, scoring and missing values)

__all__ = ["QUERIES", "flagship", "embeddings_fit", "predicted_class"]
