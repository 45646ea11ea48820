"""Model, history and run-directory I/O.

A model is one parquet table ``params`` (layer, kind, row, col, value,
spec): one row per parameter, and the network's layer sizes as JSON in
``spec`` (the same string on every row, which parquet stores once per page
as a dictionary entry), so saving a model is one write.  The history is a
(epoch, metric, value) table.  Paths are used as given, so a
shared filesystem or object store works the same as a local folder.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.mlp import MLPModel, MLPSpec

PARAM_SCHEMA = "layer int, kind string, row int, col int, value double"


def model_frame(spark: SparkSession, model: MLPModel) -> DataFrame:
    """The parameter table of a model (size of the model, not of any data)."""
    return spark.createDataFrame(model.param_rows(), PARAM_SCHEMA)


def save_model(spark: SparkSession, model: MLPModel, path: str, mode: str = "overwrite") -> str:
    """Write the ``params`` table (parameters + spec) under ``path``."""
    (model_frame(spark, model).withColumn("spec", F.lit(model.spec.to_json()))
     .coalesce(1).write.mode(mode).parquet(f"{path}/params"))
    return path


def load_model(spark: SparkSession, path: str) -> MLPModel:
    """Read a model written by ``save_model`` (S6); its size is the model's."""
    rows = spark.read.parquet(f"{path}/params").collect()
    if not rows:
        raise ValueError(f"no parameters under {path}")
    spec = MLPSpec.from_json(rows[0]["spec"])
    return MLPModel.from_param_rows(spec, [(r["layer"], r["kind"], r["row"], r["col"], r["value"]) for r in rows])


def save_history(history: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Persist the per-epoch metrics (S3)."""
    history.coalesce(1).write.mode(mode).parquet(path)
    return path


def load_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def run_dir(base: str, datetime_subdir: bool = True, now: _dt.datetime | None = None) -> str:
    """``base/<timestamp>`` or ``base``."""
    if not datetime_subdir:
        return base.rstrip("/")
    stamp = (now or _dt.datetime.now(_dt.timezone.utc)).strftime("%Y-%m-%d_%H-%M-%S_%f")
    return f"{base.rstrip('/')}/{stamp}"


def save_run(spark: SparkSession, base: str, result, datetime_subdir: bool = True) -> str:
    """Write the best model, the last model and the history of a fit."""
    path = run_dir(base, datetime_subdir)
    save_model(spark, result.best_model, f"{path}/best_model")
    save_model(spark, result.model, f"{path}/last_model")
    save_history(result.history, f"{path}/history")
    return path
