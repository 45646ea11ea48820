"""Classification and regression metrics.

Pooled metrics are one aggregate over all rows (conditional counts), so they
are exact for F1 and friends.  ``average="batch"`` reproduces the
reference's mean of per-batch metrics: a group-by on the batch, then a
second aggregate over the per-batch values.  A class missing from a batch
gives 0 for its precision / recall / F1 (zero-fill, as scikit-learn does).

A row whose label or score is missing (null or NaN) is not scored: no metric
counts it, and ``unscored_rows`` tells how many there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import bce, predicted_class, present, safe_ratio
from .losses import Metric

BINARY = (0.0, 1.0)


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _pair(label: str, score: str, classes: Sequence[float] = BINARY) -> tuple[Column, Column, Column]:
    """(label, predicted class, score) of a scored row; all null where the label or the score is missing."""
    y, p = present(_q(label).cast("double")), present(_q(score).cast("double"))
    whole = y.isNotNull() & p.isNotNull()
    y, p = F.when(whole, y), F.when(whole, p)
    return y, predicted_class(p, min(classes), max(classes)), p


def _counts(y: Column, yhat: Column, classes: Sequence[float]) -> list[Column]:
    aggs = [F.count(y).alias("n"), F.count_if(y == yhat).alias("correct")]
    for i, c in enumerate(classes):
        aggs += [
            F.count_if((y == F.lit(c)) & (yhat == F.lit(c))).alias(f"tp{i}"),
            F.count_if(yhat == F.lit(c)).alias(f"pred{i}"),
            F.count_if(y == F.lit(c)).alias(f"true{i}"),
        ]
    return aggs


def _row(metric: str, cls: Column, value: Column) -> Column:
    return F.struct(F.lit(metric).alias("metric"), cls.cast("double").alias("class"), value.cast("double").alias("value"))


def _metric_rows(classes: Sequence[float]) -> list[Column]:
    """Metric structs computed from the conditional counts of ``_counts``."""
    rows = [_row("accuracy", F.lit(None), safe_ratio(F.col("correct"), F.col("n")))]
    for i, c in enumerate(classes):
        p = safe_ratio(F.col(f"tp{i}"), F.col(f"pred{i}"))
        r = safe_ratio(F.col(f"tp{i}"), F.col(f"true{i}"))
        f1 = safe_ratio(F.lit(2.0) * p * r, p + r)
        rows += [_row(name, F.lit(float(c)), v) for name, v in (("precision", p), ("recall", r), ("f1", f1))]
    return rows


def classification_metrics(
    df: DataFrame,
    label: str,
    score: str,
    classes: Sequence[float] = BINARY,
) -> DataFrame:
    """(metric, class, value): accuracy, per-class precision, recall, F1.

    The predicted class is the score clipped to the range of ``classes`` and rounded half to
    even.  Rows without a score or a label do not count (``unscored_rows``).
    """
    y, yhat, _ = _pair(label, score, classes)
    return df.agg(*_counts(y, yhat, classes)).select(F.inline(F.array(*_metric_rows(classes))))


def unscored_rows(df: DataFrame, label: str, score: str) -> DataFrame:
    """(metric, class, value): the number of rows that no metric counts, for want of a score or a label."""
    y, _, _ = _pair(label, score)
    return df.agg((F.count(F.lit(1)) - F.count(y)).alias("k")).select(F.inline(F.array(_row("unscored", F.lit(None), F.col("k")))))


def confusion_matrix(
    df: DataFrame,
    label: str,
    score: str,
    classes: Sequence[float] = BINARY,
    normalize: bool = True,
) -> DataFrame:
    """(actual, predicted, value): share (or count) of scored rows per cell, zero-filled."""
    y, yhat, _ = _pair(label, score, classes)
    aggs = [F.count(y).alias("n")]
    cells = []
    for i, a in enumerate(classes):
        for j, p in enumerate(classes):
            name = f"c{i}_{j}"
            aggs.append(F.count_if((y == F.lit(a)) & (yhat == F.lit(p))).alias(name))
            value = safe_ratio(F.col(name), F.col("n")) if normalize else F.col(name).cast("double")
            cells.append(F.struct(F.lit(float(a)).alias("actual"), F.lit(float(p)).alias("predicted"),
                                  value.alias("value")))
    return df.agg(*aggs).select(F.inline(F.array(*cells)))


def batch_metrics(
    df: DataFrame,
    label: str,
    score: str,
    batch_col: str = "batch_id",
    classes: Sequence[float] = BINARY,
) -> DataFrame:
    """(metric, class, value): mean over batches of per-batch metrics.

    Also ``mse`` per batch, averaged the same way.  A batch without scored rows does not count.
    """
    return _batch_average(df, label, score, batch_col, classes, DEFAULT_METRICS)


# The metrics of ``score`` by name, in the order of its rows.
DEFAULT_METRICS = ("accuracy", "precision", "recall", "f1", "mse")
NAMED_METRICS = (*DEFAULT_METRICS, "mae", "log_loss")
_ERRORS = {"mse": lambda y, p: (p - y) * (p - y), "mae": lambda y, p: F.abs(p - y), "log_loss": bce}


def _named_aggregates(label: str, score_col: str, classes: Sequence[float], names: Sequence[str]):
    """(aggregates, rows from them) of the metrics in ``names``."""
    y, yhat, p = _pair(label, score_col, classes)
    aggs = _counts(y, yhat, classes) + [F.avg(_ERRORS[m](y, p)).alias(m) for m in names if m in _ERRORS]
    kinds = ["accuracy", *["precision", "recall", "f1"] * len(classes)]
    rows = [r for kind, r in zip(kinds, _metric_rows(classes)) if kind in names]
    return aggs, rows + [_row(m, F.lit(None), F.col(m)) for m in names if m in _ERRORS]


def _batch_average(df: DataFrame, label: str, score_col: str, batch_col: str, classes: Sequence[float],
                   names: Sequence[str]) -> DataFrame:
    aggs, rows = _named_aggregates(label, score_col, classes, names)
    per_batch = df.groupBy(_q(batch_col)).agg(*aggs).where(F.col("n") > 0)
    return per_batch.select(F.inline(F.array(*rows))).groupBy("metric", "class").agg(F.avg("value").alias("value"))


def _summed(df: DataFrame, label: str, score_col: str, metrics: Sequence[Metric]) -> DataFrame:
    """Pooled accumulators: every task adds its rows up, the sums of the tasks are added, one job."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, sums = 0, [np.zeros(m.size) for m in metrics]
        for b in batches:
            y, p = (b.column(i).to_numpy(zero_copy_only=False).reshape(-1, 1) for i in range(2))
            rows += len(y)
            sums = [s + m.add(y, p) for s, m in zip(sums, metrics)]
        flat = np.concatenate([[float(rows)], *sums])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["i", "v"])

    y, _, p = _pair(label, score_col)
    scored = df.select(y.alias("y"), p.alias("p")).where(F.col("y").isNotNull())
    found = scored.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    flat = np.zeros(1 + sum(m.size for m in metrics))
    for r in found:
        flat[r["i"]] = r["v"]
    out, at = [], 1
    for m in metrics:
        out.append((m.name, None, float(m.value(flat[at:at + m.size], flat[0])) if flat[0] else None))
        at += m.size
    return df.sparkSession.createDataFrame(out, "metric string, class double, value double")


def _called(df: DataFrame, label: str, score_col: str, batch_col: str, metrics: Sequence) -> DataFrame:
    """Mean over batches of functions and accumulators, all of them in one pass over each batch."""
    def run(group: pa.Table) -> pa.Table:
        y, p = (group.column(c).to_numpy() for c in ("y", "p"))
        names, classes, values = [], [], []
        for m in metrics:
            if isinstance(m, Metric):
                found = m.value(m.add(y.reshape(-1, 1), p.reshape(-1, 1)), float(len(y)))
                name = m.name
            else:
                found, name = m(y, p), getattr(m, "__name__", "metric")
            found = np.asarray(found, dtype=np.float64)
            names += [name] * found.size
            classes += [None] if found.ndim == 0 else [float(i) for i in range(found.size)]
            values += found.ravel().tolist()
        return pa.table({"metric": pa.array(names, pa.string()), "class": pa.array(classes, pa.float64()),
                         "value": pa.array(values, pa.float64())})

    y, _, p = _pair(label, score_col)
    scored = df.select(_q(batch_col).alias("batch"), y.alias("y"), p.alias("p")).where(F.col("y").isNotNull())
    found = scored.groupBy("batch").applyInArrow(run, "metric string, class double, value double")
    return found.groupBy("metric", "class").agg(F.avg("value").alias("value"))


def score(
    df: DataFrame,
    label: str,
    score_col: str,
    average: str = "pooled",
    batch_col: str = "batch_id",
    classes: Sequence[float] = BINARY,
    metrics: Sequence[str | Metric | Callable] = DEFAULT_METRICS,
) -> DataFrame:
    """(metric, class, value) of scored rows (R1): ``pooled`` over all rows or mean over ``batch``es.

    Both give the same metrics: accuracy, precision, recall and F1 per class, and
    the mean squared error (R8) by default.  ``metrics``: names (``NAMED_METRICS``),
    ``losses.Metric`` accumulators, and functions of (label, score) that give a number or, per class, an array (U3).
    A function sees one batch at a time, so it has no pooled value.  Rows without a label or score do not count
    (``unscored_rows``).
    """
    if average not in ("pooled", "batch"):
        raise ValueError("average must be 'pooled' or 'batch'")
    names = [m for m in metrics if isinstance(m, str)]
    unknown = set(names) - set(NAMED_METRICS)
    if unknown:
        raise ValueError(f"unknown metrics {sorted(unknown)}: names are {', '.join(NAMED_METRICS)}")
    others = [m for m in metrics if not isinstance(m, str)]
    parts = []
    if names and average == "batch":
        parts.append(_batch_average(df, label, score_col, batch_col, classes, names))
    elif names:
        aggs, rows = _named_aggregates(label, score_col, classes, names)
        parts.append(df.agg(*aggs).select(F.inline(F.array(*rows))))
    if others and average == "batch":
        parts.append(_called(df, label, score_col, batch_col, others))
    elif others:
        calls = [getattr(m, "__name__", "metric") for m in others if not isinstance(m, Metric)]
        if calls:
            raise ValueError(f"{calls}: a function is averaged over batches; give a Metric for a pooled value")
        parts.append(_summed(df, label, score_col, others))
    if not parts:
        raise ValueError("no metrics")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(metric, value): mean squared and mean absolute error (R8) of the rows that have both."""
    y, _, p = _pair(label, prediction)
    return df.agg(F.avg((p - y) * (p - y)).alias("mse"), F.avg(F.abs(p - y)).alias("mae")).select(
        F.inline(F.array(
            F.struct(F.lit("mse").alias("metric"), F.col("mse").alias("value")),
            F.struct(F.lit("mae").alias("metric"), F.col("mae").alias("value")),
        )))


def log_loss(df: DataFrame, label: str, score_col: str, weight: str | Column | None = None) -> DataFrame:
    """Mean (optionally weighted) binary cross-entropy, probability clipped."""
    y, p = _q(label).cast("double"), _q(score_col).cast("double")
    w = F.lit(1.0) if weight is None else (_q(weight) if isinstance(weight, str) else weight)
    return df.agg(F.avg(w * bce(y, p)).alias("log_loss"))


def custom_metric(
    df: DataFrame,
    label: str,
    score_col: str,
    fn: Callable[[np.ndarray, np.ndarray], float | np.ndarray],
    batch_col: str = "batch_id",
    name: str | None = None,
) -> DataFrame:
    """Mean over batches of a Python metric ``fn(y_true, y_score)``.

    ``fn`` runs once per batch in ``applyInPandas`` (a batch has a bounded
    number of rows) and may return a number or a 1-d array; the result is
    (metric, idx, value) averaged over batches.
    """
    metric = name or getattr(fn, "__name__", "metric")

    def per_batch(pdf: pd.DataFrame) -> pd.DataFrame:
        out = np.atleast_1d(np.asarray(fn(pdf[label].to_numpy(np.float64), pdf[score_col].to_numpy(np.float64)),
                                       dtype=np.float64))
        return pd.DataFrame({"idx": np.arange(len(out), dtype=np.int32), "value": out})

    values = (df.select(_q(batch_col), _q(label), _q(score_col))
              .groupBy(batch_col).applyInPandas(per_batch, "idx int, value double"))
    return values.groupBy("idx").agg(F.avg("value").alias("value")).select(
        F.lit(metric).alias("metric"), "idx", "value")
