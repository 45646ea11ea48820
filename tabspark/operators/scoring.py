"""Scoring with a dense network.

Small networks become plain Catalyst arithmetic (``greatest(0, ...)`` per
hidden unit): no Python worker, whole-stage codegen.  Larger ones run as an
Arrow-batched scalar UDF that receives only the feature vector column (read
as one matrix per Arrow batch, no per-row objects); the parameters ship once
per executor inside a broadcast variable.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import relu, sigmoid
from .mlp import MLPModel, predict_scores

# Networks up to this many parameters are scored with column expressions.
EXPR_MAX_PARAMS = 256


def features_array(df: DataFrame, features: Sequence[str] | str) -> Column:
    """One ``array<double>`` column from feature columns or an array column."""
    if isinstance(features, str):
        dtype = df.schema[features].dataType
        if not isinstance(dtype, T.ArrayType):
            raise TypeError(f"{features!r} is not an array column")
        return F.col(f"`{features}`").cast("array<double>")
    return F.array(*[F.col(f"`{c}`").cast("double") for c in features])


def feature_matrix(col: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows x features float64 matrix of an Arrow ``list<double>`` column.

    The list values are flattened and reshaped in one step, so no Python
    object is made per row.  Null vectors and vectors of different lengths
    are refused; null elements become NaN.
    """
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    if n == 0:
        return np.zeros((0, 0))
    if col.null_count:
        raise ValueError("null feature vector")
    lengths = pc.list_value_length(col)
    d = pc.min_max(lengths)
    if d["min"].as_py() != d["max"].as_py():
        raise ValueError("feature vectors of different lengths")
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64, copy=False).reshape(n, int(d["min"].as_py()))


def _feature_cols(df: DataFrame, features: Sequence[str] | str, n: int) -> list[Column]:
    if isinstance(features, str):
        arr = F.col(f"`{features}`")
        return [arr[i].cast("double") for i in range(n)]
    return [F.col(f"`{c}`").cast("double") for c in features]


def score_expression(model: MLPModel, inputs: list[Column]) -> list[Column]:
    """Network outputs as column expressions (for small networks); null if any input is null or NaN."""
    a = inputs
    for w, b in zip(model.weights[:-1], model.biases[:-1]):
        a = [relu(sum((x * F.lit(float(w[i, j])) for i, x in enumerate(a)), F.lit(float(b[j]))))
             for j in range(w.shape[1])]
    w, b = model.weights[-1], model.biases[-1]
    z = [sum((x * F.lit(float(w[i, j])) for i, x in enumerate(a)), F.lit(float(b[j]))) for j in range(w.shape[1])]
    if model.spec.output == "softmax":
        top = F.greatest(*z)
        e = [F.exp(v - top) for v in z]
        total = sum(e[1:], e[0])
        out = [v / total for v in e]
    else:
        out = [sigmoid(v) for v in z] if model.spec.output == "sigmoid" else z
    # relu (greatest) skips nulls, so one guard on the inputs keeps a missing feature missing.
    missing = None
    for x in inputs:
        gone = x.isNull() | F.isnan(x)
        missing = gone if missing is None else missing | gone
    return out if missing is None else [F.when(~missing, v) for v in out]


def score_udf(model: MLPModel, spark=None):
    """Scalar Arrow UDF: array<double> features to the score, ``array<double>`` for several outputs.

    A null vector or a missing feature gives null.
    """
    sc = spark.sparkContext if spark is not None else None
    payload = (model.spec, model.flat())
    holder = sc.broadcast(payload) if sc is not None else None
    several = model.spec.outputs > 1

    @F.arrow_udf(T.ArrayType(T.DoubleType()) if several else T.DoubleType())
    def _score(x: pa.Array) -> pa.Array:
        spec, theta = holder.value if holder is not None else payload
        m = MLPModel.from_flat(spec, theta)
        kind = pa.list_(pa.float64()) if several else pa.float64()
        if x.null_count == len(x):
            return pa.nulls(len(x), kind)
        valid = pc.is_valid(x).to_numpy(zero_copy_only=False)
        inputs = feature_matrix(x.filter(pa.array(valid)))
        whole = ~np.isnan(inputs).any(axis=1)
        scored = np.flatnonzero(valid)[whole]
        mask = np.ones(len(x), dtype=bool)
        mask[scored] = False
        out = np.full((len(x), spec.outputs), np.nan)
        out[scored] = predict_scores(m, inputs[whole])
        if not several:
            return pa.array(out[:, 0], pa.float64(), mask=mask)
        lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * spec.outputs, pa.array(out.ravel()))
        return pc.if_else(pa.array(~mask), lists, pa.scalar(None, kind))

    return _score


def predict(
    df: DataFrame,
    model: MLPModel,
    features: Sequence[str] | str,
    output_col: str = "prediction",
    method: str = "auto",
) -> DataFrame:
    """Add the network's score of each row as ``output_col``: a double, or ``array<double>`` for several outputs."""
    if method == "auto":
        method = "expr" if model.spec.n_params() <= EXPR_MAX_PARAMS else "udf"
    if method == "expr":
        outputs = score_expression(model, _feature_cols(df, features, model.spec.inputs))
        expr = outputs[0] if len(outputs) == 1 else F.when(outputs[0].isNotNull(), F.array(*outputs))
    elif method == "udf":
        expr = score_udf(model, df.sparkSession)(features_array(df, features))
    else:
        raise ValueError("method must be 'auto', 'expr' or 'udf'")
    return df.withColumn(output_col, expr)


def predicted_actual(
    df: DataFrame,
    model: MLPModel,
    features: Sequence[str] | str,
    label: str | Sequence[str],
    keys: Sequence[str] = (),
    method: str = "auto",
) -> DataFrame:
    """(keys..., output, actual, prediction): a row per row and output, for a truth plot.

    A missing label or score is null.
    """
    from .train import label_column

    k = model.spec.outputs
    own = predict(df.withColumn("__actual", label_column(df, label, k)), model, features, "__score", method)
    pairs = [F.struct(F.lit(j).alias("output"), (F.col("__actual")[j] if k > 1 else F.col("__actual")).alias("actual"),
                      (F.col("__score")[j] if k > 1 else F.col("__score")).alias("prediction")) for j in range(k)]
    return own.select(*[F.col(f"`{c}`") for c in keys], F.inline(F.array(*pairs)))


def ensemble_predict(
    df: DataFrame,
    models: Sequence[MLPModel],
    features: Sequence[str] | str,
    output_col: str = "prediction",
    method: str = "auto",
) -> DataFrame:
    """Mean score of several models (T2), one projection; of several outputs each by itself."""
    if not models:
        raise ValueError("no models")
    k = models[0].spec.outputs
    if any(m.spec.outputs != k for m in models):
        raise ValueError("the models have different numbers of outputs")
    out = df
    names = []
    for i, m in enumerate(models):
        name = f"__score_{i}"
        out = predict(out, m, features, name, method)
        names.append(name)
    def mean(of) -> Column:
        return sum((of(n) for n in names[1:]), of(names[0])) / F.lit(float(len(names)))

    if k == 1:
        return out.withColumn(output_col, mean(F.col)).drop(*names)
    means = F.array(*[mean(lambda n, j=j: F.col(n)[j]) for j in range(k)])
    return out.withColumn(output_col, F.when(F.col(names[0]).isNotNull(), means)).drop(*names)
