"""Column expressions shared by the operators (all JVM-side, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: probabilities are clipped into [EPS, 1 - EPS] before a log,
# the same guard the reference's loss applies.
EPS = 1e-7


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_numeric(dtype: T.DataType, strict: bool = False) -> bool:
    """``strict`` keeps only int and double, as the reference does."""
    if strict:
        return isinstance(dtype, (T.IntegerType, T.DoubleType))
    return isinstance(dtype, T.NumericType)


def safe_ratio(num: Column, den: Column, default: float = 0.0) -> Column:
    """num / den, ``default`` when den is 0 (ANSI division by zero raises)."""
    return F.when(den == 0, F.lit(default)).otherwise(num / den)


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def relu(z: Column) -> Column:
    """max(0, z).  ``greatest`` skips nulls, so callers guard null inputs once (see ``score_expression``)."""
    return F.greatest(F.lit(0.0), z)


def present(c: Column) -> Column:
    """The value, or null where it is NaN: a missing number is null or NaN alike."""
    return F.when(~F.isnan(c), c)


def clip(p: Column, low: float, high: float) -> Column:
    """p clipped into [low, high]; null and NaN give null (``least``/``greatest`` alone would skip a null)."""
    return F.when(p.isNotNull() & ~F.isnan(p), F.least(F.greatest(p, F.lit(float(low))), F.lit(float(high))))


def clip01(p: Column) -> Column:
    return clip(p, 0.0, 1.0)


def predicted_class(score: Column, low: float = 0.0, high: float = 1.0) -> Column:
    """Round half to even of the score clipped to the least and the largest class (numpy ``round``), as double.

    ``+ 0.0`` turns a negative zero into zero.
    """
    return F.rint(clip(score, low, high)) + F.lit(0.0)


def bce(y: Column, p: Column) -> Column:
    """Binary cross-entropy of one row with the probability clipped."""
    q = F.when(p.isNotNull() & ~F.isnan(p), F.least(F.greatest(p, F.lit(EPS)), F.lit(1.0 - EPS)))
    return -(y * F.log(q) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - q))


def round6(c: Column) -> Column:
    return F.round(c, 6)
