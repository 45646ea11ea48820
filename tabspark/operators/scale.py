"""Feature statistics and scaling.

Statistics are one aggregate pass (partial aggregation on every task, one
row per task shuffled), keyed by column *name*.  The stats table has one row
per column, so it is small by construction; ``standardize`` reads it to the
driver and applies literals, which keeps the scoring projection a plain
codegen'd ``Project`` with no join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import feature_columns

STAT_NAMES = ("count", "mean", "stddev", "min", "max")
WIDE_MAX_COLUMNS = 16


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def scaling_stats(df: DataFrame, columns: Sequence[str] | None = None, label: str | None = None) -> DataFrame:
    """(column_name, count, mean, stddev, min, max) per numeric column.

    ``stddev`` is the sample standard deviation.  NaN is a missing value like
    null: no statistic counts it.  One aggregate job, one row per input column.  Up to ``WIDE_MAX_COLUMNS`` columns use one wide
    aggregate; wider tables are unpivoted to (column_name, value) first, so
    the generated code stays small (hundreds of aggregates in one operator
    exceed the JIT's method-size limit) and each column merges on its own task.
    """
    cols = list(columns) if columns is not None else feature_columns(df, label)
    if not cols:
        raise ValueError("no numeric columns to describe")
    if len(cols) > WIDE_MAX_COLUMNS:
        long = df.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column_name"), _q(c).cast("double").alias("value")) for c in cols])))
        finite = F.when(~F.isnan("value"), F.col("value"))
        found = long.groupBy("column_name").agg(
            F.count(finite).cast("double").alias("count"), F.avg(finite).alias("mean"),
            F.stddev_samp(finite).alias("stddev"), F.min(finite).alias("min"), F.max(finite).alias("max"))
        # A row for every column, also of an empty table.
        names = df.sparkSession.createDataFrame([(c,) for c in cols], "column_name string")
        return names.join(F.broadcast(found), "column_name", "left").select(
            "column_name", F.coalesce("count", F.lit(0.0)).alias("count"), "mean", "stddev", "min", "max")
    aggs = []
    for i, c in enumerate(cols):
        x = _q(c).cast("double")
        finite = F.when(~F.isnan(x), x)
        aggs += [
            F.count(finite).cast("double").alias(f"count_{i}"),
            F.avg(finite).alias(f"mean_{i}"),
            F.stddev_samp(finite).alias(f"stddev_{i}"),
            F.min(finite).alias(f"min_{i}"),
            F.max(finite).alias(f"max_{i}"),
        ]
    wide = df.agg(*aggs)
    # One struct per column, exploded: rows = number of columns.
    per_col = F.array(*[
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{s}_{i}").alias(s) for s in STAT_NAMES])
        for i, c in enumerate(cols)
    ])
    return wide.select(F.inline(per_col))


@dataclass(frozen=True)
class ColumnStats:
    count: float
    mean: float | None
    stddev: float | None
    min: float | None
    max: float | None


def collect_stats(stats: DataFrame) -> dict[str, ColumnStats]:
    """Read a stats table (bounded by the number of columns) to the driver."""
    rows = stats.select("column_name", *STAT_NAMES).collect()
    return {r["column_name"]: ColumnStats(*(r[s] for s in STAT_NAMES)) for r in rows}


def _as_stats(stats) -> dict[str, ColumnStats]:
    return stats if isinstance(stats, dict) else collect_stats(stats)


def zscore(c: Column, s: ColumnStats, constant: float = 0.0) -> Column:
    """(x - mean) / stddev; a zero or undefined stddev centres to ``constant``."""
    if s.mean is None:
        return F.lit(None).cast("double")
    if not s.stddev:
        return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(F.lit(float(constant)))
    return (c.cast("double") - F.lit(float(s.mean))) / F.lit(float(s.stddev))


def standardize(df: DataFrame, stats, columns: Sequence[str] | None = None, constant: float = 0.0) -> DataFrame:
    """Z-score columns with statistics of (usually) the training split.

    ``stats`` is a ``scaling_stats`` DataFrame or its collected dict.  Only
    columns present in both are scaled; a constant column becomes ``constant``.
    """
    st = _as_stats(stats)
    cols = [c for c in (columns if columns is not None else st) if c in st and c in df.columns]
    return df.withColumns({c: zscore(_q(c), st[c], constant) for c in cols})


def unscale(c: Column, s: ColumnStats) -> Column:
    """Inverse z-score, for labels scaled with E7."""
    return c * F.lit(float(s.stddev or 1.0)) + F.lit(float(s.mean or 0.0))


def minmax(c: Column, s: ColumnStats, constant: float = 0.0) -> Column:
    """(x - min) / (max - min); a zero range gives ``constant``."""
    if s.min is None:
        return F.lit(None).cast("double")
    rng = float(s.max) - float(s.min)
    if rng == 0.0:
        return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(F.lit(float(constant)))
    return (c.cast("double") - F.lit(float(s.min))) / F.lit(rng)


def minmax_scale(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    label: str | None = None,
    stats=None,
    constant: float = 0.0,
) -> DataFrame:
    """Scale columns to [0, 1] over **all** rows (E8); the label is left as is."""
    cols = list(columns) if columns is not None else feature_columns(df, label)
    cols = [c for c in cols if c != label]
    st = _as_stats(stats if stats is not None else scaling_stats(df, cols))
    return df.withColumns({c: minmax(_q(c), st[c], constant) for c in cols if c in st})
