"""Schema inspection and column editing.

Presence is tested with ``name in df.columns``; an attribute test would also
accept DataFrame method names such as ``count``.  Missing names are a no-op
with a warning by default, or an error with ``errors="raise"``.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import is_numeric


def _missing(df: DataFrame, name: str, action: str, errors: str) -> None:
    msg = f"{name!r} is not a column ({action} skipped)"
    if errors == "raise":
        raise KeyError(msg)
    warnings.warn(msg, stacklevel=3)


def numeric_columns(df: DataFrame, strict: bool = False) -> list[str]:
    """Names of numeric columns (P1); ``strict`` keeps only int and double."""
    return [f.name for f in df.schema.fields if is_numeric(f.dataType, strict)]


def non_numeric_columns(df: DataFrame, strict: bool = False) -> list[str]:
    """Complement of ``numeric_columns``."""
    numeric = set(numeric_columns(df, strict))
    return [c for c in df.columns if c not in numeric]


def column_dtype(df: DataFrame, name: str, errors: str = "warn") -> str | None:
    """Spark type name (``simpleString``) of a column, None if absent."""
    for field in df.schema.fields:
        if field.name == name:
            return field.dataType.simpleString()
    _missing(df, name, "find column type", errors)
    return None


def columns_of_type(df: DataFrame, dtype: str = "string") -> list[str]:
    """Columns whose type name equals ``dtype``."""
    return [f.name for f in df.schema.fields if f.dataType.simpleString() == dtype]


def dtype_table(df: DataFrame) -> list[tuple[str, str, bool]]:
    """(column, type name, is numeric) for every column, in schema order."""
    return [(f.name, f.dataType.simpleString(), is_numeric(f.dataType)) for f in df.schema.fields]


# Tables up to this many columns are counted in one wide aggregate.
WIDE_MAX_COLUMNS = 16


def dtype_profile(df: DataFrame) -> DataFrame:
    """(column_name, dtype, is_numeric, non_null) for every column (P1-P4 with counts).

    The dtype listing of ``dtype_table`` plus each column's count of
    non-null values over all rows: one aggregate pass (a wide aggregate for
    narrow tables, else unpivoted to one (column, present) pair per cell).
    """
    listing = dtype_table(df)
    if len(listing) <= WIDE_MAX_COLUMNS:
        counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, (c, _, _) in enumerate(listing)])
        return counts.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("dtype"), F.lit(num).alias("is_numeric"),
                     F.col(f"n{i}").alias("non_null"))
            for i, (c, t, num) in enumerate(listing)])))
    cells = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").isNotNull().alias("present"))
        for i, (c, _, _) in enumerate(listing)])))
    counts = cells.groupBy("i").agg(F.count_if("present").alias("non_null"))
    names = df.sparkSession.createDataFrame(
        [(i, c, t, num) for i, (c, t, num) in enumerate(listing)],
        "i int, column_name string, dtype string, is_numeric boolean")
    # One row per column on both sides.
    return (names.join(F.broadcast(counts), "i", "left")
            .select("column_name", "dtype", "is_numeric", F.coalesce("non_null", F.lit(0)).alias("non_null")))


def drop_columns(df: DataFrame, names: Iterable[str], errors: str = "warn") -> DataFrame:
    """Drop the named columns that exist."""
    present = []
    for name in names:
        if name in df.columns:
            present.append(name)
        else:
            _missing(df, name, "drop column", errors)
    return df.drop(*present) if present else df


def rename_columns(df: DataFrame, pairs: Sequence[tuple[str, str]], errors: str = "warn") -> DataFrame:
    """Rename (old, new) pairs in list order, so a->b, b->c chains.

    A target that already names another column raises: Spark would keep two
    columns of the same name.
    """
    names = list(df.columns)
    for old, new in pairs:
        if old not in names:
            _missing(df, old, "rename column", errors)
            continue
        if new != old and new in names:
            raise ValueError(f"cannot rename {old!r} to {new!r}: a column of that name exists")
        names = [new if n == old else n for n in names]
    if names == list(df.columns):
        return df
    # One projection for all renames.
    return df.select([F.col(f"`{o}`").alias(n) for o, n in zip(df.columns, names)])


def modify_columns(df: DataFrame, pairs: Sequence[tuple[str, Column]], errors: str = "warn") -> DataFrame:
    """Replace existing columns by expressions, in order.

    A later expression sees an earlier result when it refers to the column by
    name; Catalyst collapses the chain into one projection.
    """
    for name, expr in pairs:
        if name in df.columns:
            df = df.withColumn(name, expr)
        else:
            _missing(df, name, "modify column", errors)
    return df


def feature_columns(df: DataFrame, label: str | None = None, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns other than the label and the excluded ones.

    The label is matched by its exact name.
    """
    skip = set(exclude)
    if label is not None:
        skip.add(label)
    return [c for c in numeric_columns(df) if c not in skip]


def select_numeric(df: DataFrame, label: str | None = None) -> DataFrame:
    """Project the numeric columns, plus the label if it is not numeric."""
    cols = numeric_columns(df)
    if label is not None and label not in cols:
        cols.append(label)
    return df.select(*[F.col(f"`{c}`") for c in cols])
