"""Dense category indexes (T4).

Categories are numbered 0, 1, ... by falling frequency, ties by value (the
``StringIndexer`` "frequencyDesc" order).  The category table has one row per
distinct value; it is numbered with the distributed ``global_rank`` (no
single-partition window) and joined back by broadcast only when its size is
checked to be small, otherwise by a shuffle join whose skewed partitions AQE
splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import ranked_with_total

# Category tables up to this many rows are broadcast to the scoring join.
BROADCAST_MAX_CATEGORIES = 100_000


def category_index(df: DataFrame, column: str, index_col: str = "index") -> DataFrame:
    """(column, count, index) for every distinct non-null value."""
    return _category_index_counted(df, column, index_col)[0]


def _category_index_counted(df: DataFrame, column: str, index_col: str = "index") -> tuple[DataFrame, int]:
    """``category_index`` plus the number of categories (known from the rank offsets)."""
    c = F.col(f"`{column}`")
    counts = df.where(c.isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("count"))
    return ranked_with_total(counts, [F.col("count").desc(), c.asc()], index_col)


def index_categories(
    df: DataFrame,
    column: str,
    output_col: str | None = None,
    index: DataFrame | None = None,
) -> DataFrame:
    """Add ``output_col`` (default ``<column>_index``) with the category's index.

    Values missing from ``index`` (and nulls) get null.
    """
    out = output_col or f"{column}_index"
    if index is None:
        idx, n_categories = _category_index_counted(df, column)
    else:
        idx, n_categories = index, index.count()
    lookup = idx.select(F.col(f"`{column}`").alias("__cat"), F.col("index").cast("double").alias(out))
    if n_categories <= BROADCAST_MAX_CATEGORIES:
        lookup = F.broadcast(lookup)
    return df.join(lookup, F.col(f"`{column}`") == F.col("__cat"), "left").drop("__cat")
