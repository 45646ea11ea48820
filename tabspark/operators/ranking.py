"""Distributed row numbering without a single-partition window.

Rows ordered by a hash are numbered by ``hash_ranked``: a histogram of the
hash's leading bits gives the number of rows before each bucket, and
``row_number`` inside the bucket does the rest.  One shuffle of the rows, no sampling job,
nothing written.

Any other order, and a hash with a hot value, goes through ``global_rank``.

``row_number() over (order by ...)`` with no ``partitionBy`` moves every row
into one task.  Here the rows are range-partitioned on the sort key (Spark
samples the key to pick balanced bounds), sorted inside each partition, and
numbered as ``partition offset + position``.  The offsets come from the
per-partition row counts: one row per partition, so a small table whose size
is bounded by the partition count, joined by broadcast.

A run of equal sort keys (one key holding a third of all rows) cannot be
split by a range partitioner, so a stable row id is always appended as the
last sort key; equal-keyed rows are then spread over as many partitions as
their volume needs.

The sorted frame, with its partition id and in-partition position as
columns, is written once as a parquet table under the session's reliable
checkpoint folder: the counts and the numbering then see exactly the same
rows, and a lost executor does not re-run the range sampling with other
bounds.  Counting reads only the partition-id column of that table (a
``checkpoint()`` would be re-read whole, row by row), and readers of the
result get parquet's column pruning.  The numbering uses the stored ids,
so it does not depend on how the table is split when read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir, scratch_path

_PID = "__ts_pid"
_MID = "__ts_mid"
_ROWID = "__ts_rowid"
_OFFSET = "__ts_offset"

# A broadcast offsets table holds one row per range partition.
MAX_OFFSET_ROWS = 1_000_000


def _parquet_writable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(_parquet_writable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _parquet_writable(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return _parquet_writable(dtype.keyType) and _parquet_writable(dtype.valueType)
    return not isinstance(dtype, (T.NullType, T.CalendarIntervalType, T.DayTimeIntervalType,
                                  T.YearMonthIntervalType, T.UserDefinedType))


def global_rank(
    df: DataFrame,
    order: Sequence[Column],
    rank_col: str = "rank",
    partitions: int | None = None,
) -> DataFrame:
    """Add ``rank_col`` = 0-based position of each row in ``order``.

    ``partitions`` fixes the number of ranges; by default it is the
    session's shuffle partitions, which AQE may coalesce.  The result is
    not sorted; order by ``rank_col`` where an order is needed.
    """
    return ranked_with_total(df, order, rank_col, partitions)[0]


def ranked_with_total(
    df: DataFrame,
    order: Sequence[Column],
    rank_col: str = "rank",
    partitions: int | None = None,
) -> tuple[DataFrame, int]:
    """``global_rank`` plus the total row count (known from the offsets)."""
    spark = df.sparkSession
    n_parts = int(partitions or int(spark.conf.get("spark.sql.shuffle.partitions")))
    if n_parts > MAX_OFFSET_ROWS:
        raise ValueError(f"at most {MAX_OFFSET_ROWS} range partitions")
    keyed = df.withColumn(_ROWID, F.monotonically_increasing_id())
    sort_cols = list(order) + [F.col(_ROWID)]
    if partitions:
        ranged = keyed.repartitionByRange(n_parts, *sort_cols)
    else:
        # AQE may merge neighbouring ranges (order is kept) to its advisory size.
        ranged = keyed.repartitionByRange(*sort_cols)
    ranged = ranged.sortWithinPartitions(*sort_cols)
    ranged = ranged.withColumn(_PID, F.spark_partition_id()).withColumn(_MID, F.monotonically_increasing_id())
    if _parquet_writable(ranged.schema):
        path = scratch_path(spark, f"ranked/{uuid.uuid4().hex}")
        ranged.write.parquet(path)
        ranged = spark.read.parquet(path)
    else:
        # Types parquet cannot store (void, intervals): Spark's own checkpoint.
        ensure_checkpoint_dir(spark)
        ranged = ranged.checkpoint(eager=True)
    counts = ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias("n")).collect()
    offsets, running = [], 0
    for row in sorted(counts, key=lambda r: r[_PID]):
        offsets.append((row[_PID], running))
        running += row["n"]
    offsets_df = spark.createDataFrame(offsets or [(0, 0)], f"{_PID} int, {_OFFSET} bigint")
    # monotonically_increasing_id = partition id << 33 | position in partition.
    position = F.col(_MID) - F.shiftleft(F.col(_PID).cast("bigint"), 33)
    ranked = (ranged.join(F.broadcast(offsets_df), _PID)
              .withColumn(rank_col, F.col(_OFFSET) + position)
              .drop(_PID, _MID, _ROWID, _OFFSET))
    return ranked, running


# The histogram has 2^16 buckets (2^13 in each group); a bucket is sorted by one task.  One of
# more than a million rows that is also eight times the mean holds a hot hash value.
BUCKET_BITS = 16
GROUP_BUCKET_BITS = 13
HOT_ROWS = 1_000_000
HOT_TIMES = 8


def hash_ranked(
    df: DataFrame,
    h: Column,
    order: Sequence[Column],
    rank_col: str,
    total_col: str,
    within: Sequence[str] = (),
    partitions: int | None = None,
) -> tuple[DataFrame, dict[tuple, int]]:
    """0-based rank by (``h``, ``order``) and the row count, in each group of the ``within`` columns.

    ``h`` is a hash in [0, 2^32).  Rows that agree in ``h`` and ``order`` may take each
    other's ranks, so ``order`` should end in a hash of the whole row.  The
    groups are few (their histograms reach the driver) and not null.
    """
    spark, within = df.sparkSession, list(within)
    bits = GROUP_BUCKET_BITS if within else BUCKET_BITS
    keyed = df.withColumn(_PID, F.shiftright(h, 32 - bits).cast("int"))
    found = keyed.groupBy(*within, _PID).agg(F.count(F.lit(1)).alias("n")).toArrow().sort_by(
        [(c, "ascending") for c in [*within, _PID]])
    n = found.column("n").to_numpy().astype(np.int64)
    groups = list(zip(*[found.column(c).to_pylist() for c in within])) if within else [()] * len(n)
    totals: dict[tuple, int] = {}
    for g, k in zip(groups, n.tolist()):
        totals[g] = totals.get(g, 0) + k
    if len(n) and n.max() > max(HOT_ROWS, HOT_TIMES * n.sum() / (len(totals) << bits)):
        ranked = global_rank(df, [*[F.col(c) for c in within], h, *order], rank_col, partitions)
        first = dict(zip(sorted(totals), np.cumsum([0, *[totals[g] for g in sorted(totals)]])))
        rows = [(*g, int(first[g]), totals[g]) for g in totals]
        schema = [df.schema[c] for c in within]
        table = spark.createDataFrame(rows, T.StructType(schema + [T.StructField(_OFFSET, T.LongType()),
                                                                   T.StructField(total_col, T.LongType())]))
        joined = ranked.join(F.broadcast(table), within) if within else ranked.crossJoin(F.broadcast(table))
        return joined.withColumn(rank_col, F.col(rank_col) - F.col(_OFFSET)).drop(_OFFSET), totals
    before = np.cumsum(n) - n
    start: dict[tuple, int] = {}
    for g, k in zip(groups, before.tolist()):
        start.setdefault(g, k)
    table = found.drop_columns(["n"]).append_column(
        _OFFSET, pa.array(before - np.array([start[g] for g in groups], dtype=np.int64), pa.int64())).append_column(
        total_col, pa.array([totals[g] for g in groups], pa.int64()))
    position = F.row_number().over(Window.partitionBy(*within, _PID).orderBy(h, *order))
    ranked = (keyed.withColumn(rank_col, position.cast("bigint"))
              .join(F.broadcast(spark.createDataFrame(table)), [*within, _PID])  # a row per bucket
              .withColumn(rank_col, F.col(rank_col) + F.col(_OFFSET) - 1).drop(_PID, _OFFSET))
    return ranked, totals
