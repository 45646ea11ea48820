"""Minibatches.

The reference shuffles rows round-robin into ``count // batch_size``
partitions and streams them to the driver one by one.  Here a batch is a
``batch_id`` column: every row gets a deterministic position in the order of
its key hash (``hash_ranked``: a histogram of the hash, one shuffle of the rows), and

* ``mode="equal"``: ``n // batch_size`` batches whose sizes differ by at most
  one (the reference's semantics, no row dropped): ``batch_id = rank mod nb``;
* ``mode="fixed"``: batches of exactly ``batch_size`` rows, the last one
  shorter: ``batch_id = rank div batch_size``.

The assignment is the same in every epoch and on every cluster layout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import BATCH, order_key
from .ranking import hash_ranked


def batch_count(n_rows: int, batch_size: int) -> int:
    """Number of batches of the reference, at least one."""
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    return max(1, int(n_rows) // int(batch_size))


def batch_counts(frames: dict[str, DataFrame], batch_size: int) -> DataFrame:
    """(split, rows, batches) for each named frame (L5); one count job for all frames."""
    names = list(frames)
    if not names:
        raise ValueError("no frames")
    tagged = [df.select(F.lit(i).alias("__split")) for i, df in enumerate(frames.values())]
    union = tagged[0]
    for t in tagged[1:]:
        union = union.unionByName(t)
    counts = {r["__split"]: r["n"] for r in union.groupBy("__split").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = [(name, counts.get(i, 0), batch_count(counts.get(i, 0), batch_size)) for i, name in enumerate(names)]
    return union.sparkSession.createDataFrame(rows, "split string, rows bigint, batches bigint")


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    return isinstance(dtype, (T.NumericType, T.StringType, T.BooleanType, T.DateType,
                              T.TimestampType, T.TimestampNTZType))


def _hashable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _hashable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_hashable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType, T.CalendarIntervalType))


def hash_order(df: DataFrame, keys: Sequence[str] | None, seed: int) -> list[Column]:
    """Sort key of the batch order: the key hash, then the keys themselves.

    Without keys the hash covers every orderable column (full-row order);
    equal rows are interchangeable, so their relative order does not matter.
    """
    cols = list(keys) if keys else [f.name for f in df.schema.fields if _orderable(f.dataType)]
    if keys:
        return [order_key(cols, seed, df, BATCH)] + [F.col(f"`{c}`") for c in cols]
    return [order_key([F.col(f"`{c}`") for c in cols], seed, None, BATCH)] + [F.col(f"`{c}`") for c in cols]


def assign_batches(
    df: DataFrame,
    batch_size: int,
    keys: Sequence[str] | None = None,
    seed: int = 0,
    mode: str = "equal",
    n_batches: int | None = None,
    partitions: int | None = None,
    within: Sequence[str] = (),
) -> DataFrame:
    """Add ``batch_id`` and ``batch_pos`` (B1).

    ``within``: columns of a few groups, each with batches of its own;
    ``partitions``: ranges that a hash with a hot value is cut into.
    Cost: one aggregate of the keys' hashes (at most 65,536 rows to the driver)
    and one shuffle of the rows by hash; no row passes through a single task
    or the driver.  ``df`` is read twice, so it must be the same both times.
    """
    return assign_batches_counted(df, batch_size, keys, seed, mode, n_batches, partitions, within)[0]


def assign_batches_counted(
    df: DataFrame,
    batch_size: int,
    keys: Sequence[str] | None = None,
    seed: int = 0,
    mode: str = "equal",
    n_batches: int | None = None,
    partitions: int | None = None,
    within: Sequence[str] = (),
) -> tuple[DataFrame, int | dict[tuple, int]]:
    """``assign_batches`` plus the number of batches (with ``within``: of each group)."""
    if mode not in ("equal", "fixed"):
        raise ValueError("mode must be 'equal' or 'fixed'")
    h, *order = hash_order(df, keys, seed)
    # Rows that share all keys are told apart by their content: a task that is run again ranks them alike.
    row_hash = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if _hashable(f.dataType)])
    ranked, totals = hash_ranked(df, h, [*order, row_hash], "_rank", "_total", within, partitions)
    r, size = F.col("_rank"), F.lit(int(batch_size))
    if mode == "equal":
        nb = F.lit(int(n_batches)) if n_batches else F.greatest(F.lit(1), F.floor(F.col("_total") / size))
        bid, pos = F.pmod(r, nb), F.floor(r / nb)
        counts = {g: int(n_batches) if n_batches else batch_count(t, batch_size) for g, t in totals.items()}
    else:
        bid, pos = F.floor(r / size), F.pmod(r, size)
        counts = {g: max(1, -(-t // batch_size)) for g, t in totals.items()}
    out = ranked.withColumns({"batch_id": bid.cast("bigint"), "batch_pos": pos.cast("bigint")}).drop("_rank", "_total")
    return out, counts if within else counts.get((), 1)


def group_batches(df: DataFrame, partitions: int | None = None, within: Sequence[str] = ()) -> DataFrame:
    """Co-locate each batch in one partition, rows in batch order.

    Batches of the same number of all groups share a partition, group after group.

    A batch holds ``batch_size`` rows, so no partition holds more than its
    share of batches; hot keys do not matter because batches are built from
    the row rank, not from key values.
    """
    n = int(partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(n, "batch_id").sortWithinPartitions(*within, "batch_id", "batch_pos")


def batch_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per batch: rows and the mean of each column (B2 check)."""
    return df.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.avg(F.col(f"`{c}`")).alias(f"mean_{c}") for c in columns],
    )
