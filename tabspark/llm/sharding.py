"""Shards of near-equal bytes by histogram sort.

Method: rows are ordered by (hash of the text, doc_id), so equal texts lie
together.  Candidate boundaries between keys are probed: one pass counts
exactly the bytes and rows below every probe, summed over all partitions; each
boundary's bracket shrinks to the probes next to its target and is probed again
until a probe is within tolerance or no row is left between the two.  Only
then do rows move, once, into their ranges.  A boundary falls between groups of
equal texts where that meets the tolerance, and inside a group (by doc_id)
where the group is larger.

The driver holds (shards - 1) x probes counts per pass.  The passes and the
exchange run on narrow rows: the text is read once.

Defined results: a null text has no bytes and the hash of an empty one; null
doc_ids come first in their group; rows equal in both text and doc_id stay in one
shard; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabspark.llm.common import checkpointed, private
from tabspark.operators.ranking import global_rank

SHARDS = 24
TOLERANCE = 0.005  # of a shard's bytes
PROBES = 16  # per boundary and pass
ROW_BYTES = 8  # counted for each row besides its text

LOWEST = -(1 << 63)
Key = tuple[int, int]


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, h, d): narrow rows with their sort key."""
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(ROW_BYTES)).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("d"))


def bytes_between(rows: DataFrame, probes: list[Key]) -> list[tuple[int, int]]:
    """(bytes, rows) in each of the len(probes) + 1 ranges that the sorted probes cut."""
    ph, pd = (np.array([p[i] for p in probes], dtype=np.int64) for i in (0, 1))
    n = len(probes) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, count = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        for batch in batches:
            h, d, s = (batch.column(i).to_numpy() for i in range(3))
            first, last = np.searchsorted(ph, h, "left"), np.searchsorted(ph, h, "right")
            at = first.copy()
            for k in np.unique(first[first < last]):  # probes inside this row's group
                same = (first == k) & (first < last)
                at[same] = k + np.searchsorted(pd[k:last[same][0]], d[same], "right")
            np.add.at(size, at, s)
            count += np.bincount(at, minlength=n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n, dtype=np.int32)), pa.array(size), pa.array(count)],
                                         ["at", "size", "n"])

    counted = (rows.select("h", "d", "size").mapInArrow(run, "at int, size long, n long")
               .groupBy("at").agg(F.sum("size").alias("size"), F.sum("n").alias("n")))
    found = {r["at"]: (r["size"], r["n"]) for r in counted.collect()}
    return [found.get(i, (0, 0)) for i in range(n)]


def between(lo: Key, hi: Key, d_range: tuple[int, int], n: int) -> list[Key]:
    """Up to n keys strictly between lo and hi: group boundaries first, doc_ids once one group is left."""
    d_lo, d_hi = d_range
    if hi[0] - lo[0] > 1:
        step = hi[0] - lo[0]
        return sorted({(lo[0] + step * k // (n + 1), d_lo) for k in range(1, n + 1)} - {lo, hi})
    if hi[0] > lo[0] and hi[1] > d_lo and hi != (hi[0], d_lo):  # the group boundary itself is in between
        return [(hi[0], d_lo)]
    top = hi[1] if hi[0] == lo[0] else d_hi + 1
    step = top - lo[1]
    return sorted({(lo[0], lo[1] + step * k // (n + 1)) for k in range(1, n + 1)} - {lo, hi})


def splitters(rows: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE,
              probes: int = PROBES) -> list[tuple[Key, int]]:
    """The (key, rows below it) of each boundary between shards; a row belongs above the key it equals."""
    t = rows.agg(F.sum("size"), F.count(F.lit(1)), F.min("h"), F.max("h"), F.min("d"), F.max("d")).first()
    total, n_rows, h_lo, h_hi, d_lo, d_hi = t
    if not n_rows:
        return []
    low, high = (h_lo, d_lo), ((h_hi, d_hi + 1) if d_hi < (1 << 63) - 1 else (h_hi, d_hi))
    known: dict[Key, tuple[int, int]] = {low: (0, 0), high: (total, n_rows)}
    targets = [total * k // shards for k in range(1, shards)]
    while True:
        keys = sorted(known)
        below = [known[k][0] for k in keys]
        asked: set[Key] = set()
        for target in targets:
            i = max(1, bisect_left(below, target))
            lo, hi = keys[i - 1], keys[min(i, len(keys) - 1)]
            near = min(abs(known[lo][0] - target), abs(known[hi][0] - target))
            if near > tolerance * total / shards and known[hi][1] - known[lo][1] > 1:
                asked.update(between(lo, hi, (d_lo, d_hi), probes))
        asked -= set(known)
        if not asked:
            break
        new = sorted(asked)
        size = n = 0
        for key, (more, rows_more) in zip(new, bytes_between(rows, new)):
            size, n = size + more, n + rows_more
            known[key] = (size, n)
    keys = sorted(known)
    nearest = [min(keys, key=lambda k: (abs(known[k][0] - target), k)) for target in targets]
    return [(k, known[k][1]) for k in nearest]


def shard_of(bounds: list[tuple[Key, int]], h: str = "h", d: str = "d") -> Column:
    out = F.lit(0)
    for (bound_h, bound_d), _ in bounds:
        out = out + ((F.col(h) > bound_h) | ((F.col(h) == bound_h) & (F.col(d) >= bound_d))).cast("int")
    return out.alias("shard")


def shard_documents(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): every row's shard and its gapless place there, in key order."""
    rows = checkpointed(keyed(docs))
    bounds = splitters(rows, shards, tolerance)
    ranked = global_rank(rows, [F.col("h"), F.col("d")], "place")
    first = F.lit(0).cast("long")
    for k, (_, below) in enumerate(bounds):
        first = F.when(F.col("shard") > k, F.lit(below).cast("long")).otherwise(first)
    return (ranked.withColumn("shard", shard_of(bounds)).withColumn("slot", F.col("place") - first)
            .select("doc_id", "size", "text_crc32", "shard", "slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, tolerance: float = TOLERANCE) -> str:
    """Write whole rows under ``path``/shard=k, each shard in key order over as many files as its ranges.

    Every column of ``docs`` is written.  The folders' column, whose name is returned, is ``shard``, or ``shard_``
    (and so on) where ``docs`` has one of that name.
    """
    h, d, shard = (private(c, docs) for c in ("h", "d", "shard"))
    bounds = splitters(checkpointed(keyed(docs)), shards, tolerance)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    whole = (docs.withColumn(h, F.xxhash64(text))
             .withColumn(d, F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST))))
    parts = whole.withColumn(shard, shard_of(bounds, h, d)).repartitionByRange(h, d).sortWithinPartitions(h, d)
    parts.drop(h, d).write.partitionBy(shard).parquet(path)
    return shard
