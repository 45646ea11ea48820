"""Limits, samples and splits.

``sample`` and ``randomSplit`` (the reference's calls) depend on the input's
partitioning.  The ``hash_*`` operators decide per row from a hash of its key
values and a seed: a pure filter that Catalyst pushes next to the scan, the
same on any layout and in any engine that can compute the same hash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import SPLIT, STRATA, TWO_POW_32, h32, hash_below
from .batches import _orderable
from ..session import ensure_checkpoint_dir
from .ranking import global_rank


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def head_rows(df: DataFrame, n: int = 5, order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """First ``n`` rows (L1, L2); with ``order_by`` a deterministic top-n.

    An ordered head is a ``TakeOrderedAndProject``: every task keeps only its
    own top ``n`` rows.
    """
    if order_by:
        return df.orderBy(*[_q(c) if isinstance(c, str) else c for c in order_by]).limit(n)
    return df.limit(n)


def random_sample(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    """Bernoulli sample without replacement, as the reference (L3); layout-dependent."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_sample(df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 0) -> DataFrame:
    """Rows whose key hash falls below ``fraction`` (L3, deterministic)."""
    if fraction >= 1.0:
        return df
    return df.where(hash_below(keys, seed, fraction, df))


def hash_side(df: DataFrame, keys: Sequence[str], weights: Sequence[float], seed: int = 0,
              side_col: str = "side") -> DataFrame:
    """Add the index of the split a row belongs to (L4)."""
    total = float(sum(weights))
    bounds, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        bounds.append(int(acc * TWO_POW_32))
    h = h32(keys, seed, df, SPLIT)
    expr = F.lit(len(weights) - 1)
    for i in range(len(bounds) - 1, -1, -1):
        expr = F.when(h < F.lit(bounds[i]), F.lit(i)).otherwise(expr)
    return df.withColumn(side_col, expr.cast("int"))


def hash_split(df: DataFrame, keys: Sequence[str], weights: Sequence[float] = (0.8, 0.2),
               seed: int = 0) -> list[DataFrame]:
    """Deterministic ``randomSplit`` (L4): each side is a filter on the key hash."""
    total = float(sum(weights))
    out, lo = [], 0.0
    h = h32(keys, seed, df, SPLIT)
    for i, w in enumerate(weights):
        hi = lo + w / total
        cond = h >= F.lit(int(lo * TWO_POW_32))
        if i < len(weights) - 1:
            cond = cond & (h < F.lit(int(hi * TWO_POW_32)))
        out.append(df.where(cond))
        lo = hi
    return out


def train_val_split(df: DataFrame, val_ratio: float = 0.2, seed: int = 3,
                    keys: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, validation) (L4): by key hash when ``keys`` are given, else ``randomSplit``."""
    if keys:
        train, val = hash_split(df, keys, (1.0 - val_ratio, val_ratio), seed)
    else:
        train, val = df.randomSplit([1.0 - val_ratio, val_ratio], seed=seed)
    return train, val


HASH_BUCKET_BITS = 16
# Rows that share the last hash value of a sample, up to this many, are ranked with a window partitioned by
# class (one task per class holds at most this many rows); more (a hot key) go
# through the range-partitioned global_rank.
WINDOW_MAX_ROWS = 2_000_000
# Per-class tables (one row per class) are broadcast up to this many classes;
# beyond it they are joined by a shuffle join.
BROADCAST_MAX_CLASSES = 100_000


def _until(counts: DataFrame, by: str, need: Column, names: tuple[str, str, str]) -> DataFrame:
    """Per class, the least ``by`` up to which ``need`` rows lie: (__ecls, value, rows before it, rows at it).

    ``counts`` (__cls, by, __n, ...) holds at most 65,536 rows of a class.
    """
    cum = F.sum("__n").over(Window.partitionBy("__cls").orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (counts.withColumn("__cum", cum).where((F.col("__cum") >= need) & (F.col("__cum") - F.col("__n") < need))
            .select(F.col("__cls").alias("__ecls"), F.col(by).alias(names[0]), (F.col("__cum") - F.col("__n")).alias(names[1]),
                    F.col("__n").alias(names[2])))


def _per_class(df: DataFrame) -> tuple[DataFrame, list | None]:
    """A one-row-per-class table, computed once, and its rows if they are few.

    Up to ``BROADCAST_MAX_CLASSES`` rows are read and broadcast; more are written to the checkpoint folder.
    """
    rows = df.limit(BROADCAST_MAX_CLASSES + 1).collect()
    if len(rows) <= BROADCAST_MAX_CLASSES:
        return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)), rows
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True), None


def stratified_sample(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    n_per_class: int | None = None,
    seed: int = 0,
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """Balanced sample (T1): the first ``n`` rows of every class in key-hash order.

    ``n`` defaults to the size of the smallest class, so every class is
    equally represented.  Rows are ordered by (key hash, keys, ``tiebreak``
    columns: all other orderable columns by default), so the sample is the
    same on any layout.

    The sample is one filter over one scan: a row is in it if its hash lies
    below the limit of its class, or at the limit and its keys and tie-break columns do.  The
    limits (one row per class) come from aggregates of the keys and the label:

    1. a histogram of the top 16 hash bits per class gives the class sizes and, by a
       running sum, the bucket holding each class's n-th row;
    2. a histogram of the other 16 bits inside these buckets gives the n-th hash value and the rows that share it;
    3. only where not all of those belong to the sample, they are ranked: by a window
       partitioned by class if they are few, else (a hot key) by ``global_rank``.

    Where equal rows straddle the limit no filter can tell them apart, and as many
    of them as are needed are added by rank.
    """
    ties = list(tiebreak) if tiebreak is not None else [
        f.name for f in df.schema.fields if f.name not in keys and f.name != label and _orderable(f.dataType)]
    spark, whole_hash = df.sparkSession, 1 << 32
    tagged = df.withColumn("__h", h32(keys, seed, df, STRATA))
    bucket = F.shiftright("__h", 32 - HASH_BUCKET_BITS)
    hist = (tagged.groupBy(_q(label).alias("__cls"), bucket.alias("__bucket")).agg(F.count(F.lit(1)).alias("__n"))
            .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        totals = hist.groupBy("__cls").agg(F.sum("__n").alias("__total"))
        if n_per_class is None:
            smallest = totals.agg(F.min("__total").alias("m")).first()["m"]
            if smallest is None:
                return df
            n = int(smallest)
        else:
            n = int(n_per_class)
        if n <= 0:
            return df.where(F.lit(False))
        edge = _until(hist, "__bucket", F.lit(n), ("__b", "__before", "__size"))
        # A class with fewer than n rows is taken whole: it has no boundary bucket.
        bounds = (totals.join(edge, totals["__cls"].eqNullSafe(edge["__ecls"]), "left")
                  .select("__cls", "__b", (F.lit(n).cast("bigint") - F.col("__before")).alias("__need")))
        bounds, known = _per_class(bounds)
        if known == []:
            return df
    finally:
        hist.unpersist()
    inside = (tagged.select(_q(label).alias("__own"), "__h", bucket.alias("__bucket"))
              .join(bounds, F.col("__own").eqNullSafe(F.col("__cls")) & (F.col("__bucket") == F.col("__b")))
              .groupBy("__cls", "__h").agg(F.count(F.lit(1)).alias("__n"), F.first("__need").alias("__need")))
    last = _until(inside, "__h", F.col("__need"), ("__last", "__less", "__same"))
    limits = bounds.join(last, F.col("__cls").eqNullSafe(F.col("__ecls")), "left").select(
        "__cls", F.coalesce("__last", F.lit(whole_hash).cast("bigint")).alias("__last"),
        F.coalesce(F.col("__need") - F.col("__less"), F.lit(0).cast("bigint")).alias("__take"),
        F.coalesce("__same", F.lit(0).cast("bigint")).alias("__same"))
    limits, known = _per_class(limits)
    placed = tagged.join(limits, _q(label).eqNullSafe(F.col("__cls")))
    own = ["__h", "__cls", "__last", "__take", "__same"]
    if known is not None:
        split = [r["__same"] for r in known if r["__take"] < r["__same"]]
        n_split, n_tied = len(split), sum(split)
    else:
        n_split, n_tied = limits.where("__take < __same").agg(F.count(F.lit(1)), F.sum("__same")).first()
    if not n_split:
        return placed.where("__h <= __last").drop(*own)
    row = F.struct(*[_q(k) for k in keys], *[_q(c) for c in ties])
    at_limit = placed.where("__h = __last and __take < __same")
    if n_tied <= WINDOW_MAX_ROWS:
        ranked = at_limit.withColumn("__pos", F.row_number().over(Window.partitionBy("__cls").orderBy(row)))
    else:
        ranked = global_rank(at_limit, [F.col("__cls"), row], "__rank")
        starts, _ = _per_class(ranked.groupBy(F.col("__cls").alias("__scls")).agg(F.min("__rank").alias("__start")))
        # Null-safe: a null class is a class too.
        ranked = (ranked.join(starts, ranked["__cls"].eqNullSafe(starts["__scls"])).drop("__scls")
                  .withColumn("__pos", F.col("__rank") - F.col("__start") + 1))
    nth = ranked.where("__pos = __take or __pos = __take + 1").groupBy(F.col("__cls").alias("__ecls")).agg(
        F.max(F.when(F.col("__pos") == F.col("__take"), row)).alias("__row"),
        F.max(F.when(F.col("__pos") > F.col("__take"), row)).alias("__next"))
    alike = F.col("__row").eqNullSafe(F.col("__next")).alias("__alike")
    nth, known = _per_class(nth.select("__ecls", "__row", alike))
    if not (any(r["__alike"] for r in known) if known is not None else not nth.where("__alike").isEmpty()):
        placed = placed.join(nth, F.col("__cls").eqNullSafe(F.col("__ecls")), "left")
        kept = placed.where((F.col("__h") < F.col("__last")) | (
            (F.col("__h") == F.col("__last")) & ((F.col("__take") == F.col("__same")) | (row <= F.col("__row")))))
        return kept.drop(*own, "__ecls", "__row", "__alike")
    below = placed.where("__h < __last or (__h = __last and __take = __same)")
    drop = [*own, "__pos", "__rank", "__start"]
    return below.drop(*drop).unionByName(ranked.where("__pos <= __take").drop(*drop))
