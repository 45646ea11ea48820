"""Deterministic row hashes.

Spark's ``sample`` and ``randomSplit`` depend on how the input happens to be
partitioned; the same seed gives other rows after a repartition.  These
expressions depend only on a row's key values and a seed, so a split, a
sample or a batch order is the same on any cluster layout, and any SQL
engine can compute the same values.

* Integer keys (the common case: surrogate ids) are folded key by key with
  ``h = (h * STEP + key * KEY_MULT) mod KEY_PRIME``, then mixed on 32 bits by
  shifts, xors and two multiplications (a finalizer: an affine map alone
  leaves the keys on a lattice).  Bigint arithmetic without overflow, inside
  whole-stage codegen; any SQL engine can compute the same values.
* Other keys (strings, dates, several typed columns, whole rows) use the
  low 32 bits of Spark's seeded ``xxhash64``: also inside codegen, under a
  microsecond per row (an md5 prefix, which any SQL engine could recompute,
  measured ~10x more CPU per row).  It is Spark's own function, so the
  queries checked against SQL hash integer keys.

``h32`` is in [0, 2^32); the batch and sample order is (h32, keys...).  Every
purpose has a tag that is mixed into the seed, so that a sample, a split, strata
and batches made with the same keys and seed are independent of each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TWO_POW_32 = 4294967296.0

# Fixed values of the integer hash: a prime below 2^32, two multipliers below
# 2^30 (so no product exceeds 2^62), the finalizer's two multipliers below 2^31
# and the multiplier of the tag.
KEY_PRIME = 4294967291
STEP = 1000000007
KEY_MULT = 805306457
MIX_1 = 0x21F0AAAD
MIX_2 = 0x735A2D97
TAG_MULT = 2654435761
MASK_32 = 0xFFFFFFFF

# Tags of the purposes.
SAMPLE, SPLIT, STRATA, BATCH = 1, 2, 3, 4


def tagged_seed(seed: int, tag: int) -> int:
    """The seed of one purpose, below 2^32."""
    return (int(seed) + tag * TAG_MULT) % KEY_PRIME


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _col(k: str | Column) -> Column:
    return F.col(f"`{k}`") if isinstance(k, str) else k


def integral_keys(df: DataFrame | None, keys: Sequence[str | Column]) -> bool:
    """True when every key is a named integer column of ``df``."""
    if df is None or not keys:
        return False
    types = {f.name: f.dataType for f in df.schema.fields}
    return all(isinstance(k, str) and isinstance(types.get(k), _INTEGRAL) for k in keys)


def int_h32(keys: Sequence[str | Column], seed: int, tag: int = 0) -> Column:
    """Mixed hash of integer keys into [0, 2^32).

    A null key folds like a key of 0, so every row gets a hash (a split or a
    batch order keeps every row); the xxhash64 path skips null keys likewise.
    """
    h = F.lit(tagged_seed(seed, tag)).cast("bigint")
    for k in keys:
        folded = F.coalesce(F.pmod(_col(k).cast("bigint"), F.lit(KEY_PRIME)), F.lit(0).cast("bigint"))
        h = F.pmod(F.pmod(h * F.lit(STEP), F.lit(KEY_PRIME)) + F.pmod(folded * F.lit(KEY_MULT), F.lit(KEY_PRIME)),
                   F.lit(KEY_PRIME))
    for shift, mult in ((16, MIX_1), (15, MIX_2)):
        h = (h.bitwiseXOR(F.shiftright(h, shift)) * F.lit(mult)).bitwiseAND(F.lit(MASK_32))
    return h


def other_h32(keys: Sequence[str | Column], seed: int, tag: int = 0) -> Column:
    """Low 32 bits of ``xxhash64(seed, keys...)``; null keys are skipped (no null result)."""
    return F.pmod(F.xxhash64(F.lit(tagged_seed(seed, tag)), *[_col(k) for k in keys]), F.lit(1 << 32))


def h32(keys: Sequence[str | Column], seed: int, df: DataFrame | None = None, tag: int = 0) -> Column:
    """Row hash in [0, 2^32): integer mixing hash for integer keys of ``df``, else seeded xxhash64."""
    if not keys:
        raise ValueError("at least one key column is needed for a deterministic hash")
    if integral_keys(df, keys):
        return int_h32(keys, seed, tag)
    return other_h32(keys, seed, tag)


def order_key(keys: Sequence[str | Column], seed: int, df: DataFrame | None = None, tag: int = 0) -> Column:
    """Leading sort key of the hash order: ``h32`` (ties are broken by the keys)."""
    return h32(keys, seed, df, tag)


def unit_hash(keys: Sequence[str | Column], seed: int, df: DataFrame | None = None, tag: int = 0) -> Column:
    """The key hash mapped to [0, 1)."""
    return h32(keys, seed, df, tag) / F.lit(TWO_POW_32)


def hash_below(keys: Sequence[str | Column], seed: int, fraction: float, df: DataFrame | None = None,
               tag: int = SAMPLE) -> Column:
    """True for about ``fraction`` of the key values: h32 < floor(fraction * 2^32)."""
    return h32(keys, seed, df, tag) < F.lit(int(fraction * TWO_POW_32))
