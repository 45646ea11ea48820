"""Interaction of filters: what each of five filters removes under every order of applying them.

Method: a document's failures are a mask of five bits.  The orders are ranked
lexicographically (Lehmer code), so all orders that begin with the same letters
are an interval of ranks.  A mask is removed at step s by the filter that
stands there exactly in the intervals of prefixes whose last letter fails and
whose other letters pass.  Its count is added at the start of each interval and
taken off at the end; a prefix sum over the ranks then gives the removals of
every order and step.

Documents are read once and become (part, mask, digest, doc_id) without their
texts.  "Identical to a smaller doc_id's text" needs no join: rows are counted by
(digest, part, doc_id), reduced to totals and the least id's share by (digest,
part), and compared with the least id over the parts of a digest.  Every
step combines before it shuffles, so copies of one text, also a third of all rows, meet as a
few rows per task.  What is left is at most 32 masks per part.

Defined results: a null text is empty; a null lang is the part of the empty
string; a null doc_id is not compared (its row is no copy and makes none) and
has no labels; repeated rows are documents of their own, and of rows that share the least
doc_id of a text none is a copy; labels of one doc_id count if any of their rows says so;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The filters and their limits.
FILTERS = "ABCDE"
LEAST_WORDS = 100
LEAST_DISTINCT_PERCENT = 80
MOST_CAPITALS_PERCENT = 10
SYMBOLS = b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"

N = len(FILTERS)
COPY = 1 << (N - 1)  # bit of filter E
ORDERS = ["".join(p) for p in permutations(FILTERS)]  # in lexicographic order
COUNTS = ["n", "good", "toxic"]

AUDIT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
         "good_lost long, toxic_lost long, shapley long")


def failures(raw: bytes) -> int:
    """Mask of the filters A to D that a text (UTF-8) fails."""
    words = raw.split()  # bytes split at 0x20 and 0x09 to 0x0D only
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    points = len(raw) - len(raw.translate(None, bytes(range(0x80, 0xC0)))) if not raw.isascii() else 0
    return ((len(words) < LEAST_WORDS)
            | (100 * len(set(words)) < LEAST_DISTINCT_PERCENT * len(words)) << 1
            | (100 * capitals > MOST_CAPITALS_PERCENT * (len(raw) - points)) << 2
            | (len(raw.translate(None, SYMBOLS)) < len(raw)) << 3)


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest, mask) of every document: filters A to D, texts replaced by their SHA-256."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, masks = [], []
            for text in batch.column(2).cast(pa.binary()):
                raw = text.as_py()
                digests.append(hashlib.sha256(raw).digest())
                masks.append(failures(raw))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests, pa.binary()),
                                              pa.array(masks, pa.int32())], ["doc_id", "part", "digest", "mask"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                      F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return own.mapInArrow(run, "doc_id long, part string, digest binary, mask int")


def label_flags(labels: DataFrame) -> DataFrame:
    """(doc_id, good, toxic): 1 where a label of the doc_id says so, else 0."""
    is_one = [F.max((F.coalesce(F.col(c), F.lit(0)) == 1).cast("long")).alias(name)
              for c, name in (("quality", "good"), ("toxic", "toxic"))]
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic")
            .where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(*is_one))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by the filters they fail."""
    rows = judged(docs).groupBy("digest", "part", "doc_id").agg(F.max("mask").alias("mask"), F.count(F.lit(1)).alias("n"))
    flags = rows.join(label_flags(labels), "doc_id", "left")
    counted = flags.select("digest", "part", "doc_id", "mask", "n",
                           *[(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in COUNTS[1:]])
    known = F.col("doc_id").isNotNull()
    whole = F.struct(*COUNTS)
    per_part = counted.groupBy("digest", "part").agg(
        F.max("mask").alias("mask"), F.min("doc_id").alias("least"), F.min_by(whole, "doc_id").alias("first"),
        *[F.sum(F.when(known, F.col(c)).otherwise(0)).alias(c) for c in COUNTS],
        *[F.sum(F.when(known, 0).otherwise(F.col(c))).alias(f"{c}_unknown") for c in COUNTS])
    least = per_part.groupBy("digest").agg(F.min("least").alias("first_id"))
    both = per_part.join(least, "digest")
    is_first = F.coalesce(F.col("least") == F.col("first_id"), F.lit(False))
    originals = [F.when(is_first, F.col("first")[c]).otherwise(0) for c in COUNTS]
    passing = F.struct(F.col("mask").alias("mask"), *[(o + F.col(f"{c}_unknown")).alias(c) for c, o in zip(COUNTS, originals)])
    failing = F.struct(F.col("mask").bitwiseOR(F.lit(COPY)).alias("mask"), *[(F.col(c) - o).alias(c) for c, o in zip(COUNTS, originals)])
    return (both.select("part", F.inline(F.array(passing, failing))).where(F.col("n") > 0)
            .groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in COUNTS]))


def prefix_interval(prefix: str) -> tuple[int, int]:
    """Ranks [a, b) of the orders that begin with ``prefix``."""
    left, rank = sorted(FILTERS), 0
    for k, letter in enumerate(prefix, start=1):
        rank += left.index(letter) * factorial(N - k)
        left.remove(letter)
    return rank, rank + factorial(N - len(prefix))


def removal_intervals(mask: int) -> Iterator[tuple[int, int, int]]:
    """(step from 0, first rank, end rank) of the orders in which the mask is removed at that step."""
    fails = [f for k, f in enumerate(FILTERS) if mask >> k & 1]
    passes = [f for f in FILTERS if f not in fails]
    for step in range(len(passes) + 1) if fails else ():
        for before in permutations(passes, step):
            for last in fails:
                yield step, *prefix_interval("".join(before) + last)


def audit_rows(part: str, masks: list[int], counts: np.ndarray) -> dict[str, list]:
    """All rows of one part from its masks and their (n, good, toxic)."""
    n_orders = len(ORDERS)
    ends = np.zeros((len(COUNTS), N, n_orders + 1), dtype=np.int64)
    for mask, own in zip(masks, counts):
        for step, a, b in removal_intervals(mask):
            ends[:, step, a] += own
            ends[:, step, b] -= own
    removed, good, toxic = ends.cumsum(axis=2)[:, :, :n_orders].transpose(0, 2, 1)  # order, step
    letter = np.array([[FILTERS.index(f) for f in order] for order in ORDERS])
    fails = np.array([sum(int(c[0]) for m, c in zip(masks, counts) if m >> k & 1) for k in range(N)])
    alone = np.array([sum(int(c[0]) for m, c in zip(masks, counts) if m == 1 << k) for k in range(N)])
    shapley = np.bincount(letter.ravel(), weights=removed.ravel(), minlength=N).astype(np.int64)
    kept = int(counts[:, 0].sum()) - removed.cumsum(axis=1)
    values = {"kept": kept, "removed": removed, "redundant": fails[letter] - removed, "unique_fails": alone[letter],
              "good_lost": good, "toxic_lost": toxic, "shapley": shapley[letter]}
    return {"part": [part] * (n_orders * N), "filter_order": [o for o in ORDERS for _ in range(N)],
            "step": list(range(1, N + 1)) * n_orders} | {k: v.ravel() for k, v in values.items()}


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step; see the module's docstring."""
    schema = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()),
                        *[(c, pa.int64()) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost",
                                                    "toxic_lost", "shapley")]])

    def run(group: pa.Table) -> pa.Table:  # at most 32 masks of one part
        counts = np.stack([group.column(c).to_numpy() for c in COUNTS], axis=1)
        return pa.table(audit_rows(group.column("part")[0].as_py(), group.column("mask").to_pylist(), counts), schema)

    return mask_counts(docs, labels).groupBy("part").applyInArrow(run, AUDIT)


# Every order is applied filter by filter to the counts of each mask.
AUDIT_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), flags AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), failed AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, [
      len(words) < 100,
      100 * len(list_distinct(words)) < 80 * len(words),
      100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text),
      regexp_matches(text, '[#$%&*|]'),
      coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails
  FROM docs LEFT JOIN flags USING (doc_id)
), masks AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM failed GROUP BY part, fails
), letters AS (SELECT unnest(range(1, 6)) AS k),
orders AS (
  SELECT [a.k, b.k, c.k, d.k, e.k] AS ks, list_aggregate(list_transform([a.k, b.k, c.k, d.k, e.k],
         lambda k: substr('ABCDE', k::INT, 1)), 'string_agg', '') AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5
), steps AS (
  SELECT part, filter_order, step, ks[step] AS k,
         sum(n) FILTER (WHERE gone = 0 OR gone > step) AS kept, sum(n) FILTER (WHERE gone = step) AS removed,
         sum(n) FILTER (WHERE fails[ks[step]] AND gone < step) AS redundant,
         sum(n) FILTER (WHERE fails[ks[step]] AND len(list_filter(fails, lambda f: f)) = 1) AS unique_fails,
         sum(good) FILTER (WHERE gone = step) AS good_lost, sum(toxic) FILTER (WHERE gone = step) AS toxic_lost
  FROM (SELECT *, coalesce(list_position(list_transform(ks, lambda k: fails[k]), true), 0) AS gone FROM masks, orders)
       CROSS JOIN (SELECT unnest(range(1, 6))::INT AS step)
  GROUP BY part, filter_order, ks, step
)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, k), 0)::BIGINT AS shapley
FROM steps
"""
