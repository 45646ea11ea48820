"""Documents that hold a passage of a benchmark item, by SimHash windows.

Method: for an item of L words every window of L words of a document is
compared with it; a document of fewer words is one window itself.  Windows and items get a 64-bit SimHash over their shingles
of five words, weighted by how often they occur.  A multi-index finds the
fingerprints within ``RADIUS`` bits: each is cut into ``RADIUS`` + 1 blocks,
and two within the radius agree in one block at least.  Exact weighted
Jaccard similarity of the shingles (0.8 or more) decides.  A document shorter than
the item is one window only and goes to the exact comparison without a fingerprint.

A window without any shingle of an item has similarity 0, so fingerprints
are made only for windows that hold one; these are found by joining all
shingles of all documents with the items' shingles.  At this similarity the radius is so wide that the
blocks are short (3 bits): the multi-index loses nothing, but it is this join that keeps the candidates few.

All of it is DataFrame functions.  The items' shingles are broadcast when
they number at most ``BROADCAST_ROWS`` (else joined by shuffle), and so are the hashes
of the texts that hold one.

Defined results: words are runs without ASCII white space, compared as
they are; an item of fewer than five words is one shingle of all of them, and a document with
fewer words than the item's shingles has none of them; null
or empty items and texts match nothing; repeated rows are judged each for itself and
repeated items give a row each; an empty table on either side gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabspark.llm.common import checkpointed

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BITS = 64
RADIUS = 20  # 9.7 +- 2.9 bits differ at similarity 0.8
BROADCAST_ROWS = 1_000_000
LANE_BITS = 32  # two counters in a long: no array has 2^32 elements
LANES = (1 << LANE_BITS) | 1


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), "[\\x20\\x09-\\x0D]+"), "")


def shingle_array(words: Column, k: int) -> Column:
    """Hash of the k words from each position on; empty for fewer words."""
    hashes = F.array(F.transform(words, lambda w: F.xxhash64(w)))

    def of(h: Column) -> Column:
        places = F.sequence(F.lit(0), F.greatest(F.size(h) - k, F.lit(0)))
        rolled = F.transform(places, lambda i: F.xxhash64(*[h[i + j] for j in range(k)]))
        return F.when(F.size(h) >= k, rolled).otherwise(F.array().cast("array<long>"))

    return F.transform(hashes, of)[0]  # the word hashes are made once and used in each place


def simhash(shingles: Column) -> Column:
    """SimHash of an array of hashes; a hash that occurs twice counts twice."""
    out = F.lit(0).cast("long")
    n = F.size(shingles)
    for j in range(LANE_BITS):
        ones = F.aggregate(shingles, F.lit(0).cast("long"),
                           lambda acc, h: acc + F.shiftrightunsigned(h, j).bitwiseAND(F.lit(LANES)))
        for lane in range(BITS // LANE_BITS):
            many = F.shiftrightunsigned(ones, LANE_BITS * lane).bitwiseAND(F.lit((1 << LANE_BITS) - 1)) * 2 > n
            bit = 1 << (j + LANE_BITS * lane)
            out = out.bitwiseOR(F.when(many, F.lit(bit - (1 << 64) if bit >> 63 else bit).cast("long"))
                                .otherwise(F.lit(0).cast("long")))
    return out


def blocks(fingerprint: Column, radius: int) -> Column:
    """The radius + 1 blocks of a fingerprint as (number, value)."""
    edges = [BITS * i // (radius + 1) for i in range(radius + 2)]
    return F.array(*[F.struct(F.lit(i).alias("block"),
                              F.shiftrightunsigned(fingerprint, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias("value"))
                     for i, (lo, hi) in enumerate(zip(edges, edges[1:]))])


def small(df: DataFrame) -> DataFrame:
    """``df``, broadcast where its (counted) rows allow it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY,
                 radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, start, n_words, similarity, row_id): the best window of each document and item above the threshold.

    ``start`` counts words from 0; among equal windows the first.  ``row_id``
    tells rows of one doc_id apart.
    """
    return found_in(docs, benchmark, similarity, radius).drop("h")


def found_in(docs: DataFrame, benchmark: DataFrame, similarity: float, radius: int) -> DataFrame:
    """``contaminated`` with the hash ``h`` of the row's text."""
    items = checkpointed(benchmark.select("item_id", word_array(F.col("text")).alias("words"))
                         .select(F.monotonically_increasing_id().alias("item"), "item_id", "words",
                                 F.size("words").alias("length")).where(F.col("length") > 0))
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = None
    sizes = [r[0] for r in items.select(F.least("length", F.lit(SHINGLE_WORDS)).alias("k")).distinct().collect()]
    for k in sorted(sizes):
        own = _contaminated(texts, items.where(F.least("length", F.lit(SHINGLE_WORDS)) == k), k, similarity, radius)
        found = own if found is None else found.unionByName(own)
    if found is None:
        found = texts.where(F.lit(False)).select(
            "doc_id", F.lit(None).cast(benchmark.schema["item_id"].dataType).alias("item_id"), F.lit(0).alias("start"),
            F.lit(0).alias("n_words"), F.lit(0.0).alias("similarity"), F.lit(0).cast("long").alias("row_id"),
            F.lit(0).cast("long").alias("h"))
    return found


def _contaminated(texts: DataFrame, items: DataFrame, k: int, similarity: float, radius: int) -> DataFrame:
    items = checkpointed(items.select("item", "item_id", "length", shingle_array(F.col("words"), k).alias("item_shingles")))
    index = checkpointed(items.select("item", "length", F.explode("item_shingles").alias("s")).distinct())
    # Texts that hold any shingle of any item.
    held = (texts.select(F.xxhash64("text").alias("h"), F.explode(shingle_array(word_array(F.col("text")), k)).alias("s"))
            .join(small(index.select("s").distinct()), "s", "left_semi").select("h").distinct())
    held = checkpointed(held)
    rows = checkpointed(texts.withColumn("h", F.xxhash64("text")).join(small(held), "h", "left_semi")
                        .select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "h",
                                shingle_array(word_array(F.col("text")), k).alias("shingles")))
    # Every window of an item's length around a shared shingle.
    length = F.col("length") - k + 1  # in shingles
    shared = rows.select("row_id", F.size("shingles").alias("n"), F.posexplode("shingles").alias("p", "s")).join(small(index), "s")
    # A shorter document has similarity n / length at most.
    starts = (shared.where(F.col("n") / length >= similarity)
              .select("row_id", "item", length.alias("m"),
                      F.explode(F.sequence(F.greatest(F.col("p") - length + 1, F.lit(0)),
                                           F.least("p", F.greatest(F.col("n") - length, F.lit(0))))).alias("start"))
              .distinct().groupBy("row_id", "item", "m").agg(F.sort_array(F.collect_set("start")).alias("starts")))
    cut = F.transform("starts", lambda s: F.struct(s.alias("start"), F.slice("shingles", s + 1, F.col("m")).alias("own")))
    windows = (starts.join(rows.select("row_id", "shingles"), "row_id").select("row_id", "item", "m", F.explode(cut).alias("w"))
               .select("row_id", "item", "w.start", "w.own", (F.size("w.own") < F.col("m")).alias("short")))
    windows = checkpointed(windows.withColumn("f", F.when(~F.col("short"), simhash(F.col("own")))))
    prints = items.select("item", simhash(F.col("item_shingles")).alias("g"))
    near = (windows.where(~F.col("short")).select("row_id", "item", "start", "f", F.explode(blocks(F.col("f"), radius)).alias("b"))
            .join(small(prints.select("item", "g", F.explode(blocks(F.col("g"), radius)).alias("b"))), ["item", "b"])
            .where(F.bit_count(F.col("f").bitwiseXOR(F.col("g"))) <= radius)
            .select("row_id", "item", "start").distinct())
    near = near.unionByName(windows.where("short").select("row_id", "item", "start"))
    # Exact weighted Jaccard; m is the window's number of shingles, of the item's length but in short documents.
    weights = (windows.join(near, ["row_id", "item", "start"])
               .select("row_id", "item", "start", F.size("own").alias("m"), F.explode("own").alias("s"))
               .groupBy("row_id", "item", "start", "m", "s").agg(F.count(F.lit(1)).alias("x")))
    wanted = (items.select("item", F.explode("item_shingles").alias("s")).groupBy("item", "s")
              .agg(F.count(F.lit(1)).alias("y")))
    common = (weights.join(small(wanted), ["item", "s"]).groupBy("row_id", "item", "start", "m")
              .agg(F.sum(F.least("x", "y")).alias("c")))
    alike = (common.join(small(items.select("item", F.size("item_shingles").alias("m_item"))), "item")
             .withColumn("similarity", F.col("c") / (F.col("m") + F.col("m_item") - F.col("c")))
             .where(F.col("similarity") >= similarity))
    best = (alike.groupBy("row_id", "item")
            .agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"), "m")).alias("b"))
            .select("row_id", "item", (-F.col("b.back")).alias("start"), (F.col("b.m") + k - 1).alias("n_words"), "b.similarity"))
    return (best.join(rows.select("row_id", "doc_id", "h"), "row_id").join(items.select("item", "item_id"), "item")
            .select("doc_id", "item_id", "start", "n_words", "similarity", "row_id", "h"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without the rows that hold a benchmark passage (all columns are kept), each judged by its own text."""
    found = found_in(docs, benchmark, similarity, RADIUS)
    bad = checkpointed(found.select(F.col("doc_id").alias("bad_id"), F.col("h").alias("bad_h")).distinct())
    own = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(small(bad), docs["doc_id"].eqNullSafe(bad["bad_id"]) & (own == bad["bad_h"]), "left_anti")
