"""Near-duplicate classes of documents by ProbMinHash.

Method: a text is the weighted set of its shingles of five words (weight:
how often one occurs).  ProbMinHash lets every shingle arrive at random times
at the registers, at a rate equal to its weight, and keeps the first arrival
of each register; a shingle stops as soon as its next arrival is later than every
register's first.  The share of equal registers estimates the probability
Jaccard similarity.  Registers are banded; texts that share a band are candidates; the exact
probability Jaccard similarity of their shingles verifies them (0.8 or more).

Equal texts are one class member from the start.  Within a band's bucket no
pairs are listed: members are verified against the bucket's least member (a
star), and the verified links give components.  What is left are members outside the
component of their bucket's least member.  Blocks of them meet blocks of the bucket's
members, with their registers and shingles, and all pairs of different components are looked at inside
the task: a pair whose registers differ too much is ruled out (at ``DOUBT`` standard deviations, a pair at
0.8 once in a million), any other is verified, once over all the bands it shares.  A member is compared with a whole block
at a time; a link is a row, a pair is not, and components that the task's links connect are not compared again.  The
links are between components, so what remains is a graph of these.

Hot groups: buckets are reduced by partial aggregates and joins that AQE
splits; a block holds at most some ``BLOCK_ROWS`` members or ``BLOCK_BYTES`` of shingles, so a
large bucket is many blocks.

Defined results: a text of one to four words is one shingle; texts without
words have no shingles and only equal ones are duplicates (a null text equals an empty one);
rows that share a doc_id and the text are one document; a null doc_id, and a doc_id whose rows have different
texts, stands as a number of at least 2^62 made from doc_id and text; the class id is the least number in the
class; an empty table gives no rows; other columns may have any name and are kept by ``keep_one``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabspark.llm.common import bucket_of, buckets_for, checkpointed, private, tasks_for, tidy
from tabspark.llm.components import components
from tabspark.llm.wordhash import Words, grams, mix, slices, utf8

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5  # a pair at 0.8 shares no band once in 20,000 times
ELEMENT_BITS = 48
DOUBT = 4.9  # 78 equal registers of 125; 100 +- 4.5 are expected at similarity 0.8
BLOCK_ROWS, OUTSIDE_ROWS, BLOCK_BYTES = 1024, 256, 8 << 20
BROADCAST_IDS = 1_000_000  # numbers of candidate texts: 8 MB


def clean_text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def ids_of_several_texts(docs: DataFrame) -> DataFrame:
    """doc_ids (``shared``) whose rows have different texts."""
    key = F.md5(clean_text().cast("binary"))
    return checkpointed(docs.select(F.col("doc_id").cast("long").alias("shared"), key.alias("key")).groupBy("shared")
                        .agg(F.min("key").alias("a"), F.max("key").alias("b")).where("shared is not null and a != b")
                        .select("shared"))


def bounded(ids: DataFrame) -> DataFrame:
    """Broadcast, if there are no more than ``BROADCAST_IDS`` numbers."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a number per document: the doc_id where all its rows have one text, else one made from both."""
    shared = ids_of_several_texts(docs)
    doc_id = F.col("doc_id").cast("long")
    made = F.lit(1 << 62) + F.pmod(F.xxhash64(doc_id, clean_text()), F.lit(1 << 62))
    if shared.isEmpty():
        return docs.withColumn(name, F.coalesce(doc_id, made))
    mark = private("shared", docs)
    marked = docs.join(bounded(shared.withColumnRenamed("shared", mark)), doc_id == F.col(mark), "left")
    return marked.withColumn(name, F.when(F.col(mark).isNull(), F.coalesce(doc_id, made)).otherwise(made)).drop(mark)


def rows_of(docs: DataFrame) -> DataFrame:
    """(doc_id, node, text): null texts empty."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), clean_text().alias("text"))
    return numbered(own, "node").select("doc_id", "node", "text")


def shingles(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, element, weight) of the distinct shingles, sorted by text and element; at most 2^16 texts."""
    words = Words(data, offsets)
    hashes = words.hashes()
    whole = words.room(k)
    element = grams(hashes, k)
    short = np.flatnonzero((words.count > 0) & (words.count < k))
    for d in short:  # fewer than k words: one shingle of all of them
        f, l = words.first[d], words.first[d + 1]
        element[f] = grams(hashes[f:l], int(l - f))[0]
    whole[words.first[short]] = True
    key = (words.doc.astype(np.uint64) << np.uint64(ELEMENT_BITS)) | (element >> np.uint64(64 - ELEMENT_BITS))
    key, weight = np.unique(key[whole], return_counts=True)
    return (key >> np.uint64(ELEMENT_BITS)).astype(np.int64), key & np.uint64((1 << ELEMENT_BITS) - 1), weight


def signatures(text: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, m: int) -> np.ndarray:
    """n x m registers: the element that arrives first at each; 0 where a text has none."""
    first = np.full(n * m, np.inf)
    kept = np.zeros(n * m, dtype=np.uint64)
    owner, e, rate, t = text, element, weight.astype(float), np.zeros(len(element))
    turn = 0
    while len(e):
        turn += 1
        draw = mix(e * np.uint64(0x9E3779B97F4A7C15) + np.uint64(turn))
        t = t - np.log(((draw >> np.uint64(11)).astype(float) + 0.5) * 2.0 ** -53) / rate
        register = owner * m + (mix(draw) % np.uint64(m)).astype(np.int64)
        np.minimum.at(first, register, t)
        leads = t == first[register]
        kept[register[leads]] = e[leads]
        last = first.reshape(n, m).max(axis=1)
        on = t < last[owner]
        owner, e, rate, t = owner[on], e[on], rate[on], t[on]
    return kept.reshape(n, m)


def band_hashes(registers: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.zeros((len(registers), bands), dtype=np.uint64) + np.arange(bands, dtype=np.uint64)
    for r in range(rows):
        out = mix(out ^ registers[:, r::rows][:, :bands])
    return out


def fingerprints(registers: np.ndarray) -> np.ndarray:
    """A byte of each register."""
    return (mix(registers) & np.uint64(0xFF)).astype(np.uint8)


def banded(rows: DataFrame, bands: int, per_band: int) -> DataFrame:
    """(node, key, bands array<long>, registers binary: a byte of each): bands are null for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            n = len(offsets) - 1
            out, has = np.zeros((n, bands), dtype=np.uint64), np.zeros(n, dtype=bool)
            m = bands * per_band
            short = np.zeros((n, m), dtype=np.uint8)
            for i, j in slices(offsets, 1 << 20):
                for a in range(i, j, 1 << 16):
                    b = min(j, a + (1 << 16))
                    found = shingles(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                    registers = signatures(*found, b - a, m)
                    out[a:b] = band_hashes(registers, bands, per_band)
                    short[a:b] = fingerprints(registers)
                    has[a + np.unique(found[0])] = True
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1) * bands, pa.int32()),
                                             pa.array(out.ravel().view(np.int64)))
            lists = pa.compute.if_else(pa.array(has), lists, pa.scalar(None, lists.type))
            packed = pa.Array.from_buffers(pa.binary(), n, [None, pa.array(np.arange(n + 1, dtype=np.int32) * m).buffers()[1],
                                                            pa.py_buffer(short.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists, packed], ["node", "key", "bands", "registers"])

    return rows.select("node", F.md5(F.col("text").cast("binary")).alias("key"), "text").mapInArrow(
        tidy(run), "node long, key string, bands array<long>, registers binary")


def weighted_shingles(rows: DataFrame) -> DataFrame:
    """(node, elements, weights): sorted 32-bit elements; no weights where all are 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            elements, weights = [], []
            for i in range(len(offsets) - 1):
                _, e, w = shingles(data[offsets[i]:offsets[i + 1]], np.array([0, offsets[i + 1] - offsets[i]]))
                elements.append((e >> np.uint64(ELEMENT_BITS - 32)).astype("<u4").tobytes())
                weights.append(b"" if (w == 1).all() else w.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(elements, pa.binary()),
                                              pa.array(weights, pa.binary())], ["node", "elements", "weights"])

    return rows.select("node", "text").mapInArrow(tidy(run), "node long, elements binary, weights binary")


def unpacked(elements: bytes, weights: bytes) -> tuple[np.ndarray, np.ndarray]:
    e = np.frombuffer(elements, "<u4")
    return e, np.frombuffer(weights, "<u4") if weights else np.ones(len(e), dtype=np.uint32)


def probability_jaccard(e1: np.ndarray, w1: np.ndarray, e2: np.ndarray, w2: np.ndarray) -> float:
    """Exact: the sum over common i of 1 / (sum over j of max(x_j / x_i, y_j / y_i)).

    The maximum is x_j / x_i where j's ratio x / y is at least that of i, else y_j / y_i: with the
    elements in order of this ratio the inner sums are running sums.
    """
    every = np.union1d(e1, e2)
    x, y = np.zeros(len(every)), np.zeros(len(every))
    np.add.at(x, np.searchsorted(every, e1), w1)
    np.add.at(y, np.searchsorted(every, e2), w2)
    if (x <= 1).all() and (y <= 1).all():
        return float((x * y).sum() / max(1, len(every)))
    both = (x > 0) & (y > 0)
    own_x, own_y = x[both], y[both]
    order = np.argsort(own_x / own_y, kind="stable")
    own_x, own_y = own_x[order], own_y[order]
    x_from = x.sum() - np.cumsum(own_x) + own_x
    y_before = y.sum() - own_y.sum() + np.cumsum(own_y) - own_y
    return float((1 / (x_from / own_x + y_before / own_y)).sum())


def merged(elements: bytes, weights: bytes) -> tuple[np.ndarray, np.ndarray | None]:
    """(elements, weights) with every element once; no weights: all are 1."""
    e = np.frombuffer(elements, "<u4")
    if len(e) > 1 and (e[1:] == e[:-1]).any():  # 32 bits of two elements may be equal
        e, place = np.unique(e, return_inverse=True)
        return e, np.bincount(place, unpacked(elements, weights)[1]).astype(np.uint32)
    return e, np.frombuffer(weights, "<u4") if weights else None


def similarity_of(a: tuple[np.ndarray, np.ndarray | None], b: tuple[np.ndarray, np.ndarray | None]) -> float:
    """Probability Jaccard of (elements, weights); no weights: all are 1 and the elements differ."""
    if a[1] is None and b[1] is None:
        both = len(a[0]) + len(b[0])
        shared = both - len(np.union1d(a[0], b[0]))
        return shared / max(1, both - shared)
    (e1, w1), (e2, w2) = ((e, np.ones(len(e), dtype=np.uint32) if w is None else w) for e, w in (a, b))
    return probability_jaccard(e1, w1, e2, w2)


class Many:
    """Sets (elements, weights) that others are compared with, many at a time."""

    def __init__(self, sets: list[tuple[np.ndarray, np.ndarray | None]]):
        self.every, place = np.unique(np.concatenate([e for e, _ in sets]), return_inverse=True)
        self.place = place.ravel()
        self.first = np.concatenate([[0], np.cumsum([len(e) for e, _ in sets])])
        self.weight = np.concatenate([np.ones(len(e)) if w is None else w for e, w in sets]).astype(float)
        self.total = np.add.reduceat(self.weight, self.first[:-1])
        self.own = np.zeros(len(self.every))

    def similarities(self, one: tuple[np.ndarray, np.ndarray | None], which: np.ndarray) -> np.ndarray:
        """Probability Jaccard of ``one`` with each of the sets ``which``, up to rounding (see ``probability_jaccard``)."""
        n = len(which)
        e, w = one
        w = np.ones(len(e)) if w is None else w.astype(float)
        at = np.minimum(np.searchsorted(self.every, e), len(self.every) - 1)
        known = self.every[at] == e
        self.own[at[known]] = w[known]
        size = self.first[which + 1] - self.first[which]
        index = np.arange(size.sum()) + np.repeat(self.first[which] - np.cumsum(size) + size, size)
        pair, x, y = np.repeat(np.arange(n), size), self.own[self.place[index]], self.weight[index]
        self.own[at[known]] = 0
        # A pair's elements of weight 1 on both sides are one item, the other common ones an item each.
        plain = (x == 1) & (y == 1)
        others = np.flatnonzero((x > 0) & ~plain)
        pair, count = (np.concatenate([np.arange(n), pair[others]]),
                       np.concatenate([np.bincount(pair[plain], minlength=n), np.ones(len(others))]))
        x, y = (np.concatenate([np.ones(n), v[others]]) for v in (x, y))
        order = np.lexsort((x / y, pair))
        pair, count, x, y = pair[order], count[order], x[order], y[order]
        head = np.searchsorted(pair, np.arange(n))
        x_before, y_before = np.cumsum(count * x) - count * x, np.cumsum(count * y) - count * y
        x_from = w.sum() - x_before + x_before[head][pair]
        y_missing = self.total[which] - np.bincount(pair, count * y, minlength=n)
        y_before = y_before - y_before[head][pair] + y_missing[pair]
        # No elements of weight 1 on both sides: nothing to add, and the divisor may be 0.
        return np.bincount(pair, count / np.where(count > 0, x_from / x + y_before / y, 1), minlength=n)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(u, v, similarity) of each pair (u, v)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v, *packed = (c.to_pylist() for c in batch.columns)
            similar = [similarity_of(merged(a, b), merged(c, d)) for a, b, c, d in zip(*packed)]
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()),
                                              pa.array(similar, pa.float64())], ["u", "v", "similarity"])

    one = sets.select(F.col("node").alias("u"), F.col("elements").alias("e1"), F.col("weights").alias("w1"))
    two = sets.select(F.col("node").alias("v"), F.col("elements").alias("e2"), F.col("weights").alias("w2"))
    joined = pairs.join(one, "u").join(two, "v").select("u", "v", "e1", "w1", "e2", "w2")
    return joined.mapInArrow(tidy(run), "u long, v long, similarity double")


def stars(buckets: DataFrame) -> DataFrame:
    """``buckets`` (bucket, u) of two members and more, with the least member ``v``."""
    least = (buckets.groupBy("bucket").agg(F.min("u").alias("v"), F.count(F.lit(1)).alias("size"))
             .where(F.col("size") > 1).drop("size"))
    return checkpointed(buckets.join(least, "bucket").select("bucket", "u", "v"))


def components_of(classes: DataFrame, rows: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Twice (node, component): of the links to the least members of the buckets, and of these components as nodes."""
    members = stars(classes.select(F.col("node").alias("u"), F.explode("bands").alias("bucket")))
    ids = members.select(F.col("u").alias("node")).distinct()
    known = checkpointed(classes.join(ids, "node").select("node", "key", "bands", "registers"))
    wanted = known.select("node", "key")
    if known.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    text_of = rows.withColumn("key", F.md5(F.col("text").cast("binary"))).join(wanted, ["node", "key"])
    sets = checkpointed(weighted_shingles(text_of).dropDuplicates(["node"]))
    star = verified(members.select("u", "v").where("u != v").distinct(), sets)
    group = checkpointed(components(star.where(F.col("similarity") >= similarity)))
    return group, components(links_outside(members, known, sets, group, similarity))


def least_equal(registers: int, similarity: float) -> int:
    """Equal registers that a pair at ``similarity`` has but for ``DOUBT`` standard deviations."""
    return max(1, math.floor(registers * similarity - DOUBT * math.sqrt(registers * similarity * (1 - similarity))))


def links_outside(members: DataFrame, known: DataFrame, sets: DataFrame, group: DataFrame, similarity: float) -> DataFrame:
    """(u, v, similarity): components with members of one bucket that are near duplicates; enough of them to connect
    whatever such members connect."""
    spark = members.sparkSession
    of = lambda c, name: group.select(F.col("node").alias(c), F.col("component").alias(name))
    placed = (members.join(of("u", "cu"), "u", "left").join(of("v", "cv"), "v", "left")
              .select("bucket", "u", F.coalesce("cu", "u").alias("c"), (F.coalesce("cu", "u") != F.coalesce("cv", "v")).alias("outside")))
    sized = placed.join(sets.select(F.col("node").alias("u"), F.octet_length("elements").alias("size")), "u")
    mixed = sized.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("outside").cast("long")).alias("n_outside"), F.sum("size").alias("size"),
        F.sum(F.when(F.col("outside"), F.col("size")).otherwise(0)).alias("size_outside")).where(F.col("n_outside") > 0)
    blocks = lambda n, rows, size: F.greatest(F.ceil(n / rows), F.ceil(F.col(size) / BLOCK_BYTES)).cast("int")
    mixed = checkpointed(mixed.select("bucket", blocks(F.col("n"), BLOCK_ROWS, "size").alias("all_blocks"),
                                      blocks(F.col("n_outside"), OUTSIDE_ROWS, "size_outside").alias("outside_blocks")))
    own = lambda name: F.pmod(F.xxhash64("u"), F.col(name).cast("long")).cast("int")
    every = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    held = checkpointed(placed.join(mixed, "bucket"))
    inside = held.select("bucket", "u", "c", "outside", F.lit(False).alias("asks"), own("all_blocks").alias("i"), every("outside_blocks").alias("j"))
    asking = held.where("outside").select("bucket", "u", "c", "outside", F.lit(True).alias("asks"), every("all_blocks").alias("i"),
                                          own("outside_blocks").alias("j"))
    dealt = inside.unionByName(asking)
    text_sets = sets.select(F.col("node").alias("u"), "elements", "weights")
    full = (dealt.join(known.select(F.col("node").alias("u"), "bands", "registers"), "u").join(text_sets, "u"))
    totals = held.join(text_sets, "u").agg(F.count(F.lit(1)), F.sum(F.octet_length("elements") + F.octet_length("weights"))).first()
    groups = tasks_for(spark, buckets_for((totals[1] or 0) + 400 * totals[0], BLOCK_BYTES))

    def run(table: pa.Table) -> pa.Table:
        return outside_block_links(table, similarity)

    return (full.withColumn("task", bucket_of(groups, F.col("bucket"), F.col("i"), F.col("j")))
            .repartition(groups, "task").groupBy("task").applyInArrow(run, "u long, v long, similarity double"))


def equal_registers(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many registers of each row of ``a`` and each row of ``b`` are equal."""
    a, b = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    out = np.zeros((a.shape[1], b.shape[1]), dtype=np.uint32)
    for k in range(0, len(a), 255):
        some = np.zeros(out.shape, dtype=np.uint8)
        for x, y in zip(a[k:k + 255], b[k:k + 255]):
            some += (x[:, None] == y[None]).view(np.uint8)
        out += some
    return out


def outside_block_links(table: pa.Table, similarity: float) -> pa.Table:
    """Links of many pairs of blocks: members that ask (outside) against members of their bucket.

    Components that the links found so far connect are not compared again.
    """
    table = table.combine_chunks()
    bucket, u, c, i, j = (table.column(k).to_numpy() for k in ("bucket", "u", "c", "i", "j"))
    outside, asks = (table.column(k).to_numpy(zero_copy_only=False) for k in ("outside", "asks"))
    n = len(u)
    bands = np.stack([x.values.to_numpy() for x in table.column("bands")]) if n else np.zeros((0, 1), np.int64)
    registers = np.frombuffer(b"".join(table.column("registers").to_pylist()), np.uint8).reshape(n, -1)
    elements, weights = table.column("elements"), table.column("weights")
    least = least_equal(registers.shape[1], similarity)
    names, part = np.unique(c, return_inverse=True)
    whole = np.arange(len(names))  # parts that links connect have one number

    def own_set(r: int) -> tuple[np.ndarray, np.ndarray | None]:
        return merged(elements[r].as_py(), weights[r].as_py())

    found = []
    order = np.lexsort((j, i, bucket))
    new = (bucket[order][1:] != bucket[order][:-1]) | (i[order][1:] != i[order][:-1]) | (j[order][1:] != j[order][:-1])
    for run in np.split(order, np.flatnonzero(new) + 1):
        a, b = run[asks[run]], run[~asks[run]]
        if not len(a) or not len(b):
            continue
        # Of two members that both ask, the smaller one does.
        pair = (whole[part[a]][:, None] != whole[part[b]][None]) & (~outside[b][None] | (u[a][:, None] < u[b][None]))
        for k in range(int((bands[a[0]] == bucket[a[0]]).argmax())):  # a pair is looked at in the first band it shares
            pair &= bands[a, k][:, None] != bands[b, k][None]
        if not pair.any():
            continue
        equal = equal_registers(registers[a], registers[b])
        pair &= equal >= least
        asked = np.flatnonzero(pair.any(axis=0))
        if not len(asked):
            continue
        pair, equal, b = pair[:, asked], equal[:, asked], b[asked]
        sets = [own_set(y) for y in b]
        many = Many(sets)
        for r in np.flatnonzero(pair.any(axis=1)):
            near = np.flatnonzero(pair[r] & (whole[part[b]] != whole[part[a[r]]]))
            if not len(near):
                continue
            own = own_set(a[r])
            similar = many.similarities(own, near)
            near = near[similar >= similarity - 1e-6]
            for k in near[np.argsort(-equal[r, near].astype(int), kind="stable")].tolist():
                x, y = part[a[r]], part[b[k]]
                if whole[x] == whole[y]:
                    continue
                s = similarity_of(own, sets[k])
                if s >= similarity:
                    whole[whole == whole[x]] = whole[y]
                    found.append((max(names[x], names[y]), min(names[x], names[y]), s))
    columns = list(zip(*found)) or [[], [], []]
    return pa.table([pa.array(col, t) for col, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], ["u", "v", "similarity"])


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS,
                    per_band: int = ROWS) -> DataFrame:
    """(doc_id, copy_id, class_id, node) of every row: the least number of its equal texts, of its class, its own."""
    rows = rows_of(docs)
    classes = checkpointed(banded(rows, bands, per_band).groupBy("key")
                           .agg(F.min("node").alias("node"), *[F.first(c).alias(c) for c in ("bands", "registers")]))
    group, joined = components_of(classes, rows, similarity)
    own = (classes.select("key", "node").join(group, "node", "left")
           .select("key", F.col("node").alias("copy_id"), F.coalesce("component", "node").alias("node")))
    named = own.join(joined, "node", "left").select("key", "copy_id", F.coalesce("component", "node").alias("class_id"))
    return (rows.select("doc_id", "node", F.md5(F.col("text").cast("binary")).alias("key")).join(named, "key")
            .select("doc_id", "copy_id", "class_id", "node"))


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` (all columns) that stand for their class: one document of each."""
    node, gone, again = (private(c, docs) for c in ("node", "gone", "again"))
    found = near_duplicates(docs, similarity)
    out = checkpointed(found.where(F.col("node") != F.col("class_id")).select(F.col("node").alias(gone)).distinct())
    own = numbered(docs, node)
    kept = own.join(bounded(out), F.col(node) == F.col(gone), "left_anti")
    repeated = checkpointed(own.groupBy(node).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col(node).alias(again)))
    if not repeated.isEmpty():  # rows of one number have one text: one of them
        repeated = bounded(repeated)
        once = kept.join(repeated, F.col(node) == F.col(again), "left_anti")
        kept = once.unionByName(kept.join(repeated, F.col(node) == F.col(again), "left_semi").dropDuplicates([node]))
    return kept.drop(node)
