"""Prefix trie of conversations: sorted neighbours, LCP edges, union-find in descending depth.

Method: a conversation is the sequence of its turns' digests.  Sequences are
range-partitioned and sorted, so that the members of every trie node are
neighbours.  Inside a partition each two neighbours are an edge whose depth is
their longest common prefix; the edges are taken in descending depth, and
every merge of two components makes a branching node or adds a child to
it.  Between two branching nodes lie nodes with one child, which differ in
depth only.

A node that holds members of two partitions is a prefix of the last sequence of
one and the first of the next.  A partition contracts its forest to such open
nodes, with the sums of the finished trees below them; equal open nodes
of different partitions are merged, and their subtrees are summed by
prefix sums over the partitions (open nodes that begin in one partition
lie on one path).  All else is finished where it was found.

Bounds: a partition holds some ``PART_BYTES`` of digests and sizes; per
boundary there are at most as many open nodes as turns shared across it; the
driver receives a few numbers per partition.  A conversation is one row, of
24 bytes a turn.  Copies of one sequence, also if a third of all, are
split over partitions by conv_id; only the text of their ids, which one SHA-256 has to
read in order, streams through one task, joined in large pieces.

Defined results: rows whose conv_id is null belong to no conversation; a null
role or text is empty; a null turn comes first; rows of one conversation with
equal turns are ordered by role, then by the digest of the text, and repeated rows
are turns of their own; an empty table gives no nodes; other columns of
the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabspark.llm.common import buckets_for, checkpointed, tasks_for

DIGEST = 16  # bytes that stand for a turn
PART_BYTES = 8 << 20
IDS_PER_PIECE = 1 << 16

NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
FOUND = ("state string, part int, id binary, parent_id binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, bytes long, piece int, ids string")
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns array<struct<turn, role, digest, bytes>>): every conversation's turns in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"),
                    F.substring(F.sha2(content, 256), 1, 2 * DIGEST).alias("digest"),
                    F.octet_length(text).cast("long").alias("bytes"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
    return (rows.where(F.col("conv_id").isNotNull()).groupBy("conv_id")
            .agg(F.sort_array(F.collect_list("turn")).alias("turns")))


def regrown(sequences: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """Conversations that begin like the first of their family.

    Conversation c takes the first h turns of conversation c - c mod ``family``
    (none if there is no such one) and its own turns after its first h, where
    h is the unsigned crc32 of c in decimal, modulo ``heads``.
    """
    own = F.col("conv_id")
    h = F.pmod(F.crc32(own.cast("string")), F.lit(heads)).cast("int")
    first = own - F.pmod(own, F.lit(family))
    head = sequences.where(F.pmod(own, F.lit(family)) == 0).select(
        own.alias("first"), F.slice("turns", 1, heads - 1).alias("head"))
    joined = sequences.select("conv_id", "turns", h.alias("h"), first.alias("first")).join(head, "first", "left")
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    turns = F.when(F.col("head").isNull(), rest).otherwise(F.concat(F.slice("head", F.lit(1), F.col("h")), rest))
    return joined.select("conv_id", turns.alias("turns"))


def keyed(sequences: DataFrame) -> DataFrame:
    """(conv_id, key binary: the digests in a row, sizes array<long>: bytes of the texts)."""
    digests = F.array_join(F.transform("turns", lambda t: t["digest"]), "")
    return sequences.select("conv_id", F.unhex(digests).alias("key"), F.transform("turns", lambda t: t["bytes"]).alias("sizes"))


def shared(a: bytes, b: bytes) -> int:
    """Turns that two keys have in common from the start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // DIGEST
    differ = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(differ.argmax()) // DIGEST


def prefix_ids(key: bytes, most: int) -> list[bytes]:
    """Identity of the prefixes of 0 to ``most`` turns."""
    h, out = hashlib.sha256(), [hashlib.sha256().digest()[:DIGEST]]
    for t in range(most):
        h.update(key[t * DIGEST:(t + 1) * DIGEST])
        out.append(h.copy().digest()[:DIGEST])
    return out


class Forest:
    """The branching nodes of sorted different sequences, by union-find over their LCP edges.

    Node r < m is sequence r with its copies; the others are merges.  ``lo`` and
    ``hi`` are the sequences of a node, ``parent`` is -1 above the top.
    """

    def __init__(self, lengths: list[int], lcp: list[int], counts: list[int], least: list[int]):
        m = len(lengths)
        self.depth, self.n, self.least = list(lengths), list(counts), list(least)
        self.lo, self.hi = list(range(m)), list(range(1, m + 1))
        self.parent, self.kids = [-1] * m, [0] * m
        group, top = list(range(m)), list(range(m))

        def find(r: int) -> int:
            while group[r] != r:
                group[r] = group[group[r]]
                r = group[r]
            return r

        for r in sorted(range(1, m), key=lambda r: -lcp[r]):  # equal depths from left to right
            a, b = find(r - 1), find(r)
            node, child = top[a], top[b]
            if self.depth[node] != lcp[r]:  # neither a sequence that ends here nor an earlier merge
                node = self._above(node, lcp[r])
            self._attach(child, node)
            group[b], top[a] = a, node

    def _above(self, child: int, depth: int) -> int:
        node = len(self.depth)
        for column, value in ((self.depth, depth), (self.n, 0), (self.least, self.least[child]), (self.lo, self.lo[child]),
                              (self.hi, self.lo[child]), (self.parent, -1), (self.kids, 0)):
            column.append(value)
        self._attach(child, node)
        return node

    def _attach(self, child: int, node: int) -> None:
        self.parent[child] = node
        self.kids[node] += 1
        self.n[node] += self.n[child]
        self.least[node] = min(self.least[node], self.least[child])
        self.hi[node] = self.hi[child]


def forest_rows(keys: list[bytes], ids: np.ndarray, sizes: list[np.ndarray], left: int, right: int, part: int) -> pa.Table:
    """All nodes of one partition's sorted sequences.

    ``left`` and ``right``: turns shared with the neighbouring partitions, -1 without a neighbour.  State
    "done": a whole row; "waits": whole but for the parent's conv_id; "open": a
    part of a node of several partitions; "ends": a piece of the ids that end at an open node.
    """
    starts = [0] + [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]]
    stops = starts[1:] + [len(keys)]
    m = len(starts)
    runs = [keys[i] for i in starts]
    lengths = [len(k) // DIGEST for k in runs]
    lcp = [0] + [shared(runs[r - 1], runs[r]) for r in range(1, m)]
    forest = Forest(lengths, lcp, [b - a for a, b in zip(starts, stops)], [int(ids[a]) for a in starts])
    offset = np.concatenate([[0], np.cumsum([k + 1 for k in lengths])]).astype(np.int64)
    bytes_to = np.concatenate([np.concatenate([[0], np.cumsum(sizes[i])]) for i in starts]).astype(np.int64)

    depth, n, least, lo, hi, parent, kids = (np.array(x, dtype=np.int64) for x in (
        forest.depth, forest.n, forest.least, forest.lo, forest.hi, forest.parent, forest.kids))
    above = np.where(parent >= 0, depth[parent], -1)
    open_to = np.maximum(np.where(lo == 0, left, -1), np.where(hi == m, right, -1))
    held = bytes_to[offset[lo] + depth]
    done_chain = (n - 1) * (held - bytes_to[offset[lo] + np.clip(np.minimum(open_to, depth), np.maximum(above, 0), None)])
    leaves = ((kids == 0) & (depth > open_to)).astype(np.int64)
    saved = np.zeros(len(depth), dtype=np.int64)
    done_kids = np.zeros(len(depth), dtype=np.int64)
    for c in np.argsort(-depth, kind="stable"):  # children lie deeper than their parents
        p = parent[c]
        if p >= 0:
            leaves[p] += leaves[c]
            saved[p] += saved[c] + done_chain[c]
            done_kids[p] += depth[p] + 1 > open_to[c]

    # One row per depth of each branching node's chain.
    steps = depth - above
    c = np.repeat(np.arange(len(depth)), steps)
    t = np.arange(len(c)) - np.repeat(np.cumsum(steps) - steps, steps) + above[c] + 1
    at_end, at_start, is_open = t == depth[c], t == above[c] + 1, t <= open_to[c]
    before = bytes_to[offset[lo[c]] + np.maximum(t - 1, 0)]
    size = bytes_to[offset[lo[c]] + t] - before
    base = np.where(is_open, bytes_to[offset[lo[c]] + np.minimum(np.maximum(open_to[c], 0), depth[c])], before)
    parent_conv = np.where(at_start, least[parent[c]], least[c])
    parent_open = np.where(at_start, (parent[c] >= 0) & (above[c] <= open_to[parent[c]]), t - 1 <= open_to[c])
    waits = ~is_open & parent_open & (t > 0)
    on_left, on_right = prefix_ids(runs[0], max(left, 0)), prefix_ids(runs[-1], max(right, 0))

    def name(node: int, turns: int) -> bytes | None:
        if turns < 0:
            return None
        return on_left[turns] if lo[node] == 0 and turns <= left else on_right[turns]

    names, parent_names = [None] * len(c), [None] * len(c)
    for i in np.flatnonzero(is_open | waits):
        if is_open[i]:
            names[i] = name(c[i], t[i])
        parent_names[i] = name(parent[c[i]] if at_start[i] and parent[c[i]] >= 0 else c[i], t[i] - 1)
    ends = [None if o else NO_ENDS for o in is_open]
    pieces = []
    for i in np.flatnonzero(at_end & (c < m)):  # nodes at which sequences end
        own = ids[starts[c[i]]:stops[c[i]]].tolist()
        if not is_open[i]:
            ends[i] = hashlib.sha256(",".join(map(str, own)).encode()).hexdigest()
        else:
            pieces += [(names[i], k, ",".join(map(str, own[a:a + IDS_PER_PIECE])))
                       for k, a in enumerate(range(0, len(own), IDS_PER_PIECE))]
    state = np.where(is_open, "open", np.where(waits, "waits", "done"))
    n_rows, n_pieces = len(c), len(pieces)

    def column(values, kind, after=None) -> pa.Array:
        out = pa.array(values, kind)
        return pa.concat_arrays([out, pa.nulls(n_pieces, kind) if after is None else pa.array(after, kind)])

    unknown = is_open | waits | (t == 0)
    long = pa.int64()
    return pa.table({
        "state": column(state.tolist(), pa.string(), ["ends"] * n_pieces),
        "part": column([part] * n_rows, pa.int32(), [part] * n_pieces),
        "id": column(names, pa.binary(), [p[0] for p in pieces]),
        "parent_id": column(parent_names, pa.binary()),
        "conv_id": column(least[c], long),
        "depth": column(t, long),
        "parent_conv_id": pa.concat_arrays([pa.array(parent_conv, long, mask=unknown), pa.nulls(n_pieces, long)]),
        "n_convs": column(n[c], long),
        "n_children": column(np.where(at_end, done_kids[c], t + 1 > open_to[c]).astype(np.int64), long),
        "n_leaves": column(leaves[c], long),
        "saved_tokens": column(saved[c] + (n[c] - 1) * (held[c] - base), long),
        "ends_sha256": column(ends, pa.string()),
        "bytes": column(size, long),
        "piece": pa.concat_arrays([pa.nulls(n_rows, pa.int32()), pa.array([p[1] for p in pieces], pa.int32())]),
        "ids": pa.concat_arrays([pa.nulls(n_rows, pa.string()), pa.array([p[2] for p in pieces], pa.string())]),
    })


def shared_across(table: DataFrame) -> dict[int, int]:
    """Turns that the first sequence of each partition shares with the last of the one before it (-1: the first one).

    One row per partition takes part.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = zip(b.column(1).to_pylist(), b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([-1 if z is None else shared(z, a) for a, z in pairs],
                                                                    pa.int32())], ["part", "turns"])

    bounds = table.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    both = bounds.select("part", "first", F.lag("last").over(Window.orderBy("part")).alias("before"))
    return {r["part"]: r["turns"] for r in both.mapInArrow(run, "part int, turns int").collect()}


def joined_ends(pieces: DataFrame) -> DataFrame:
    """(id, ends_sha256): the pieces of each node's ids, in order, through one running hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, h = None, None
        for b in batches:
            ids, ends = [], []
            for own, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if own != current:
                    if current is not None:
                        ids.append(current)
                        ends.append(h.hexdigest())
                    current, h = own, hashlib.sha256(text.encode())
                else:
                    h.update(b"," + text.encode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(ends, pa.string())], ["id", "ends_sha256"])
        if current is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current], pa.binary()), pa.array([h.hexdigest()])], ["id", "ends_sha256"])

    dealt = pieces.repartition("id").sortWithinPartitions("id", "part", "piece")
    return dealt.select("id", "ids").mapInArrow(run, "id binary, ends_sha256 string")


def merged_open(found: DataFrame, parts: list[int]) -> DataFrame:
    """The open nodes of all partitions, equal ones merged: ``NODE`` columns and id."""
    opened = found.where(F.col("state") == "open")
    total = {c: F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")}
    nodes = checkpointed(opened.groupBy("id").agg(
        F.min("part").alias("born"), F.max("part").alias("last"), F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"), F.max("bytes").alias("bytes"), F.max("parent_id").alias("parent_id"), *total.values()))
    kids = nodes.groupBy(F.col("parent_id").alias("id")).agg(F.count(F.lit(1)).alias("open_kids")).where(F.col("id").isNotNull())
    nodes = checkpointed(
        nodes.join(kids, "id", "left")
        .withColumn("n_children", F.col("n_children") + F.coalesce("open_kids", F.lit(0)))
        .withColumn("own_leaf", (F.col("n_children") == 0).cast("long"))
        .withColumn("own_saved", (F.col("n_convs") - 1) * F.col("bytes")))

    # Open nodes that begin in a partition reach into the next one: they lie on one path.  So those below a
    # node are the ones born from its own place up to the partition in which it ends.
    sums = {r["born"]: (r["leaf"], r["saved"]) for r in nodes.groupBy("born").agg(
        F.sum("own_leaf").alias("leaf"), F.sum("own_saved").alias("saved")).collect()}
    running, rows = (0, 0), []
    for part in sorted(parts):
        rows.append((part, *running))
        running = tuple(a + b for a, b in zip(running, sums.get(part, (0, 0))))
    until = nodes.sparkSession.createDataFrame(rows, "part int, leaf long, saved long")  # a row per partition
    shallower = Window.partitionBy("born").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)

    def below(own: str, name: str) -> Column:
        return F.col(f"last_{name}") - F.col(f"born_{name}") - F.coalesce(F.sum(own).over(shallower), F.lit(0))

    for side in ("born", "last"):
        nodes = nodes.join(F.broadcast(until.select(F.col("part").alias(side), F.col("leaf").alias(f"{side}_leaf"),
                                                    F.col("saved").alias(f"{side}_saved"))), side)
    names = nodes.select(F.col("id").alias("parent_id"), F.col("conv_id").alias("parent_conv_id"))
    ends = joined_ends(found.where(F.col("state") == "ends").select("id", "part", "piece", "ids"))
    summed = nodes.withColumns({"n_leaves": F.col("n_leaves") + below("own_leaf", "leaf"),
                                "saved_tokens": F.col("saved_tokens") + below("own_saved", "saved")})
    return checkpointed(summed.join(names, "parent_id", "left").join(ends, "id", "left")
                        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS))).select("id", *NODE))


def prefix_trie(sequences: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """All nodes of the trie of ``sequences`` (conv_id, key, sizes), the root too.

    conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (over the
    subtree: members less one, times the bytes of the node's text), ends_sha256 (of the members that end here).
    """
    spark = sequences.sparkSession
    sequences = checkpointed(sequences)
    held = sequences.agg(F.sum(F.size("sizes").cast("long") * (DIGEST + 8) + 16)).first()[0] or 0
    n_parts = tasks_for(spark, buckets_for(held, part_bytes))
    table = checkpointed(sequences.repartitionByRange(n_parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")
                         .withColumn("part", F.spark_partition_id()))
    left = shared_across(table)
    order = sorted(left)
    right = {a: left[b] for a, b in zip(order, order[1:])}
    known = spark.sparkContext.broadcast((left, right))  # two numbers per partition

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("key", "ascending"), ("conv_id", "ascending")])
        part = group.column("part")[0].as_py()
        lefts, rights = known.value
        return forest_rows(group.column("key").to_pylist(), group.column("conv_id").to_numpy(),
                           [np.array(s, dtype=np.int64) for s in group.column("sizes").to_pylist()],
                           lefts[part], rights.get(part, -1), part)

    found = checkpointed(table.repartition(n_parts, "part").groupBy("part").applyInArrow(run, FOUND))
    opened = merged_open(found, order)
    # Each partition looks up its own open nodes: no key gathers more rows than a partition has.
    names = (found.where(F.col("state") == "open").select("part", "id")
             .join(opened.select("id", F.col("conv_id").alias("parent_conv_id")), "id")
             .select("part", F.col("id").alias("parent_id"), "parent_conv_id"))
    waiting = found.where(F.col("state") == "waits").drop("parent_conv_id").join(names, ["part", "parent_id"])
    done = found.where(F.col("state") == "done")
    return done.select(NODE).unionByName(waiting.select(NODE)).unionByName(opened.select(NODE))


def conversation_trie(conversations: DataFrame, family: int = 5, heads: int = 9, part_bytes: int = PART_BYTES) -> DataFrame:
    """The trie of the conversations as ``regrown`` rebuilds them."""
    return prefix_trie(keyed(regrown(turn_sequences(conversations), family, heads)), part_bytes)


# The nodes by grouping on whole prefixes, and subtrees by comparing them; crc32 is written out bit by bit.
TRIE_SQL = """
WITH turns AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), crc AS (
  SELECT conv_id, turns, xor(list_reduce(list_concat([4294967295::UBIGINT], flatten(list_transform(
      string_split(conv_id::VARCHAR, ''), lambda ch: list_transform(range(8),
        lambda k: CASE WHEN k = 0 THEN 1000 + ord(ch) ELSE 1000 END::UBIGINT)))),
    lambda a, b: CASE WHEN xor(a, b - 1000) % 2 = 1 THEN xor(xor(a, b - 1000) >> 1, 3988292384::UBIGINT)
                      ELSE xor(a, b - 1000) >> 1 END), 4294967295::UBIGINT) % 9 AS h
  FROM turns
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h::BIGINT], []), c.turns[c.h::BIGINT + 1:]) AS turns
  FROM crc c LEFT JOIN turns b ON b.conv_id = c.conv_id - ((c.conv_id % 5) + 5) % 5
), nodes AS (
  SELECT turns[1:d] AS prefix, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(turns) = d), '')) AS ends_sha256
  FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM rebuilt) GROUP BY ALL
), linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id,
         (SELECT count(*) FROM nodes k WHERE k.depth = n.depth + 1 AND k.prefix[1:n.depth] = n.prefix) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]
)
SELECT a.conv_id, a.depth, a.parent_conv_id, a.n_convs, a.n_children,
       count(*) FILTER (WHERE s.n_children = 0) AS n_leaves,
       sum(CASE WHEN s.depth = 0 THEN 0 ELSE (s.n_convs - 1) * strlen(s.prefix[s.depth].text) END)::BIGINT AS saved_tokens,
       a.ends_sha256
FROM linked a JOIN linked s ON s.depth >= a.depth AND s.prefix[1:a.depth] = a.prefix
GROUP BY a.prefix, a.conv_id, a.depth, a.parent_conv_id, a.n_convs, a.n_children, a.ends_sha256
"""
