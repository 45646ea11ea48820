"""Removal of word passages that occur earlier in the corpus.

Method: fixed-block anchors.  Every document is cut into non-overlapping
reference blocks of ``window // 2`` words, and every rolling window of that
length, in every document, probes the index of blocks.  Any repeated passage
of ``window`` words holds a whole block of its first occurrence, so each of its
occurrences is hit.  Hits are extended: every window of ``window`` words around
a hit is fingerprinted, its first occurrence in document order is found, and
the later windows of a document merge into maximal repeats.

Scale.  Documents are dealt into chunks of some ``CHUNK_BYTES`` of text, each
written once (compressed) to a table in the shared folder, bucketed by chunk.  A
chunk sends each distinct hash once, sorted and delta-coded, so what a
passage costs is bounded by the number of chunks and not by its copies: no
pairs of occurrences are ever made and a passage in a third of all documents is
one entry per chunk.  Answers come back per chunk.  Block hashes have 48 bits (a false
hit only adds candidates); windows are compared by 96 bits.

Order: documents by doc_id, null doc_ids last; rows that share a doc_id by
the hash of their text; identical rows one after the other.

Defined results: a null or empty text has no words; a document shorter than a
window keeps all its words; of identical rows the later ones count as
repeats; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspark.llm.common import buckets_for, checkpointed, id_and_text, tasks_for, text_bytes
from tabspark.llm.wordhash import Words, grams, mix, slices, utf8
from tabspark.session import scratch_path

WINDOW_WORDS = 20
CHUNK_BYTES = 4 << 20
PART_BYTES = 16 << 20  # of text for each part of the index
MAX_BUCKETS = 100_000  # of a written table; a bucket then holds several chunks
HASH_BITS = 48
JUMP = (1 << 30) - 1  # a delta code that only moves on
SECOND_STEP = 0xC2B2AE3D27D4EB4F
NULL_ID = (1 << 63) - 1

CHUNKED = "chunk int, doc_id long, tie long, packed binary"
SENT = "part int, chunk int, payload binary"
ANSWER = "chunk int, kind int, part int, payload binary"


def chunks(docs: DataFrame) -> tuple[DataFrame, int]:
    """(chunk, doc_id, tie, packed) and the bytes of all texts: each text compressed, written once by chunk."""
    docs = id_and_text(docs)
    total = text_bytes(docs)
    n = buckets_for(total, CHUNK_BYTES)
    # Rows of one doc_id share a chunk; rows without one are spread by their text.
    key = F.xxhash64(F.coalesce(F.col("doc_id"), F.xxhash64("text")))
    keyed = docs.select(F.pmod(key, F.lit(n).cast("long")).cast("int").alias("chunk"), "doc_id",
                        F.xxhash64("text").alias("tie"), "text")

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3, write_content_size=True)
        for batch in batches:
            packed = [press.compress(t.encode()) for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(packed, pa.binary())],
                                             ["chunk", "doc_id", "tie", "packed"])

    buckets = min(tasks_for(docs.sparkSession, n), MAX_BUCKETS)
    dealt = keyed.mapInArrow(compress, CHUNKED).repartition(buckets, "chunk")
    return bucketed(dealt, "chunk", buckets), total


def bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``df`` written to the shared folder in buckets of ``key``: grouping by it then needs no shuffle."""
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    (df.write.bucketBy(buckets, key).option("path", scratch_path(spark, name)).option("compression", "none")
     .format("parquet").saveAsTable(name))
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # an external table: the files stay, and so does the resolved plan
    return out


def in_order(group: pa.Table) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """(order key, doc_id, packed) of a chunk's rows in document order."""
    ids = group.column("doc_id").combine_chunks()
    keys = ids.fill_null(NULL_ID).to_numpy()
    order = np.lexsort((group.column("tie").to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), keys))
    return keys[order], ids.take(order), group.column("packed").combine_chunks().take(order)


def chunk_words(packed: pa.Array) -> Iterator[tuple[int, int, Words]]:
    """(i, j, words of the rows [i, j)) of a chunk, a few megabytes at a time."""
    unpress = zstandard.ZstdDecompressor()
    sizes = [zstandard.frame_content_size(p.as_buffer().to_pybytes()) for p in packed]
    offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    for i, j in slices(offsets):
        texts = pa.array([unpress.decompress(packed[k].as_py()) if sizes[k] else b"" for k in range(i, j)], pa.large_binary())
        yield i, j, Words(*utf8(texts))


def block_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    return grams(hashes, k) >> np.uint64(64 - HASH_BITS)


def encode(hashes: np.ndarray, flags: np.ndarray, low: int) -> bytes:
    """Sorted distinct hashes from ``low`` on, with two flag bits each, as 32-bit deltas."""
    delta = np.diff(hashes, prepend=np.uint64(low))
    jumps = (delta // np.uint64(JUMP)).astype(np.int64)
    code = ((delta % np.uint64(JUMP)) << np.uint64(2) | flags).astype("<u4")
    if jumps.any():
        out = np.full(len(code) + int(jumps.sum()), JUMP << 2, dtype="<u4")
        out[np.arange(len(code)) + np.cumsum(jumps)] = code
        code = out
    return code.tobytes()


def decode(payload: bytes, low: int) -> tuple[np.ndarray, np.ndarray]:
    code = np.frombuffer(payload, dtype="<u4").astype(np.uint64)
    at = np.cumsum(code >> np.uint64(2)) + np.uint64(low)
    real = (code >> np.uint64(2)) != np.uint64(JUMP)
    return at[real], code[real] & np.uint64(3)


def part_low(part: int, parts: int) -> int:
    """The least hash of a part."""
    return -(-(part << HASH_BITS) // parts)


def probes(chunked: DataFrame, window: int, parts: int) -> DataFrame:
    """(part, chunk, payload): each chunk's distinct rolling-window hashes, flagged 1: more than once, 2: a block."""
    k = window // 2
    lows = np.array([part_low(p, parts) for p in range(parts + 1)], dtype=np.uint64)

    def run(group: pa.Table) -> pa.Table:
        chunk = group.column("chunk")[0].as_py()
        _, _, packed = in_order(group)
        own = []
        for _, _, words in chunk_words(packed):
            room = words.room(k)
            block = (np.arange(len(words.start)) - words.first[words.doc]) % k == 0
            own.append(((block_hashes(words.hashes(), k) << np.uint64(1)) | block)[room])
        codes = np.sort(np.concatenate(own)) if own else np.zeros(0, np.uint64)
        hashes = codes >> np.uint64(1)
        first = np.flatnonzero(np.diff(hashes, prepend=np.uint64(1 << 63)) != 0)
        count = np.diff(first, append=len(hashes))
        is_block = (codes[first + count - 1] & np.uint64(1)) if len(first) else np.zeros(0, np.uint64)
        flags, hashes = (count > 1).astype(np.uint64) | is_block << np.uint64(1), hashes[first]
        cut = np.searchsorted(hashes, lows)
        full = [p for p in range(parts) if cut[p] < cut[p + 1]]
        sent = [encode(hashes[cut[p]:cut[p + 1]], flags[cut[p]:cut[p + 1]], int(lows[p])) for p in full]
        return pa.table({"part": pa.array(full, pa.int32()), "chunk": pa.array([chunk] * len(full), pa.int32()),
                         "payload": pa.array(sent, pa.binary())})

    return chunked.groupBy("chunk").applyInArrow(run, SENT)


def hits(sent: DataFrame, parts: int) -> DataFrame:
    """(chunk, 0, payload): to each chunk the hashes it sent that are a block somewhere and occur twice anywhere."""

    def run(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        low = part_low(part, parts)
        chunk = group.column("chunk").to_pylist()
        decoded = [decode(p.as_py(), low) for p in group.column("payload")]
        hashes = np.concatenate([h for h, _ in decoded])
        owner = np.repeat(np.arange(len(decoded)), [len(h) for h, _ in decoded])
        flags = np.concatenate([f for _, f in decoded])
        del decoded
        order = np.argsort(hashes, kind="stable")
        hashes, owner, flags = hashes[order], owner[order], flags[order]
        first = np.flatnonzero(np.diff(hashes, prepend=np.uint64(1 << 63)) != 0)
        count = np.diff(first, append=len(hashes))
        met = np.bitwise_or.reduceat(flags, first)
        hit = np.repeat((met & np.uint64(2) != 0) & ((count > 1) | (met & np.uint64(1) != 0)), count)
        hashes, owner = hashes[hit], owner[hit]
        back = np.argsort(owner, kind="stable")
        cut = np.searchsorted(owner[back], np.arange(len(chunk) + 1))
        full = [i for i in range(len(chunk)) if cut[i] < cut[i + 1]]
        own = [hashes[back[cut[i]:cut[i + 1]]] for i in full]
        return answers([chunk[i] for i in full], 0, part, [encode(h, np.uint64(0), low) for h in own])

    return sent.groupBy("part").applyInArrow(run, ANSWER)


def answers(chunk: list[int], kind: int, part: int, payloads: list[bytes]) -> pa.Table:
    n = len(chunk)
    return pa.table({"chunk": pa.array(chunk, pa.int32()), "kind": pa.array([kind] * n, pa.int32()),
                     "part": pa.array([part] * n, pa.int32()), "payload": pa.array(payloads, pa.binary())})


def answered(group: pa.Table, kind: int) -> dict[int, bytes]:
    """Payloads of a kind by part, in order of the parts."""
    rows = zip(group.column("kind").to_pylist(), group.column("part").to_pylist(), group.column("payload"))
    return dict(sorted((part, payload.as_py()) for k, part, payload in rows if k == kind))


def hit_hashes(group: pa.Table, parts: int) -> np.ndarray:
    """The sorted hashes that hit, of a chunk's answers."""
    found = [decode(payload, part_low(part, parts))[0] for part, payload in answered(group, 0).items()]
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Whether each value is in the sorted ``of``."""
    if not len(of):
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(of, values)
    return of[np.minimum(at, len(of) - 1)] == values


def candidates(words: Words, hit: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word position, fingerprint, second fingerprint) of the windows that hold a hit, in order."""
    k = window // 2
    hashes = words.hashes()
    n = len(hashes)
    at = np.flatnonzero(words.room(k) & member(block_hashes(hashes, k), hit))
    # A window from p on holds a hit at any of p .. p + window - k.
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, np.maximum(at - (window - k), words.first[words.doc[at]]), 1)
    np.add.at(edge, at + 1, -1)
    place = np.flatnonzero((np.cumsum(edge[:n]) > 0) & words.room(window))
    if not len(place):
        return place, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return place, grams(hashes, window)[place], grams(mix(hashes), window, SECOND_STEP)[place] >> np.uint64(32)


def chunk_candidates(packed: pa.Array, hit: np.ndarray, window: int):
    """Candidates of a whole chunk: (row, word in row, two fingerprints) in document order, and words per row."""
    parts, counts = [], np.zeros(len(packed), dtype=np.int64)
    for i, j, words in chunk_words(packed):
        counts[i:j] = words.count
        place, one, two = candidates(words, hit, window)
        row = words.doc[place]
        parts.append((row + i, place - words.first[row], one, two))
    joined = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 2 + [np.zeros(0, np.uint64)] * 2
    return (*joined, counts)


def distinct_windows(one: np.ndarray, two: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by fingerprints, starts of the distinct ones in it, cut of these by part)."""
    order = np.lexsort((two, one))  # stable: the first occurrence leads
    a, b = one[order], two[order]
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first = np.flatnonzero(new)
    part = ((a[first] >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    return order, first, np.searchsorted(part, np.arange(parts + 1))


def first_windows(chunked: DataFrame, found: DataFrame, window: int, parts: int) -> DataFrame:
    """(part, chunk, payload): each chunk's distinct candidate windows with the document of their first occurrence there."""

    def run(group: pa.Table, told: pa.Table) -> pa.Table:
        full, sent, chunk = [], [], 0
        if group.num_rows and told.num_rows:
            chunk = group.column("chunk")[0].as_py()
            keys, _, packed = in_order(group)
            row, _, one, two, _ = chunk_candidates(packed, hit_hashes(told, parts), window)
            order, first, cut = distinct_windows(one, two, parts)
            lead = order[first]
            a, b, key = one[lead], two[lead], keys[row[lead]]
            full = [p for p in range(parts) if cut[p] < cut[p + 1]]
            # Column by column, ids as byte planes: their empty upper bytes cost nothing once compressed.
            sent = [b"".join([a[s].astype("<u8").tobytes(), b[s].astype("<u4").tobytes(),
                              np.ascontiguousarray(key[s].astype("<i8")[:, None].view(np.uint8).T).tobytes()])
                    for s in (slice(cut[p], cut[p + 1]) for p in full)]
        return pa.table({"part": pa.array(full, pa.int32()), "chunk": pa.array([chunk] * len(full), pa.int32()),
                         "payload": pa.array(sent, pa.binary())})

    return chunked.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(run, SENT)


def later_windows(sent: DataFrame) -> DataFrame:
    """(chunk, 1, part, payload): to each chunk one bit per window that it sent, set if an earlier document elsewhere has it."""

    def run(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        chunk = np.array(group.column("chunk").to_pylist())
        columns: list[list[np.ndarray]] = [[], [], [], []]
        for i, payload in enumerate(group.column("payload")):
            raw = payload.as_py()
            n = len(raw) // 20
            planes = np.frombuffer(raw, np.uint8, 8 * n, 12 * n).reshape(8, n)
            for column, values in zip(columns, (np.frombuffer(raw, "<u8", n), np.frombuffer(raw, "<u4", n, 8 * n),
                                                np.ascontiguousarray(planes.T).view("<i8")[:, 0], np.full(n, i))):
                column.append(values)
        size = [len(x) for x in columns[0]]
        a, b, key, owner = (np.concatenate(c) for c in columns)
        order = np.lexsort((chunk[owner], key, b, a))
        a, b = a[order], b[order]
        again = np.zeros(len(a), dtype=bool)
        again[1:] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
        later = np.zeros(len(a), dtype=bool)
        later[order] = again
        cut = np.concatenate([[0], np.cumsum(size)])
        own = [later[cut[i]:cut[i + 1]] for i in range(len(chunk))]
        full = [i for i, bits in enumerate(own) if bits.any()]
        return answers([int(chunk[i]) for i in full], 1, part, [np.packbits(own[i]).tobytes() for i in full])

    return sent.groupBy("part").applyInArrow(run, ANSWER)


def repeated(one: np.ndarray, two: np.ndarray, told: dict[int, bytes], parts: int) -> np.ndarray:
    """Which candidate windows (in document order) occur earlier: in this chunk, or elsewhere as the bits say."""
    order, first, cut = distinct_windows(one, two, parts)
    out = np.ones(len(one), dtype=bool)
    later = np.zeros(len(first), dtype=bool)
    for part, bits in told.items():
        n = cut[part + 1] - cut[part]
        later[cut[part]:cut[part + 1]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=n)
    out[order[first]] = later
    return out


def cleaned(chunked: DataFrame, told: DataFrame, window: int, parts: int, keep_text: bool) -> DataFrame:
    """Per document its counts, the digest of what is kept, and the removed spans as maximal runs of words."""
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    fields = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
              ("removed", spans_type)] + [("kept", pa.string())] * keep_text
    schema = ("doc_id long, n_words long, n_removed long, kept_sha256 string, "
              "removed array<struct<start:long,end:long>>" + (", kept string" if keep_text else ""))

    def run(group: pa.Table, told: pa.Table) -> pa.Table:
        if not group.num_rows:
            return pa.table([pa.array([], t) for _, t in fields], [n for n, _ in fields])
        _, ids, packed = in_order(group)
        row, at, one, two, _ = chunk_candidates(packed, hit_hashes(told, parts), window)
        again = repeated(one, two, answered(told, 1), parts)
        row, at = row[again], at[again]
        rows, n_words, n_removed, digests, spans, kept = [], [], [], [], [], []
        for i, j, words in chunk_words(packed):
            lo, hi = np.searchsorted(row, [i, j])
            start = words.first[row[lo:hi] - i] + at[lo:hi]
            cover = np.zeros(len(words.start) + 1, dtype=np.int64)
            np.add.at(cover, start, 1)
            np.add.at(cover, start + window, -1)
            gone = np.cumsum(cover[:-1]) > 0
            data = words.data.tobytes()
            for d in range(j - i):
                f, l = words.first[d], words.first[d + 1]
                out = gone[f:l]
                stays = np.flatnonzero(~out) + f
                text = b" ".join([data[s:e] for s, e in zip(words.start[stays].tolist(), words.end[stays].tolist())])
                edges = np.flatnonzero(np.diff(out.astype(np.int8), prepend=0, append=0))
                n_words.append(int(l - f))
                n_removed.append(int(l - f) - len(stays))
                digests.append(hashlib.sha256(text).hexdigest())
                spans.append([{"start": s, "end": e} for s, e in edges.reshape(-1, 2).tolist()])
                if keep_text:
                    kept.append(text.decode())
        columns = [ids, n_words, n_removed, digests, spans] + [kept] * keep_text
        return pa.table([pa.array(c, t) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])

    return chunked.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(run, schema)


def remove_repeats(docs: DataFrame, window: int = WINDOW_WORDS, keep_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, removed): words of windows that occur earlier are removed.

    ``removed`` lists maximal runs [start, end) of removed words.  ``keep_text``
    adds ``kept``, the remaining words joined by one space.
    """
    chunked, total = chunks(docs)
    parts = buckets_for(total, PART_BYTES)
    tasks = tasks_for(docs.sparkSession, parts)
    found = checkpointed(hits(probes(chunked, window, parts).repartition(tasks, "part"), parts))
    sent = first_windows(chunked, found, window, parts).repartition(tasks, "part")
    told = found.unionByName(checkpointed(later_windows(sent)))
    return cleaned(chunked, told, window, parts, keep_text)
