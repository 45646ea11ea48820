"""Token ids as Arrow files of equal-length sequences and masks.

Method: documents in ascending doc_id order become one stream of ids, each
with one end id.  A range of documents is written to one Arrow IPC file (the
stream format between two magic strings, with the places of its batches at the
end).  Its batches hold a fixed number of rows (``ids``: fixed-size list of unsigned
integers, of 16 bits if the vocabulary has no more than 65,536 ids, else of 32; ``mask``:
fixed-size list of booleans, false for the padding of the file's last sequence), so a sequence is found by
arithmetic and read as a view of the mapped file.  A second Arrow file beside it tells where each document starts.

Files are written by the tasks into the shared folder under a name of their
own for every attempt; the manifest, which Spark commits, names the files that count.
A task that is run again writes other files and no reader sees half a one.  The folder is
named by the caller or lies in the checkpoint folder, on any store pyarrow can
open by its URI.  A task holds one Arrow batch of texts, ``SLICE_BYTES`` of
their words and one batch of sequences; the driver gets a few numbers per file.

Defined results: a null or empty text is its end id alone; null doc_ids come
first; rows that share a doc_id are ordered by a hash of their text, and repeated
rows are documents of their own (they are dealt over files by row, so
no doc_id has to fit one task); an empty table gives no files; very long
texts run on over batches; other columns of the input are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.llm.common import buckets_for, id_and_text, tasks_for, text_bytes
from tabspark.llm.tokencount import DEFAULT_TOKENIZER, tokenizer
from tabspark.llm.wordhash import slices, utf8
from tabspark.session import scratch_path

SEQUENCE_TOKENS = 2048
END_ID = 1
BATCH_SEQUENCES = 64
FILE_TEXT_BYTES = 64 << 20
SLICE_BYTES = 16 << 20
MEMO_WORDS = 500_000

# Between an ASCII letter and one of these marks the tokenizer always starts a new word (see ``tokencount``).
CUT = "([A-Za-z])([.,;:!?])"

MANIFEST = "part int, sequences string, documents string, n_docs long, n_tokens long, n_sequences long"
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def sequence_schema(length: int, kind: pa.DataType) -> pa.Schema:
    """``ids`` as narrow as the vocabulary allows and ``mask`` as bits, both lists of ``length``."""
    return pa.schema([pa.field("ids", pa.list_(pa.field("item", kind, nullable=False), length), nullable=False),
                      pa.field("mask", pa.list_(pa.field("item", pa.bool_(), nullable=False), length), nullable=False)])


class WordIds:
    """Ids of texts by their pre-tokens, cut as in ``tokencount`` but for many texts at once.

    Arrow cuts the texts and numbers the distinct pre-tokens of a slice; each is encoded
    once, as long as it is remembered.
    """

    def __init__(self, path: str, most: int = MEMO_WORDS):
        self.tokenizer, self.most = tokenizer(path), most
        self.kind = pa.uint16() if self.tokenizer.get_vocab_size() <= 1 << 16 else pa.uint32()
        self.memo: dict[bytes, bytes] = {}

    def pre_tokens(self, texts: pa.Array) -> pa.ListArray:
        plain = pc.and_(pc.string_is_ascii(texts), pc.invert(pc.match_substring(texts, "<|")))
        raw = pc.if_else(plain, pc.ascii_lower(texts), texts).cast(pa.binary())
        return pc.ascii_split_whitespace(pc.replace_substring_regex(raw, CUT, r"\1 \2").cast(pa.string()))

    def look_up(self, words: list[bytes]) -> list[bytes]:
        new = [w for w in words if w not in self.memo]
        for i in range(0, len(new), 10_000):
            found = self.tokenizer.encode_batch_fast([w.decode() for w in new[i:i + 10_000]], add_special_tokens=False)
            self.memo.update(zip(new[i:i + 10_000], (array("I", e.ids).tobytes() for e in found)))
        ids = [self.memo[w] for w in words]
        if len(self.memo) > self.most:  # the words of this slice stay, frequent ones among them
            self.memo = dict(zip(words, ids))
        return ids

    def slice_ids(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with its end id; number of ids of each text)."""
        cut = self.pre_tokens(texts)
        words = cut.flatten().cast(pa.binary()).dictionary_encode()
        found = self.look_up(words.dictionary.to_pylist())
        sizes = np.array([len(x) // 4 for x in found], dtype=np.int32)
        lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32),
                                         pa.array(np.frombuffer(b"".join(found), dtype="<u4")))
        flat = lists.take(words.indices).flatten().to_numpy()
        until = np.concatenate([[0], np.cumsum(sizes[words.indices.to_numpy()])])
        offsets = cut.offsets.to_numpy()
        ends = until[offsets[1:] - offsets[0]]
        return np.insert(flat, ends, end_id), np.diff(ends, prepend=0) + 1

    def texts(self, texts: pa.Array, end_id: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``slice_ids`` of runs of texts of at most ``SLICE_BYTES`` (a longer text by itself)."""
        for i, j in slices(utf8(texts)[1], SLICE_BYTES):
            yield self.slice_ids(texts.slice(i, j - i), end_id)


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """Kept by a worker for its later tasks."""
    return WordIds(path)


class SequenceWriter:
    """One Arrow file of sequences, written batch by batch."""

    def __init__(self, uri: str, length: int, batch_sequences: int, kind: pa.DataType):
        store, path = pa.fs.FileSystem.from_uri(uri)
        self.sink = store.open_output_stream(path)
        self.schema = sequence_schema(length, kind)
        self.out = pa.ipc.new_file(self.sink, self.schema)
        self.length, self.full = length, length * batch_sequences
        self.held = np.zeros(0, dtype=kind.to_pandas_dtype())
        self.n_tokens = self.n_sequences = 0

    def add(self, ids: np.ndarray) -> None:
        self.n_tokens += len(ids)
        self.held = np.concatenate([self.held, ids.astype(self.held.dtype)])
        whole = len(self.held) // self.full * self.full
        for a in range(0, whole, self.full):
            self._write(self.held[a:a + self.full])
        self.held = self.held[whole:]

    def _write(self, ids: np.ndarray) -> None:
        rows = -(-len(ids) // self.length)
        flat, mask = np.zeros(rows * self.length, dtype=ids.dtype), np.arange(rows * self.length) < len(ids)
        flat[:len(ids)] = ids
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type) for x, f in zip((flat, mask), self.schema)]
        self.out.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.n_sequences += rows

    def close(self) -> None:
        if len(self.held):
            self._write(self.held)
        self.out.close()
        self.sink.close()


class SequenceFile:
    """Sequences of one file by number; a local file is mapped and its sequences are views of it."""

    def __init__(self, uri: str):
        store, path = pa.fs.FileSystem.from_uri(uri)
        local = isinstance(store, pa.fs.LocalFileSystem)
        self.reader = pa.ipc.open_file(pa.memory_map(path) if local else store.open_input_file(path))
        self.length = self.reader.schema.field("ids").type.list_size
        self.per_batch = self.reader.get_batch(0).num_rows
        self.at, self.views = -1, (None, None)

    def batch(self, k: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """(ids, mask) of batch ``k``, one sequence after another."""
        if k != self.at:
            b = self.reader.get_batch(k)
            self.at, self.views = k, (b.column(0).values.to_numpy(zero_copy_only=True), b.column(1).values)
        return self.views

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """(ids, mask) of sequence ``i``, views of the file."""
        k, row = divmod(i, self.per_batch)
        ids, mask = self.batch(k)
        return ids[row * self.length:(row + 1) * self.length], mask.slice(row * self.length, self.length)

    def tokens(self, start: int, n: int) -> Iterator[np.ndarray]:
        """Views of the ``n`` ids from ``start`` on, one per batch that holds some."""
        size = self.per_batch * self.length
        while n > 0:
            k, place = divmod(start, size)
            ids, mask = self.batch(k)
            view = ids[place:place + n]
            if not len(view) or not mask[place + len(view) - 1].as_py():  # padding comes last
                raise ValueError("the file ends before the document")
            yield view
            start, n = start + len(view), n - len(view)


class TokenFiles:
    """Random access to all sequences of a folder by number, from its manifest rows."""

    def __init__(self, manifest: list):
        rows = sorted(manifest, key=lambda r: r["part"])
        self.uris, self.firsts = [r["sequences"] for r in rows], [r["first_sequence"] for r in rows]
        self.n = rows[-1]["first_sequence"] + rows[-1]["n_sequences"] if rows else 0
        self.files: dict[str, SequenceFile] = {}

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        if not 0 <= i < self.n:
            raise IndexError(i)
        k = bisect_right(self.firsts, i) - 1
        uri = self.uris[k]
        if uri not in self.files:
            self.files[uri] = SequenceFile(uri)
        return self.files[uri][i - self.firsts[k]]


def write_tokens(docs: DataFrame, folder: str | None = None, tokenizer_path: str | None = None, end_id: int = END_ID,
                 length: int = SEQUENCE_TOKENS, batch_sequences: int = BATCH_SEQUENCES,
                 file_text_bytes: int = FILE_TEXT_BYTES) -> str:
    """Tokenise, order and write all documents; the folder that holds the files and their ``manifest``."""
    spark = docs.sparkSession
    folder = (folder or scratch_path(spark, f"tokens/{uuid.uuid4().hex}")).rstrip("/")
    path = tokenizer_path or public_tokenizers.path(DEFAULT_TOKENIZER)
    docs = id_and_text(docs)
    n_files = tasks_for(spark, buckets_for(text_bytes(docs), file_text_bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, words, start = TaskContext.get().partitionId(), None, word_ids(path), 0
        stem = f"{part:06d}-{uuid.uuid4().hex}.arrow"
        uris = [f"{folder}/{kind}-{stem}" for kind in ("sequences", "documents")]
        for batch in batches:
            if out is None:
                store, place = pa.fs.FileSystem.from_uri(uris[1])
                store.create_dir(place.rsplit("/", 1)[0], recursive=True)
                out, n_docs = SequenceWriter(uris[0], length, batch_sequences, words.kind), 0
                index_sink = store.open_output_stream(place)
                index = pa.ipc.new_file(index_sink, INDEX)
            sizes = [np.zeros(0, dtype=np.int64)]
            for ids, own in words.texts(batch.column(1), end_id):
                out.add(ids)
                sizes.append(own)
            sizes = np.concatenate(sizes)
            starts = start + np.cumsum(sizes) - sizes
            index.write_batch(pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())], schema=INDEX))
            start, n_docs = start + int(sizes.sum()), n_docs + len(sizes)
        if out is not None:
            out.close()
            index.close()
            index_sink.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "sequences": uris[0], "documents": uris[1], "n_docs": n_docs,
                                               "n_tokens": out.n_tokens, "n_sequences": out.n_sequences}],
                                             pa.schema([("part", pa.int32()), ("sequences", pa.string()),
                                                        ("documents", pa.string()), ("n_docs", pa.int64()),
                                                        ("n_tokens", pa.int64()), ("n_sequences", pa.int64())]))

    order = ["doc_id", "own", "row"]  # the row number deals repeated rows over files
    keyed = docs.withColumns({"own": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    files = (keyed.repartitionByRange(n_files, *order).sortWithinPartitions(*order).select("doc_id", "text")
             .mapInArrow(run, MANIFEST))
    files.write.parquet(f"{folder}/written")
    written = spark.read.schema(MANIFEST).parquet(f"{folder}/written")
    rows, tokens, sequences = [], 0, 0
    for r in sorted(written.collect(), key=lambda r: r["part"]):  # a row per file
        rows.append((*r, tokens, sequences))
        tokens, sequences = tokens + r["n_tokens"], sequences + r["n_sequences"]
    spark.createDataFrame(rows, MANIFEST + ", first_token long, first_sequence long").write.parquet(f"{folder}/manifest")
    return folder


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file: its places, counts, and the ids and sequences before it."""
    return spark.read.parquet(f"{folder}/manifest")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file = SequenceFile(row["sequences"])
                store, place = pa.fs.FileSystem.from_uri(row["documents"])
                with store.open_input_file(place) as source:
                    reader = pa.ipc.open_file(source)
                    for k in range(reader.num_record_batches):
                        index = reader.get_batch(k)
                        starts = index.column(1).to_numpy()
                        sums = []
                        for start, n in zip(starts.tolist(), index.column(2).to_pylist()):
                            crc = 0
                            for view in file.tokens(start, n):
                                crc = zlib.crc32(view.astype("<u4"), crc)
                            sums.append(crc)
                        yield pa.RecordBatch.from_arrays(
                            [index.column(0), pa.array(starts + row["first_token"]), index.column(2), pa.array(sums, pa.int64())],
                            ["doc_id", "start", "n_tokens", "ids_crc32"])

    files = manifest(spark, folder).select("part", "sequences", "documents", "first_token")
    return (files.repartition(max(1, files.count()), "part")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def token_files(docs: DataFrame, **options) -> DataFrame:
    """Write ``docs`` and read the files back."""
    return read_documents(docs.sparkSession, write_tokens(docs, **options))
