"""Best-fit packing of tokenised documents into fixed-length sequences.

Method: bounded-space online best-fit.  Every document becomes its token ids
and one end id; documents longer than a sequence are cut, the first piece
taking the remainder.  Pieces are dealt by hash to packers, whose number
grows with the text.  A packer keeps a fixed number of open sequences in a
bitset keyed by free space: a piece goes to the open sequence with the least
free space that holds it; when none does, a new one opens, and if too many are
open the fullest is closed first.  A packer sees some 10^5 pieces (numbers only, the
ids stay behind) and never the whole table.

Defined results: a null or empty text is one piece holding the end id alone;
a null doc_id is packed like any other; repeated rows are separate documents;
an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspark.llm.common import bucket_of, buckets_for, id_and_text, tasks_for, text_bytes, tidy

SEQUENCE_TOKENS = 1024
END_ID = 2
OPEN_SEQUENCES = 2048
BYTES_PER_PACKER = 64 << 20
DEFAULT_TOKENIZER = "byte_bpe_50k.json"

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _byte_alphabet() -> dict[str, int]:
    """Byte-level BPE writes each byte as one visible character: printable Latin-1 as itself, the rest from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in shown}
    for b in range(256):
        if b not in shown:
            out[chr(256 + len(out) - len(shown))] = b
    return out


class ByteBpe:
    """Ids of a byte-level BPE file of the ``tokenizers`` library.

    Latin-1 texts without an added token's string take ``tiktoken`` with the
    ranks of the same file (seven times the speed, the same ids); every other
    text goes through ``tokenizers`` itself, so special strings and Unicode
    classes are the library's own.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = {t["content"] for t in spec["added_tokens"]}
        self.special = sorted(added)
        alphabet = _byte_alphabet()
        ranks = {bytes(alphabet[c] for c in token): i
                 for token, i in spec["model"]["vocab"].items() if token not in added}
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})

    def ids(self, text: str) -> list[int]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.slow.encode(text, add_special_tokens=False).ids
        if any(s in text for s in self.special):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


@lru_cache(maxsize=4)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: the first takes the remainder, the others are full."""
    first = n % size or min(n, size)
    starts = [0, *range(first, n, size)]
    return [(s, min(n, e) - s) for s, e in zip(starts, [*starts[1:], n])]


def tokenised_pieces(docs: DataFrame, path: str, size: int = SEQUENCE_TOKENS, end_id: int = END_ID,
                     keep_ids: bool = False) -> DataFrame:
    """One row per piece; ``keep_ids`` adds the ids themselves (array<int>)."""
    schema = PIECES + (", ids array<int>" if keep_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path)
        for batch in batches:
            rows: list[list] = [[] for _ in range(6)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*bpe.ids(text.as_py()), end_id], dtype="<u4")
                for k, (start, length) in enumerate(cut(len(ids), size)):
                    own = ids[start:start + length]
                    for column, value in zip(rows, (doc_id, k, start, length, zlib.crc32(own.tobytes()), own)):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(rows, kinds)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                arrays.append(pa.array([x.astype("i4") for x in rows[5]], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    return id_and_text(docs).mapInArrow(tidy(run), schema)


def best_fit(lengths: list[int], size: int, open_sequences: int) -> tuple[list[int], list[int]]:
    """(sequence, offset) of each length in order, by bounded-space online best-fit.

    Bit f of ``free`` is set while an open sequence has f free places, so the
    least sufficient space and the fullest sequence are both a lowest set bit.
    """
    free, by_free, n_open, n_made = 0, [[] for _ in range(size + 1)], 0, 0
    sequences, offsets = [], []
    for length in lengths:
        fits = free >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            sequence = by_free[space].pop()
            if not by_free[space]:
                free ^= 1 << space
        else:
            if n_open == open_sequences:
                fullest = (free & -free).bit_length() - 1
                by_free[fullest].pop()
                if not by_free[fullest]:
                    free ^= 1 << fullest
                n_open -= 1
            space, sequence = size, n_made
            n_made += 1
            n_open += 1
        sequences.append(sequence)
        offsets.append(size - space)
        rest = space - length
        if rest:
            by_free[rest].append(sequence)
            free |= 1 << rest
        else:
            n_open -= 1
    return sequences, offsets


def pack(pieces: DataFrame, packers: int, size: int = SEQUENCE_TOKENS,
         open_sequences: int = OPEN_SEQUENCES) -> DataFrame:
    """``pieces`` (no longer than ``size`` each) with their sequence_id and offset; other columns are kept."""
    columns = [*pieces.columns, "sequence_id", "offset"]

    def run(group: pa.Table) -> pa.Table:
        packer = group.column("packer")[0].as_py()
        sequences, offsets = best_fit(group.column("length").to_pylist(), size, open_sequences)
        ids = np.array(sequences, dtype=np.int64) + (packer << 32)
        return (group.drop_columns(["packer"]).append_column("sequence_id", pa.array(ids, pa.int64()))
                .append_column("offset", pa.array(offsets, pa.int64())).select(columns))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    # By row number: repeated rows are spread like any others.
    dealt = pieces.withColumn("packer", bucket_of(packers, F.monotonically_increasing_id()))
    return (dealt.repartition(tasks_for(pieces.sparkSession, packers), "packer").groupBy("packer")
            .applyInArrow(run, schema + ", sequence_id long, offset long"))


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, size: int = SEQUENCE_TOKENS,
                   open_sequences: int = OPEN_SEQUENCES, keep_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack: one row per piece with its place."""
    path = tokenizer_path or public_tokenizers.path(DEFAULT_TOKENIZER)
    pieces = tokenised_pieces(docs, path, size, keep_ids=keep_ids)
    packers = buckets_for(text_bytes(docs), BYTES_PER_PACKER)
    return pack(pieces, packers, size, open_sequences)
