"""Token counts of documents from the piece counts of distinct pre-tokens.

Method: texts are cut into pre-tokens, each distinct pre-token is given to the
tokenizer once for the whole corpus, and the piece counts are joined to the
documents' pre-token frequencies and summed.  No ids are kept.

A pre-token is a run of bytes without ASCII white space, cut once more between
an ASCII letter and a following ``.``, ``,``, ``;``, ``:``, ``!`` or ``?``.  The
tokenizer starts a new word at each of these places whatever stands around them, so
counts of pre-tokens add up to the count of the text.  Texts in plain ASCII are
lower-cased first, as the tokenizer does.  Everything else (NFC, other white
space, special strings inside texts) is left to the tokenizer itself.

The join has two tiers.  Pre-tokens are counted over the corpus; the
``HOT_WORDS`` most frequent ones go to the
tasks as a dictionary, those of more than ``HOT_BYTES`` bytes by their SHA-256 (so its size is bounded by
these two numbers), which also takes every hot key out of the shuffle.  All others are joined by a shuffle on the pre-token.

Defined results: a null or empty text has 0 bytes and 0 tokens; null doc_ids
and repeated rows are counted each for itself; an empty table gives no rows;
other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspark.llm.common import checkpointed, id_and_text

DEFAULT_TOKENIZER = "word_bpe_49k.json"
LIMIT_TOKENS = 2048
HOT_WORDS = 200_000
HOT_BYTES = 64

CUT = re.compile(rb"(?<=[A-Za-z])(?=[.,;:!?])")


@lru_cache(maxsize=2)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def pre_tokens(text: str) -> list[bytes]:
    raw = text.encode()
    if text.isascii() and b"<|" not in raw:  # special strings are matched before the case is folded
        raw = raw.lower()
    return CUT.sub(b" ", raw).split()


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): the distinct pre-tokens of all documents with their frequency, counted on each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[bytes] = Counter()
            for text in batch.column(0).to_pylist():
                counts.update(pre_tokens(text))
            yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()),
                                              pa.array(counts.values(), pa.int64())], ["word", "n"])

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def piece_counts(words: DataFrame, path: str) -> DataFrame:
    """``words`` (word, n) with ``pieces``: each distinct pre-token through the tokenizer once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path).encode_batch_fast
        for batch in batches:
            words = [w.decode() for w in batch.column(0).to_pylist()]
            pieces = []
            for i in range(0, len(words), 1000):
                pieces += [len(e.ids) for e in encode(words[i:i + 1000], add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pieces, pa.int64())], ["word", "n", "pieces"])

    return words.mapInArrow(run, "word binary, n long, pieces long")


def hot_key(word: bytes) -> bytes:
    """A pre-token as the dictionary knows it."""
    return word if len(word) <= HOT_BYTES else b"\0" + sha256(word).digest()


def frequent(pieces: DataFrame, most: int) -> DataFrame:
    """(key, pieces) of the most frequent pre-tokens, ``most`` at most: those above a frequency that a histogram gives."""
    grade = F.floor(F.log2("n") * 16)  # sixteen grades for each doubling
    left, least = most, None
    for row in sorted(pieces.groupBy(grade.alias("grade")).count().collect(), key=lambda r: -r["grade"]):
        left -= row["count"]
        if left < 0:
            break
        least = row["grade"]
    long = F.octet_length("word") > HOT_BYTES
    key = F.when(long, F.concat(F.lit(bytearray(1)), F.unhex(F.sha2("word", 256)))).otherwise(F.col("word"))
    chosen = pieces.where(grade >= least) if least is not None else pieces.where(F.lit(False))
    return chosen.select(key.alias("key"), "pieces")


def rare_frequencies(docs: DataFrame, hot: dict[bytes, int]) -> DataFrame:
    """Per document one row with its hot total, and one row per rare pre-token with its frequency.

    The row of the document itself has a blank and its row number as ``word``:
    no pre-token holds a blank, so it meets no partner and is spread evenly.
    """
    known = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = known.value.get
        for batch in batches:
            words, n, total, rid, size, ids = [], [], [], [], [], []
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist())
            for doc_id, text, row in rows:
                tokens, rare = 0, []
                for word in pre_tokens(text):
                    pieces = get(word if len(word) <= HOT_BYTES else hot_key(word))
                    if pieces is None:
                        rare.append(word)
                    else:
                        tokens += pieces
                counts = Counter(rare)
                k = len(counts) + 1
                words += [b" %d" % row, *counts]
                n += [0, *counts.values()]
                total += [tokens] + [0] * (k - 1)
                size += [len(text.encode())] + [0] * (k - 1)
                rid += [row] * k
                ids += [doc_id] * k
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array(rid, pa.int64()), pa.array(ids, pa.int64()),
                 pa.array(n, pa.int32()), pa.array(total, pa.int64()), pa.array(size, pa.int64())],
                ["word", "rid", "doc_id", "n", "hot", "n_bytes"])

    # The row number only tells rows apart: a retried task counts the same rows the same way.
    return docs.withColumn("rid", F.monotonically_increasing_id()).mapInArrow(
        run, "word binary, rid long, doc_id long, n int, hot long, n_bytes long")


def token_counts(docs: DataFrame, tokenizer_path: str | None = None, limit: int = LIMIT_TOKENS,
                 hot_words: int = HOT_WORDS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text."""
    path = tokenizer_path or public_tokenizers.path(DEFAULT_TOKENIZER)
    docs = id_and_text(docs)
    pieces = checkpointed(piece_counts(vocabulary(docs), path))
    found = frequent(pieces, hot_words).toArrow()
    hot = dict(zip(found.column("key").to_pylist(), found.column("pieces").to_pylist()))
    rare = rare_frequencies(docs, hot)
    tokens = F.sum(F.col("hot") + F.coalesce(F.col("n") * F.col("pieces"), F.lit(0))).cast("long")
    counted = (rare.join(pieces.select("word", "pieces"), "word", "left").groupBy("rid")
               .agg(F.max("doc_id").alias("doc_id"), F.sum("n_bytes").alias("n_bytes"), tokens.alias("n_tokens")))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
