"""Quality scores from supervised subword embeddings.

Method: every word and every character n-gram of a text hashes to a learned
vector; a document is the mean of its vectors, and a softmax layer over that
mean gives its class.  Vectors and layer are trained together by stochastic
gradient descent in numpy, on a bounded sample of labelled documents
(``MAX_TRAIN_ROWS``, the labels with the smallest hash of their doc_id).  The model has
``BUCKETS`` x ``DIM`` numbers whatever the corpus; scoring is one pass over all
whole texts with no shuffle.

An n-gram lies within a word and may take in the separator before or after it.
Since the mean is linear, scoring needs only each bucket's share of the logit.

Defined results: an empty or null text has no features and gets the score of
the bias alone; a null doc_id is never held out and has no label; a document
labelled both ways counts as label 0; rows with a null label teach nothing; with no
labels, or labels of one class, every score is that class's smoothed share;
repeated rows score alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabspark.llm.common import id_and_text, tidy
from tabspark.llm.wordhash import IS_WORD, Words, mix, slices, utf8

BUCKETS = 1 << 16
DIM = 8
GRAMS = (3, 4)
MAX_TRAIN_ROWS = 3000
EPOCHS = 8
RATE = 1.0
SEED = 7
SLICE_BYTES = 1 << 19  # of text whose features are held at once, at some 120 bytes each
THRESHOLD = 0.7
HELD_OUT = 2  # remainder of crc32(doc_id) mod 4 that is never learnt from


def feature_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of every word and n-gram; a text's own order is lost, its counts are not."""
    words = Words(data, offsets)
    buckets = [(words.hashes() >> np.uint64(48)).astype(np.int64) % BUCKETS]
    owners = [words.doc]
    inside = IS_WORD[data]
    symbols = np.where(inside, data, 0).astype(np.uint64) + np.uint64(1)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for n in GRAMS:
        if len(data) < n:
            continue
        m = len(data) - n + 1
        valid = owner[:m] == owner[n - 1:]
        code = symbols[:m].copy()
        for j in range(1, n):
            if j < n - 1:
                valid &= inside[j:m + j]
            code = (code << np.uint64(8)) + symbols[j:m + j]
        at = np.flatnonzero(valid)
        buckets.append((mix(code[at] + np.uint64(n << 40)) >> np.uint64(48)).astype(np.int64) % BUCKETS)
        owners.append(owner[at])
    return np.concatenate(buckets), np.concatenate(owners)


def bags(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, label) as (doc_id, label, bucket array<int>, n array<int>): for training rows only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            found = []
            for i in range(len(offsets) - 1):
                bucket, _ = feature_buckets(data[offsets[i]:offsets[i + 1]], np.array([0, offsets[i + 1] - offsets[i]]))
                found.append(np.unique(bucket, return_counts=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([b for b, _ in found], pa.list_(pa.int32())),
                 pa.array([n for _, n in found], pa.list_(pa.int32()))], ["doc_id", "label", "bucket", "n"])

    return docs.mapInArrow(tidy(run), "doc_id long, label int, bucket array<int>, n array<int>")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == HELD_OUT, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled documents outside the held-out quarter, with their texts."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
             .where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("label").alias("label")))
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return id_and_text(docs).join(F.broadcast(some), "doc_id").select("doc_id", "text", "label")


class Model:
    """Bucket vectors and a softmax layer over their mean."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
        self.layer = np.zeros((DIM, 2))
        self.bias = np.zeros(2)

    def fit(self, examples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, rate: float = RATE,
            seed: int = SEED) -> Model:
        """One document a step, in a new random order each epoch, the rate falling to zero."""
        counts = np.bincount([y for _, _, y in examples], minlength=2)[:2] if examples else np.zeros(2)
        self.bias = np.log((counts + 1) / (counts.sum() + 2))
        if not counts.all():
            return self
        rng = np.random.default_rng(seed)
        steps, done = epochs * len(examples), 0
        for _ in range(epochs):
            for i in rng.permutation(len(examples)):
                bucket, n, y = examples[i]
                step = rate * (1 - done / steps)
                done += 1
                if not len(bucket):
                    continue
                share = (n / n.sum())[:, None]
                own = self.vectors[bucket]
                mean = (own * share).sum(axis=0)
                z = mean @ self.layer + self.bias
                p = np.exp(z - z.max())
                slope = p / p.sum()
                slope[y] -= 1
                self.vectors[bucket] = own - step * np.sqrt(len(bucket)) * share * (self.layer @ slope)
                self.layer -= step * np.outer(mean, slope)
        return self

    def shares(self) -> tuple[np.ndarray, float]:
        """Each bucket's share of the logit of class 1 against class 0, and the logit without features."""
        return self.vectors @ (self.layer[:, 1] - self.layer[:, 0]), float(self.bias[1] - self.bias[0])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = MAX_TRAIN_ROWS) -> Model:
    """Fit on the bounded sample; its features (at most rows x BUCKETS counts) reach the driver."""
    found = bags(training_rows(docs, labels, label, rows)).toArrow()
    order = np.argsort(found.column("doc_id").to_numpy(), kind="stable")
    bucket, n = found.column("bucket").combine_chunks(), found.column("n").combine_chunks()
    label_of = found.column("label").to_numpy()
    return Model().fit([(bucket[int(i)].values.to_numpy(), n[int(i)].values.to_numpy(), int(label_of[i] > 0))
                        for i in order])


def text_scores(texts: pa.Array, shares: np.ndarray, bias: float) -> np.ndarray:
    """Probability of class 1 of each text (no nulls)."""
    data, offsets = utf8(texts)
    total, number = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1)
    for i, j in slices(offsets, SLICE_BYTES):
        bucket, owner = feature_buckets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        total[i:j] = np.bincount(owner, shares[bucket], j - i)
        number[i:j] = np.bincount(owner, minlength=j - i)
    return 1 / (1 + np.exp(-np.clip(bias + total / np.maximum(number, 1), -700, 700)))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model.shares())  # BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = text_scores(batch.column(1), *shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["doc_id", "score"])

    return id_and_text(docs).mapInArrow(tidy(run), "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    out = scored(docs, train(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all columns) whose text scores ``threshold`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels).shares())
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = text_scores(pc.fill_null(batch.column(at), ""), *shared.value)
            yield batch.filter(pa.array(score >= threshold))

    return docs.mapInArrow(tidy(run), docs.schema)
