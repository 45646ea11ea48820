"""Secret scan: three base patterns and a pair of character Markov models.

Method: two first-order Markov models over characters, one of random strings
(the values that the base patterns find) and one of ordinary identifiers (the
other words of the text that are too short to be judged), both trained from these labelled samples over all
documents.  Random pairs lean on an even share, ordinary ones half on it and half
on the second character's own share; the ordinary model expects words in capitals and runs of any one
character, and a pair of digits is no evidence (numbers are ordinary).  A long token whose log-likelihood ratio favours
the random model, per pair and in sum, is added as a span of kind ``markov``; spans of the base
patterns always stay.

Training counts character pairs on every task and adds them up: at most
2 x 65 x 65 numbers per task reach the shuffle and the driver.

Defined results: a null or empty text has no spans; offsets are code points,
end exclusive; nothing is found twice: an added span never overlaps a base
one; repeated rows are scanned each for itself; an empty table gives no rows,
and with no labelled sample of either class the models add nothing.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspark.llm.common import id_and_text, tidy

# The base patterns and the characters of a token.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_"
KINDS = ("assign", "access", "hex", "markov")
# Equivalent to the pattern followed by a length check: a maximal run is found whole or not at all.
LONG_HEX = re.compile(r"[0-9a-f]{24,}")

TOKEN_CHARS = 16  # an added span is a token at least this long
MIN_RATIO = 0.5  # mean log-likelihood ratio per character pair
MIN_TOTAL = 11.0  # its sum over the token: a short token needs stronger evidence
BACK_OFF = (20.0, 300.0)  # counts' worth of belief in what ordinary and random pairs lean on
RUN_SHARE = 0.05  # share of ordinary pairs that repeat a character, whichever it is
CAPITALS = 0.02  # an ordinary word is written in capitals so often
MOST_PER_PAIR = 3.0  # one pair says no more than this, either way
SAMPLE_CHARS = 8  # words shorter than this say little about identifiers

TOKEN = re.compile(r"[A-Za-z0-9+/_]+(?:[-=.][A-Za-z0-9+/_]+)*=*")
WORD = re.compile(r"(?<![A-Za-z0-9+/_])[A-Za-z0-9+/_]{%d,%d}(?![A-Za-z0-9+/_])" % (SAMPLE_CHARS, TOKEN_CHARS - 1))
LONG_WORD = re.compile(r"[A-Za-z0-9+/_=.-]{%d,}" % TOKEN_CHARS)

_N = len(ALPHABET)
_CODE = np.full(128, -1, dtype=np.int64)
_CODE[[ord(c) for c in ALPHABET]] = np.arange(_N)


def base_spans(text: str) -> list[tuple[int, int, int, int, int]]:
    """(start, kind, end, value start, value end) of the base patterns, by start and kind."""
    found = []
    if any(h in text.lower() for h in ASSIGN_HINTS):
        found += [(m.start(), 0, m.end(), m.start(2), m.end(2)) for m in ASSIGN.finditer(text)
                  if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end(), *m.span()) for m in LONG_HEX.finditer(text)]
    return sorted(found)


def pair_codes(token: str) -> np.ndarray:
    """Codes of the successive character pairs of the token (characters outside the alphabet are left out)."""
    codes = _CODE[np.frombuffer(token.encode("ascii", "ignore"), dtype=np.uint8)]
    codes = codes[codes >= 0]
    return codes[:-1] * _N + codes[1:]


def pair_counts(docs: DataFrame) -> DataFrame:
    """(random boolean, pair int, n long): character pairs of base values and of ordinary words, all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, _N * _N), dtype=np.int64)
        for batch in batches:
            for text in batch.column(1).to_pylist():
                spans = base_spans(text)
                taken = [(s, e) for s, _, e, _, _ in spans]
                for value in {text[a:b] for _, _, _, a, b in spans}:
                    counts[1] += np.bincount(pair_codes(value), minlength=_N * _N)
                at, words = 0, []
                for s, e in taken:
                    if s > at:
                        words += WORD.findall(text, at, s)
                    at = max(at, e)
                words += WORD.findall(text, at)
                counts[0] += np.bincount(pair_codes_joined(words), minlength=_N * _N)
        label, pair = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(label == 1), pa.array(pair, pa.int32()),
                                          pa.array(counts[label, pair])], ["random", "pair", "n"])

    found = id_and_text(docs).mapInArrow(tidy(run), "random boolean, pair int, n long")
    return found.groupBy("random", "pair").agg(F.sum("n").alias("n"))


def pair_codes_joined(words: list[str]) -> np.ndarray:
    """Pairs of many words at once; a pair across two words is left out."""
    codes = _CODE[np.frombuffer(" ".join(words).encode("ascii", "ignore"), dtype=np.uint8)]
    both = (codes[:-1] >= 0) & (codes[1:] >= 0)
    return (codes[:-1] * _N + codes[1:])[both]


def train(docs: DataFrame) -> np.ndarray | None:
    """Log-likelihood ratio (random over ordinary) of each character pair, or None without samples of a class."""
    counts = np.zeros((2, _N, _N))
    for r in pair_counts(docs).collect():  # at most 2 x 65 x 65 rows
        counts[int(r["random"]), r["pair"] // _N, r["pair"] % _N] = r["n"]
    if not counts.sum(axis=(1, 2)).all():
        return None
    upper, lower, digits = (slice(a, b) for a, b in ((0, 26), (26, 52), (52, 62)))
    counts[0][upper, upper] += CAPITALS * counts[0][lower, lower]
    single = counts[0].sum(axis=0) + 0.5
    even = np.full(_N, 1 / _N)
    pairs = counts + np.stack([BACK_OFF[0] * (even + single / single.sum()) / 2, BACK_OFF[1] * even])[:, None, :]
    p = pairs / pairs.sum(axis=2, keepdims=True)
    ordinary = (1 - RUN_SHARE) * p[0] + RUN_SHARE * np.eye(_N)
    ratio = np.clip(np.log(p[1] / ordinary), -MOST_PER_PAIR, MOST_PER_PAIR)
    ratio[digits, digits] = np.minimum(ratio[digits, digits], 0)
    return ratio.ravel()


def added_spans(text: str, base: list[tuple[int, int, int, int, int]], ratio: np.ndarray | None,
                min_ratio: float) -> list[tuple[int, int, int]]:
    """Long tokens outside the base spans whose characters follow the random model."""
    if ratio is None:
        return []
    out = []
    for run in LONG_WORD.finditer(text):
        for m in TOKEN.finditer(text, *run.span()):
            if m.end() - m.start() < TOKEN_CHARS or any(s < m.end() and m.start() < e for s, _, e, _, _ in base):
                continue
            evidence = ratio[pair_codes(m.group())]
            if len(evidence) and evidence.mean() >= min_ratio and evidence.sum() >= MIN_TOTAL:
                out.append((m.start(), 3, m.end()))
    return out


def joined(spans: list[tuple]) -> str:
    return ",".join(f"{KINDS[s[1]]}:{s[0]}:{s[2]}" for s in spans)


def scan(docs: DataFrame, min_ratio: float = MIN_RATIO) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans, found array<struct<kind,start,end>>)."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs))  # 65 x 65 numbers
    schema = ("doc_id long, n_assign long, n_access long, n_hex long, n_markov long, base_sha256 string, spans string, "
              "found array<struct<kind:string,start:long,end:long>>")
    found_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    fields = pa.schema([("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()),
                        ("spans", pa.string()), ("found", found_type)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                base = base_spans(text)
                spans = every_span(text, base, model.value, min_ratio)
                kinds = [s[1] for s in spans]
                row = {"doc_id": doc_id, "base_sha256": hashlib.sha256(joined(base).encode()).hexdigest(),
                       "spans": joined(spans),
                       "found": [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans]}
                rows.append(row | {f"n_{name}": kinds.count(k) for k, name in enumerate(KINDS)})
            yield pa.RecordBatch.from_pylist(rows, fields)

    return id_and_text(docs).mapInArrow(tidy(run), schema)


def every_span(text: str, base: list[tuple[int, int, int, int, int]], ratio: np.ndarray | None,
               min_ratio: float) -> list[tuple[int, int, int]]:
    return sorted([s[:3] for s in base] + added_spans(text, base, ratio, min_ratio))


def without(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    """The text with each span replaced by ``mark`` (overlapping spans once)."""
    parts, at = [], 0
    for start, _, end in spans:
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redacted(docs: DataFrame, min_ratio: float = MIN_RATIO, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` (all columns) with every secret in ``text`` replaced; ``n_chars``, if there, counts the new text."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs))
    at = docs.columns.index("text")
    counted = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, before = [], batch.column(at).to_pylist()
            for text in before:
                spans = text and every_span(text, base_spans(text), model.value, min_ratio)
                texts.append(without(text, spans, mark) if spans else text)
            columns = list(batch.columns)
            if counted is not None:
                sizes = [None if t is None else len(t) for t in texts]
                same = [a == b for a, b in zip(texts, before)]
                old = columns[counted].to_pylist()
                columns[counted] = pa.array([o if s else n for o, n, s in zip(old, sizes, same)], columns[counted].type)
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(tidy(run), docs.schema)
