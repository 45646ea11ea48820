import zlib
from array import array

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tabspark.llm import packing, tokencount
from tests.llm.fixtures import documents, empty, rows


@pytest.mark.parametrize("hot_words", [0, 50, 200_000])
def test_counts_are_the_tokenizers(spark, hot_words):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for doc_id, text in rows():
        n = len(t.encode(text or "", add_special_tokens=False).ids)
        want.append((doc_id, len((text or "").encode()), n, n > 2048))
    got = [tuple(r) for r in tokencount.token_counts(documents(spark), hot_words=hot_words).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_long_frequent_words(spark, monkeypatch):
    """Words beyond the dictionary's size are known by their digest; none of them is left for the shuffle."""
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    url = "https://example.org/" + "a-very-long-path/" * 9
    data = [(i, f"{url} {url} word{i} {url}é") for i in range(90)]
    got = {r["doc_id"]: r["n_tokens"] for r in tokencount.token_counts(documents(spark, data)).collect()}
    assert got == {i: len(t.encode(x, add_special_tokens=False).ids) for i, x in data}
    words = [url.encode(), b"short", url.encode() + b"x"]
    frame = spark.createDataFrame([(bytearray(w), 10, k) for k, w in enumerate(words)], "word binary, n long, pieces long")
    keys = {bytes(r["key"]): r["pieces"] for r in tokencount.frequent(frame, 100).collect()}
    assert keys == {tokencount.hot_key(w): k for k, w in enumerate(words)}


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("aB'.,!? \n\ṯ̀ \x1c<|>"))))
def test_pre_tokens_add_up(text):
    t = tokencount.tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    n = sum(len(t.encode(w.decode(), add_special_tokens=False).ids) for w in tokencount.pre_tokens(text))
    assert n == len(t.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(max_codepoint=0x17F)))
def test_fast_ids_are_the_tokenizers(text):
    bpe = packing.byte_bpe(public_tokenizers.path("byte_bpe_50k.json"))
    assert bpe.ids(text) == bpe.slow.encode(text, add_special_tokens=False).ids


def test_repeated_rows_are_dealt_over_packers(spark, monkeypatch):
    monkeypatch.setattr(packing, "BYTES_PER_PACKER", 1000)
    data = [(7, "one text that a third of all rows hold")] * 200 + [(i, f"another text {i}") for i in range(400)]
    got = packing.pack_documents(documents(spark, data)).collect()
    packers = {r["sequence_id"] >> 32 for r in got if r["doc_id"] == 7}
    assert len(got) == 600 and len(packers) > 5


def test_packing_round_trip(spark):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted([(i, [*t.encode(x or "", add_special_tokens=False).ids, 2]) for i, x in rows()], key=repr)
    got = packing.pack_documents(documents(spark), keep_ids=True).collect()
    # The pieces of equal doc_ids are told apart by their order in one sequence of pieces.
    pieces = {}
    for r in got:
        assert zlib.crc32(array("I", r["ids"]).tobytes()) == r["ids_crc32"] and r["length"] == len(r["ids"]) <= 1024
        pieces.setdefault((r["doc_id"], r["piece"], r["start"]), []).append(r["ids"])
    for doc_id, ids in want:
        for k, (start, length) in enumerate(packing.cut(len(ids), 1024)):
            pieces[(doc_id, k, start)].remove(ids[start:start + length])
    assert not any(pieces.values())
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(by_sequence) <= sum(len(ids) for _, ids in want) / 1024 + 2


def test_best_fit_closes_the_fullest():
    # Two open sequences: 6 and 7 of 10 taken; 8 fits in neither, so the one with 7 closes.
    assert packing.best_fit([6, 7, 8, 3, 2, 4], 10, 2) == ([0, 1, 2, 0, 2, 3], [0, 0, 0, 6, 8, 0])


def test_empty_tables(spark):
    assert tokencount.token_counts(empty(spark)).count() == 0
    assert packing.pack_documents(empty(spark)).count() == 0
