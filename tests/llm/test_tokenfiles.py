import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from tabspark.llm import tokenfiles
from tests.llm.fixtures import documents, empty, rows


def whole(text):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [*t.encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def data():
    out = rows() + [(400 + i, "a third of all rows") for i in range(5)] + [(77, "hot copy of one document")] * 60
    return out + [(500, "don't stop: x.y,z! A1b2 #tag &amp; … é ́alone ﬁ ΑΣ. İ <|endoftext|>x ' s 've"), (501, "a\x00b\x1cc d e")]


def test_documents_read_back(spark):
    own = data()
    got = tokenfiles.token_files(documents(spark, own), length=64, batch_sequences=3)
    found = sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got.collect()), key=lambda r: r[1])
    assert sorted((r[0], *r[2:]) for r in found if r[0] is not None) == sorted(
        (i, len(whole(t)), crc(whole(t))) for i, t in own if i is not None)
    assert sorted(r[2:] for r in found if r[0] is None) == sorted((len(whole(t)), crc(whole(t))) for i, t in own if i is None)
    at = 0
    for _, start, n, _ in found:  # gapless, in ascending doc_id order
        assert start == at
        at += n
    ids = [r[0] for r in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def test_random_access_is_a_view(spark):
    own = data()
    folder = tokenfiles.write_tokens(documents(spark, own), length=50, batch_sequences=4)
    files = tokenfiles.manifest(spark, folder).collect()
    assert len(files) > 2 and sum(r["n_docs"] for r in files) == len(own)
    reader, stream = tokenfiles.TokenFiles(files), []
    for i in range(len(reader)):
        ids, mask = reader[i]
        assert ids.shape == (50,) and len(mask) == 50 and ids.dtype == np.uint16 and not ids.flags.owndata
        mask = mask.to_numpy(zero_copy_only=False)
        assert not ids[mask == 0].any() and (np.diff(mask.astype(int)) <= 0).all()
        stream += ids[mask == 1].tolist()
    assert len(stream) == sum(len(whole(t)) for _, t in own)
    for r in files:
        assert reader[r["first_sequence"]][0].tolist()[:5] == stream[r["first_token"]:r["first_token"] + 5]
    try:
        reader[len(reader)]
        raise AssertionError("a sequence after the last one")
    except IndexError:
        pass


def test_memo_is_bounded_and_slices_agree(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [t or "" for _, t in data()]
    want = [whole(t) for t in texts]

    def split(words):
        flat, sizes = zip(*words.texts(pa.array(texts), 1))
        return [x.tolist() for x in np.split(np.concatenate(flat), np.cumsum(np.concatenate(sizes))[:-1])]

    assert split(tokenfiles.WordIds(path)) == want
    monkeypatch.setattr(tokenfiles, "SLICE_BYTES", 300)
    small = tokenfiles.WordIds(path, most=20)
    assert split(small) == want


def test_hostile_texts_as_the_library_encodes_them():
    path, rng = public_tokenizers.path("word_bpe_49k.json"), random.Random(2)
    pieces = ["a", "B", "s", "'", ".", ",", "!", " ", "\t", "\n", "\x1c", "\x85", "\u00a0", "\u0301", "é", "İ", "Σ", "1", "<|", "|>",
              "<|endoftext|>", "東", "😀", "\x00", "\x0b", "ﬁ", "_", "'re"]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(12))) for _ in range(4000)]
    flat, sizes = tokenfiles.WordIds(path).slice_ids(pa.array(texts), 1)
    t = Tokenizer.from_file(path)
    want = [[*e.ids, 1] for e in t.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])] == want


def test_empty_table_and_given_folder(spark, tmp_path):
    assert tokenfiles.token_files(empty(spark)).count() == 0
    folder = tokenfiles.write_tokens(documents(spark, [(2, None), (1, "x")]), folder=f"file://{tmp_path}/own")
    assert [tuple(r)[:3] for r in tokenfiles.read_documents(spark, folder).orderBy("start").collect()] == [(1, 0, 2), (2, 2, 1)]
    assert len(tokenfiles.TokenFiles([])) == 0
