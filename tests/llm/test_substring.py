import hashlib

import pytest

from tabspark.llm import substring
from tests.llm.fixtures import documents, empty, rows, words


def brute(data, tie, window=20):
    """The definition, one document after the other."""
    seen, out = set(), []
    for doc_id, text in sorted(data, key=lambda r: (r[0] is None, r[0] or 0, tie[r[1] or ""])):
        own = words(text)
        gone = [False] * len(own)
        for p in range(len(own) - window + 1):
            key = tuple(own[p:p + window])
            if key in seen:
                gone[p:p + window] = [True] * window
            seen.add(key)
        kept = " ".join(w for w, g in zip(own, gone) if not g)
        out.append((doc_id, len(own), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk_bytes", [1 << 12, 1 << 24])
def test_matches_definition(spark, monkeypatch, chunk_bytes):
    monkeypatch.setattr(substring, "CHUNK_BYTES", chunk_bytes)
    monkeypatch.setattr(substring, "PART_BYTES", chunk_bytes)
    docs = documents(spark)
    tie = {r["t"]: r["h"] for r in docs.selectExpr("coalesce(text, '') t", "xxhash64(coalesce(text, '')) h").collect()}
    got = substring.remove_repeats(docs, keep_text=True).collect()
    assert sorted([(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got], key=repr) == brute(rows(), tie)
    for r in got:
        assert hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"]
        assert sum(s["end"] - s["start"] for s in r["removed"]) == r["n_removed"]
        assert all(a["end"] < b["start"] for a, b in zip(r["removed"], r["removed"][1:]))


def test_empty_table(spark):
    assert substring.remove_repeats(empty(spark)).count() == 0


def test_delta_codes():
    import numpy as np

    hashes = np.array([5, 6, 5 + (1 << 31), (1 << 40) + 3, (1 << 47) + 1], dtype=np.uint64)
    flags = np.array([0, 1, 2, 3, 0], dtype=np.uint64)
    back = substring.decode(substring.encode(hashes, flags, 2), 2)
    assert (back[0] == hashes).all() and (back[1] == flags).all()
