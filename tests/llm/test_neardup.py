import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tabspark.llm import neardup
from tabspark.llm.components import components
from tests.llm.fixtures import documents, empty, prose, rows, words


def shingle_counts(text, k=5):
    own = words(text)
    if len(own) < k:
        return Counter([tuple(own)] if own else [])
    return Counter(tuple(own[i:i + k]) for i in range(len(own) - k + 1))


def jaccard(x, y):
    keys = set(x) | set(y)
    return sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in keys) for i in keys if x[i] and y[i])


def brute(data, similarity=0.8):
    sets = [shingle_counts(t) for _, t in data]
    parent = list(range(len(data)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(data)):
        for b in range(a):
            if (data[a][1] or "") == (data[b][1] or "") or (set(sets[a]) & set(sets[b]) and jaccard(sets[a], sets[b]) >= similarity):
                parent[root(a)] = root(b)
    groups = {}
    for i, (doc_id, _) in enumerate(data):
        groups.setdefault(root(i), []).append(str(doc_id))
    return sorted(sorted(g) for g in groups.values())


def test_classes_match_brute_force(spark):
    data = rows()
    got = neardup.near_duplicates(documents(spark, data)).collect()
    groups = {}
    for r in got:
        groups.setdefault(r["class_id"], []).append(str(r["doc_id"]))
        assert r["class_id"] <= r["copy_id"]
    assert sorted(sorted(g) for g in groups.values()) == brute(data)


def test_keep_one(spark):
    data = rows()
    docs = documents(spark, data)
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids) - {None}) + ids.count(None)
    assert set(range(1, 40)) <= set(ids) and sum(i is not None and 100 <= i < 300 for i in ids) == 1
    assert len([i for i in ids if i in (300, 301, 302)]) == 2  # null and empty are equal, blanks are another text


def test_copies_linked_by_their_neighbours_only(spark, monkeypatch):
    """Copies of an absent text with one word changed: only those changed at nearby places are similar."""
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 5)
    monkeypatch.setattr(neardup, "OUTSIDE_ROWS", 3)
    rng = random.Random(11)
    data = []
    for g in range(3):
        base = prose(rng, 60, 9000).split()
        for k, at in enumerate(rng.sample(range(60), 34)):
            own = list(base)
            own[at] = f"other{g}x{k}"
            data.append((1000 * g + k, " ".join(own)))
    data += [(5000 + i, prose(rng, 50, 9000)) for i in range(30)]
    groups = {}
    for r in neardup.near_duplicates(documents(spark, data)).collect():
        groups.setdefault(r["class_id"], []).append(str(r["doc_id"]))
    assert sorted(sorted(g) for g in groups.values()) == brute(data)
    assert max(map(len, groups.values())) > 5


def test_other_texts_of_an_id_stay(spark):
    rng = random.Random(8)
    a, b, c = (prose(rng, 50, 4000) for _ in range(3))
    data = [(1, a), (1, b), (1, a), (2, c), (3, c), (4, b + " end"), (None, None)] + [(9, prose(rng, 30, 4000)) for _ in range(20)]
    frame = documents(spark, data).withColumnsRenamed({"lang": "gone", "chunk": "again", "h": "shared"})
    frame = frame.withColumnsRenamed({"node": "Node", "key": "n"})
    kept = neardup.keep_one(frame)
    assert kept.columns == frame.columns
    texts = sorted((r["text"] or "") for r in kept.collect())
    assert len(texts) == len(set(texts)) == 24 and a in texts and c in texts
    assert (b in texts) + (b + " end" in texts) == 1  # near copies of each other, under different ids


def test_exact_similarity():
    rng = np.random.default_rng(0)
    for _ in range(50):
        x, y = (Counter({int(k): int(w) for k, w in zip(rng.choice(30, 12, replace=False), rng.integers(1, 4, 12))})
                for _ in range(2))
        pack = lambda c: (np.array(sorted(c), "<u4"), np.array([c[k] for k in sorted(c)], "<u4"))
        assert neardup.probability_jaccard(*pack(x), *pack(y)) == pytest.approx(jaccard(x, y))


def test_similarities_of_many():
    rng = np.random.default_rng(1)
    sets = []
    for k in range(60):
        e = np.sort(rng.choice(40, rng.integers(1, 25), replace=False)).astype("<u4")
        sets.append((e, None if k % 3 else rng.integers(1, 4, len(e)).astype("<u4")))
    sets[5] = (sets[5][0], np.full(len(sets[5][0]), 200, "<u4"))
    sets[9] = (sets[9][0], rng.integers(1, 90, len(sets[9][0])).astype("<u4"))
    many = neardup.Many(sets)
    which = np.array([k for k in range(60) if k % 7])
    counts = [Counter(dict(zip(e.tolist(), [1] * len(e) if w is None else w.tolist()))) for e, w in sets]
    for one in (0, 1, 2, 3, 5, 9, 30):
        expected = [jaccard(counts[one], counts[k]) for k in which]
        assert many.similarities(sets[one], which) == pytest.approx(expected)
        assert [neardup.similarity_of(sets[one], sets[k]) for k in which] == pytest.approx(expected)


def block(texts, components):
    """One bucket of members that all ask, as a table of ``outside_block_links``."""
    n = len(texts)
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in data])])
    found = neardup.shingles(np.frombuffer(b"".join(data), np.uint8), offsets)
    registers = neardup.signatures(*found, n, neardup.BANDS * neardup.ROWS)
    elements = [(found[1][found[0] == d] >> np.uint64(neardup.ELEMENT_BITS - 32)).astype("<u4").tobytes() for d in range(n)]
    weights = [found[2][found[0] == d].astype("<u4").tobytes() for d in range(n)]
    rows = [{"bucket": 0, "u": d, "c": c, "outside": True, "asks": asks, "i": 0, "j": 0, "elements": elements[d], "weights": weights[d],
             "bands": [0] * neardup.BANDS, "registers": neardup.fingerprints(registers)[d].tobytes()}
            for asks in (True, False) for d, c in enumerate(components)]
    return pa.Table.from_pylist(rows)


def changed(rng, base, n, count):
    """``count`` copies of ``base`` with ``n`` words changed in each."""
    out = []
    for k in range(count):
        own = base.split()
        for at in rng.sample(range(5, len(own) - 5), n):
            own[at] = f"other{k}x{at}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("passage", ["", " " + "this is said again and again" * 30])
def test_many_copies_that_are_not_near_enough(monkeypatch, passage):
    """Pairs of a hot bucket below the limit are ruled out a block at a time, not by one comparison each."""
    rng = random.Random(4)
    texts = [t + passage for t in changed(rng, prose(rng, 200, 9000), 3, 120)]  # most pairs: a similarity of 0.7 to 0.8
    seen, one = [], neardup.similarity_of
    monkeypatch.setattr(neardup, "similarity_of", lambda a, b: seen.append(1) or one(a, b))
    table = block(texts, range(120))
    found = neardup.outside_block_links(table, 0.8).to_pylist()
    assert len(seen) < 240  # there are 7140 pairs
    sets = [neardup.merged(r["elements"], r["weights"]) for r in table.to_pylist()[:120]]
    own = {i: i for i in range(120)}
    every = dict(own)
    near = [(b, a) for a in range(120) for b in range(a) if one(sets[a], sets[b]) >= 0.8]
    for links, parts in ((near, every), ([(r["v"], r["u"]) for r in found], own)):
        for v, u in links:
            old, new = max(parts[u], parts[v]), min(parts[u], parts[v])
            parts.update({k: new for k in parts if parts[k] == old})
    assert own == every


def test_one_link_between_two_components():
    rng = random.Random(6)
    texts = changed(rng, prose(rng, 200, 9000), 1, 40)
    found = neardup.outside_block_links(block(texts, [0, 1000] * 20), 0.8).to_pylist()
    assert [(r["u"], r["v"]) for r in found] == [(1000, 0)] and found[0]["similarity"] >= 0.8


def test_registers_estimate_similarity():
    """The share of equal registers is the probability Jaccard similarity, for weighted sets too."""
    x, y = {i: 1 + i % 3 for i in range(60)}, {i: 1 + i % 2 for i in range(20, 90)}
    m = 20_000
    element = np.array([*x, *y], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(16)
    found = neardup.signatures(np.repeat([0, 1], [len(x), len(y)]), element, np.array([*x.values(), *y.values()]), 2, m)
    assert (found[0] == found[1]).mean() == pytest.approx(jaccard(Counter(x), Counter(y)), abs=0.012)


def test_empty_table(spark):
    assert neardup.near_duplicates(empty(spark)).count() == 0
    assert neardup.keep_one(empty(spark)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 30)] + [(100, 90), (90, 95), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {i: 1 for i in range(1, 31)} | {90: 90, 95: 90, 100: 90}
    rng = random.Random(2)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    links += links[:50] + [(7000, i) for i in range(6900, 6990)]  # links that come twice, a hub
    least = {n: n for link in links if link[0] != link[1] for n in link}
    for _ in least:
        for u, v in links:
            if u != v:
                least[u] = least[v] = min(least[u], least[v])
    got = components(spark.createDataFrame(links, "u long, v long").repartition(7)).collect()
    assert len(got) == len(least) and {r["node"]: r["component"] for r in got} == least
