"""Sharding, nearest neighbours, quality scores and licences."""

import random
import time
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tabspark.llm import forest, licences, quality, sharding
from tabspark.llm.licence_texts import MORE_TEXTS, TEXTS
from tests.llm.fixtures import documents, empty, rows


def test_shards(spark):
    got = sharding.shard_documents(documents(spark), shards=6).collect()
    assert sorted([(r["doc_id"], r["size"], r["text_crc32"]) for r in got], key=repr) == sorted(
        [(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows()], key=repr)
    sizes = {}
    for k in range(6):
        own = [r for r in got if r["shard"] == k]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        sizes[k] = sum(r["size"] for r in own)
    biggest = max(r["size"] for r in got)
    assert sum(sizes.values()) == sum(r["size"] for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * biggest


def test_a_hot_text_is_split_by_doc_id(spark):
    data = [(i, "the same text everywhere " * 4) for i in range(300)] + [(1000 + i, f"another {i} " * 9) for i in range(600)]
    data += [(5000, "repeated row")] * 5 + [(None, None)] * 3
    got = sharding.shard_documents(documents(spark, data), shards=8).collect()
    sizes = [sum(r["size"] for r in got if r["shard"] == k) for k in range(8)]
    assert max(sizes) <= 1.03 * sum(sizes) / 8
    assert len({r["shard"] for r in got if r["doc_id"] == 5000}) == 1


def test_shards_of_an_empty_table_and_one_row(spark):
    assert sharding.shard_documents(empty(spark)).count() == 0
    assert [r["slot"] for r in sharding.shard_documents(documents(spark, [(1, "x")])).collect()] == [0]


def test_write_shards(spark, tmp_dir):
    docs = documents(spark)
    assert sharding.write_shards(docs, f"{tmp_dir}/out", shards=3) == "shard"
    got = spark.read.parquet(f"{tmp_dir}/out")
    assert sorted(got.columns) == sorted([*docs.columns, "shard"])
    assert sorted(map(repr, got.select(docs.columns).collect())) == sorted(map(repr, docs.collect()))  # h stays the caller's
    named = docs.withColumnsRenamed({"lang": "Shard", "chunk": "d", "key": "H_"})
    assert sharding.write_shards(named, f"{tmp_dir}/named", shards=3) == "shard_"
    got = spark.read.parquet(f"{tmp_dir}/named")
    assert {(r["Shard"], r["d"], r["H_"], r["h"]) for r in got.collect()} == {("en", "c", 9, "h")}
    assert 1 < got.select("shard_").distinct().count() <= 3


def test_default_shards_against_a_plain_sort(spark):
    """24 shards of the test documents: contiguous in key order, every boundary as near as asked to its target."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    keys = sorted((r["h"], r["d"], r["size"], r["doc_id"]) for r in sharding.keyed(docs).collect())
    got = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard_documents(docs).collect()}
    placed = [got[k[3]] for k in keys]
    assert placed == sorted(placed) and len(got) == len(keys)
    total, below, last, slot = sum(k[2] for k in keys), {}, 0, 0
    size = 0
    for (shard, own_slot), k in zip(placed, keys):
        slot = slot + 1 if shard == last else 0
        assert own_slot == slot or (shard, own_slot) == (0, 0) and size == 0
        if size == 0:
            slot = 0
        for s in range(last + 1, shard + 1):
            below[s] = size
        last, size = shard, size + k[2]
    biggest = max(k[2] for k in keys)
    assert sorted(below) == list(range(1, 24))
    for s, b in below.items():
        assert abs(b - total * s / 24) <= max(sharding.TOLERANCE * total / 24, biggest)


def vectors(spark, n=3000, dim=16, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)).astype("f4")
    x[100:400] = x[100]  # a hot vector
    x[500:520] *= 5
    data = [(i, [float(v) for v in x[i]]) for i in range(n)]
    data += [(n + 20, None), (n + 40, [0.0] * dim), (n + 60, [float("nan")] * dim), (n + 80, [None] + [1.0] * (dim - 1)),
             (n + 100, [1.0] * 3), (None, [1.0] * dim), (n + 120, [float("inf")] * dim), (n + 140, []), data[0], data[20]]
    return spark.createDataFrame([(*d, 1, 2) for d in data], "vec_id long, embedding array<float>, rb int, qb int"), x


def recall_of(got, x, every=20, k=20):
    found = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    x = x.astype(float)
    hit = n = 0
    assert sorted(found) == list(range(0, len(x), every))
    for q, own in found.items():
        score = (x * x[q]).sum(axis=1)
        order = [i for i in np.lexsort((np.arange(len(x)), -score)) if i != q][:k]
        assert len(own) == k and q not in dict(own)
        assert all(s == pytest.approx(score[v], abs=1e-12) for v, s in own)
        assert own == sorted(own, key=lambda p: (-p[1], p[0]))
        hit += len({v for v, _ in own} & set(order))
        n += k
    return hit / n


def test_small_tables_are_searched_whole(spark):
    df, x = vectors(spark)
    assert recall_of(forest.nearest(df).collect(), x) == 1


def test_recall_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(forest, "BLOCK_ROWS", 1500)
    monkeypatch.setattr(forest, "BLOCK_QUERIES", 100)
    df, x = vectors(spark, 6000, 32)
    assert recall_of(forest.nearest(df, least=0).collect(), x) >= 0.9


def test_prefixes():
    rng = np.random.default_rng(0)
    strings = rng.integers(0, 1 << 16, (3, 200), dtype=np.uint64)
    q = strings[:, :5]
    f = forest.Forest(strings, 16)
    for length in (0, 3, 16):
        lo, hi = f.ranges(q, length)
        same = (strings[:, None, :] >> np.uint64(16 - length)) == (q[:, :, None] >> np.uint64(16 - length))
        assert ((hi - lo) == same.sum(axis=2)).all()
    length = f.ascend(q, 40, 16)
    lo, hi = f.ranges(q, length)
    assert ((hi - lo).sum(axis=0) >= 40).all()
    lo, hi = f.ranges(q, length + 1)
    assert ((hi - lo).sum(axis=0) < 40).all()


def test_no_vectors(spark):
    df, _ = vectors(spark)
    assert forest.nearest(df.limit(0)).count() == 0
    assert forest.nearest(df.where("vec_id = 20")).count() == 0


def labelled(spark, n=400):
    rng = random.Random(4)
    data, labels = [], []
    for i in range(10_000, 10_000 + n):
        good = rng.random() < 0.8
        pool = ["ordinary", "words", "that", "people", "write", "often"] if good else ["BUY!!", "xx$$", "click***", "now###"]
        data.append((i, " ".join(rng.choice(pool) + rng.choice(["", ",", "ing"]) for _ in range(rng.randrange(5, 60)))))
        labels.append((i, int(good), 0))
    labels += [(10_003, None, 0), (None, 1, 1), (99_999, 1, 0)]
    return documents(spark, data + rows()), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels[:n]


def test_quality(spark):
    docs, labels, known = labelled(spark)
    got = quality.quality_scores(docs, labels).collect()
    assert len(got) == 400 + len(rows())
    truth = {i: q for i, q, _ in known}
    own = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    assert len(own) > 50 and np.mean([r["predicted"] == truth[r["doc_id"]] for r in own]) >= 0.95
    assert len({r["score"] for r in got if r["doc_id"] in (300, 301, 302)}) == 1  # no features


def test_quality_without_labels(spark):
    docs, labels, _ = labelled(spark)
    assert {r["score"] for r in quality.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    one = quality.quality_scores(docs, labels.where("quality = 1")).collect()
    assert len({r["score"] for r in one}) == 1 and one[0]["score"] > 0.9
    assert quality.quality_scores(empty(spark), labels).count() == 0
    kept = quality.keep_good(docs, labels.where("quality = 1"))
    assert kept.schema == docs.schema and kept.count() == docs.count()


def test_licences(spark):
    mit = TEXTS[0][1]
    noisy = "Copyright (c) 2020 Some One\n(C) 1999 another\n" + mit.upper().replace(",", " ,").replace("\n", "\r\n  ")
    data = [(1, noisy), (2, "text\n  ** Licensed under the Apache Licence, version 2.0 **\nmore"), (3, mit + "\nno"),
            (4, "Released under the MIT License."), (5, "Released under the MIT License.\nreleased under the mit license"),
            (6, None), (7, ""), (7, ""), (None, "Licensed under CC0 1.0"), (8, "Copyright 2001 Nobody\n" * 3)]
    got = {(r["doc_id"], r["licence"], r["notices"], r["n_notices"]) for r in licences.licence_scan(documents(spark, data)).collect()}
    assert got == {(1, "MIT", "", 0), (2, None, "Apache-2.0", 1), (3, None, "", 0), (4, "MIT", "MIT", 1),
                   (5, None, "MIT", 2), (6, None, "", 0), (7, None, "", 0), (None, "CC0-1.0", "CC0-1.0", 1), (8, None, "", 0)}
    assert licences.licence_scan(empty(spark)).count() == 0


def unit_vectors(n, seed, dim=64):
    x = np.random.default_rng(seed).standard_normal((n, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def varying(n):
    return unit_vectors(n, 5) * np.exp(0.5 * np.random.default_rng(6).standard_normal(n))[:, None]


def hot_third(n):
    x = unit_vectors(n, 7)
    x[1::3] = x[1]
    return x


def query_recalls(spark, x, every, k=20, chosen=None):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {}
    for r in forest.nearest(df, every=every).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    out = []
    for q in chosen if chosen is not None else range(0, len(x), every):
        score = (x * x[q]).sum(axis=1)
        want = [i for i in np.lexsort((np.arange(len(x)), -score)) if i != q][:k]
        out.append(len(found[q] & set(want)) / k)
    return np.array(out)


@pytest.mark.parametrize("make, n", [(varying, 6000), (hot_third, 6000), (varying, 3000)])
def test_recall_at_production_values(spark, make, n):
    own = query_recalls(spark, make(n), 100)
    assert own.mean() >= 0.95 and own.min() >= 0.8


def test_neighbours_of_a_hot_vector(spark):
    x = hot_third(6000)
    near = np.argsort(-(x * x[1]).sum(axis=1), kind="stable")
    near = [int(i) for i in near if i % 3 != 1][:15]
    own = query_recalls(spark, x, 1, chosen=near)
    assert own.mean() >= 0.95 and own.min() >= 0.8


def test_the_forest_selects_at_every_size():
    """Blocks of 500 to 6,000 rows are not scored whole."""
    for n in (500, 2000, 4096, 6000):
        x = unit_vectors(n, 8)
        planes = np.random.default_rng(1).standard_normal((forest.TREES, 65, forest.BITS))
        strings = forest.hash_strings(np.column_stack([x, np.zeros(n)]), planes)
        met = [f.mean() for f in forest.Forest(strings, forest.BITS).candidates(
            strings[:, :20], forest.wanted(n, forest.share_of(n), forest.NEAREST), forest.DEPTH)]
        assert forest.share_of(n) <= min(met) and np.mean(met) < 0.97
    assert forest.share_of(2000) == forest.SHARE and forest.share_of(64_000) == pytest.approx(forest.SHARE / 2)


def test_norms_at_the_ends_of_double(spark):
    df = spark.createDataFrame([(i, [s * (i + 1), 1e-3 * s]) for i, s in enumerate([1.0, 1e-200, 1e200] * 30)],
                               "vec_id long, embedding array<double>")
    got = forest.nearest(df, every=30, k=100).collect()
    assert all(len({r["vec_id"] for r in got if r["query_id"] == q}) == 89 for q in (0, 30, 60))


def assert_as_in_sql(spark, data):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", data)
    got = [tuple(r) for r in licences.licence_scan(documents(spark, data)).collect()]
    assert sorted(got, key=repr) == sorted(con.sql(licences.SCAN_SQL).fetchall(), key=repr)


def test_titled_and_wrapped_licences(spark):
    text = dict(TEXTS[:5]) | dict(MORE_TEXTS)
    mpl = ("/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not "
           "distributed with this\n * file, You can obtain one at https://mozilla.org/MPL/2.0/. */")
    data = [(1, "MIT License\n\nCopyright (c) 2020 Some One\n" + text["MIT"]), (2, f"#!/bin/sh\n\n{mpl}\n\nint x;"),
            (3, "BSD 3-Clause License\n\nCopyright (c) 2020, A\nAll rights reserved.\n" + text["BSD-3-Clause"]),
            (4, text["Unlicense"]), (5, "a\n\n(c) 1999\nReleased under the MIT License.\n\nb"), (6, mpl)]
    got = {r["doc_id"]: (r["licence"], r["notices"], r["n_notices"]) for r in licences.licence_scan(documents(spark, data)).collect()}
    assert_as_in_sql(spark, [*data, (7, None), (8, ""), (9, f"{mpl}\n\n{mpl}\n\nReleased under the MIT License."), (None, "x")])
    assert got == {1: ("MIT", "", 0), 2: (None, "MPL-2.0", 1), 3: ("BSD-3-Clause", "", 0), 4: ("Unlicense", "Unlicense", 1),
                   5: (None, "MIT", 1), 6: ("MPL-2.0", "", 0)}


def test_one_very_long_line(spark):
    """A megabyte without a line end is scanned in time that grows with its length."""
    data = [(1, "x y " * 250_000), (2, "no end of line " * 70_000 + "\n\nReleased under the MIT License.")]
    docs = documents(spark, data)
    licences.licence_scan(documents(spark, [(1, "x")])).collect()
    start = time.time()
    got = {(r["doc_id"], r["notices"]) for r in licences.licence_scan(docs).collect()}
    assert got == {(1, ""), (2, "MIT")} and time.time() - start < 20


def test_recall_falls_no_lower_on_larger_tables(spark):
    """20,000 rows, 64 dimensions, no clusters, at production values: less than half of each block is looked at."""
    x = unit_vectors(20_000, 9)
    assert forest.share_of(20_000) < 0.5
    own = query_recalls(spark, x, 400)
    assert own.mean() >= 0.93


def plain_buckets(text):
    """Buckets of words and of n-grams of 3 and 4 bytes with their hashes written out, one at a time."""
    mask = (1 << 64) - 1

    def mixed(v):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            v = ((v ^ (v >> shift)) * factor) & mask
        return v ^ (v >> 31)

    step, data, out = 0x9E3779B97F4A7C15, text.encode(), []
    for word in data.split():
        h, power = len(word), 1
        for b in word:
            power = power * step & mask
            h = (h + mixed((b + 1) * step & mask) * power) & mask
        out.append((mixed(h) >> 48) % quality.BUCKETS)
    blanks = b"\x20\x09\x0a\x0b\x0c\x0d"
    for n in quality.GRAMS:
        for a in range(len(data) - n + 1):
            gram = data[a:a + n]
            if any(b in blanks for b in gram[1:-1]):  # a blank stands at the ends of a word only
                continue
            code = 0
            for b in gram:
                code = (code << 8) + (0 if b in blanks else b) + 1
            out.append((mixed((code + (n << 40)) & mask) >> 48) % quality.BUCKETS)
    return sorted(out)


def test_quality_features_training_and_score_one_by_one():
    """The vectorised features, the training steps and the score against plain loops."""
    rng = random.Random(3)
    texts = ["", " ", "a", "ab cd", "naïve  東京\tx", "one two two three"] + [
        " ".join("".join(rng.choice("abcé!") for _ in range(rng.randrange(1, 9))) for _ in range(12)) for _ in range(10)]
    examples = []
    for k, text in enumerate(texts):
        raw = np.frombuffer(text.encode(), np.uint8)
        bucket, owner = quality.feature_buckets(raw, np.array([0, len(raw)]))
        assert sorted(bucket.tolist()) == plain_buckets(text) and not owner.any()
        own, n = np.unique(plain_buckets(text) or np.zeros(0, int), return_counts=True)
        examples.append((own, n, k % 2))
    model = quality.Model().fit(examples, epochs=2)
    start = quality.Model()
    vectors = {b: start.vectors[b].tolist() for own, _, _ in examples for b in own.tolist()}
    layer, dim = [[0.0, 0.0] for _ in range(quality.DIM)], range(quality.DIM)
    ones = sum(y for _, _, y in examples)
    bias = [np.log((len(examples) - ones + 1) / (len(examples) + 2)), np.log((ones + 1) / (len(examples) + 2))]
    order, done = np.random.default_rng(quality.SEED), 0
    for _ in range(2):
        for i in order.permutation(len(examples)):
            own, n, y = examples[i]
            rate = quality.RATE * (1 - done / (2 * len(examples)))
            done += 1
            if not len(own):
                continue
            share = {b: k / sum(n.tolist()) for b, k in zip(own.tolist(), n.tolist())}
            mean = [sum(vectors[b][d] * s for b, s in share.items()) for d in dim]
            z = [sum(mean[d] * layer[d][c] for d in dim) + bias[c] for c in (0, 1)]
            p = [np.exp(v) / sum(np.exp(u) for u in z) for v in z]
            slope = [p[c] - (c == y) for c in (0, 1)]
            back = [sum(layer[d][c] * slope[c] for c in (0, 1)) for d in dim]
            for b, s in share.items():
                vectors[b] = [vectors[b][d] - rate * len(own) ** 0.5 * s * back[d] for d in dim]
            layer = [[layer[d][c] - rate * mean[d] * slope[c] for c in (0, 1)] for d in dim]
    assert np.allclose(model.layer, layer) and all(np.allclose(model.vectors[b], v) for b, v in vectors.items())
    got = quality.text_scores(pa.array(texts), *model.shares())
    for (own, n, _), s in zip(examples, got):
        mean = [sum(vectors[b][d] * k for b, k in zip(own.tolist(), n.tolist())) / max(1, n.sum()) for d in dim]
        z = [sum(mean[d] * layer[d][c] for d in dim) + bias[c] for c in (0, 1)]
        assert s == pytest.approx(1 / (1 + np.exp(z[0] - z[1])))
