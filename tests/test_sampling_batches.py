import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tabspark.operators import batches as B
from tabspark.operators import ranking as R
from tabspark.operators import sampling as S

ORDERS = "/root/testdata/sf0.01/orders.parquet"


def _int_hash(seed, *keys, tag=0):
    """Plain-Python version of the integer key hash."""
    p = 4294967291
    h = (seed + tag * 2654435761) % p
    for k in keys:
        h = ((h * 1000000007) % p + ((k % p) * 805306457) % p) % p
    for shift, mult in ((16, 0x21F0AAAD), (15, 0x735A2D97)):
        h = ((h ^ (h >> shift)) * mult) & 0xFFFFFFFF
    return h


def test_int_hash_matches_python(spark):
    from tabspark.functions import h32
    df = spark.createDataFrame([(i * 7919 - 5000, i) for i in range(200)], "a bigint, b int")
    got = [r[0] for r in df.select(h32(["a", "b"], 11, df, 3)).collect()]
    assert got == [_int_hash(11, a, b, tag=3) for a, b in ((i * 7919 - 5000, i) for i in range(200))]


def _within(k, n, p):
    return abs(k - n * p) <= 4 * (n * p * (1 - p)) ** 0.5


def test_samples_are_not_a_lattice_and_seeds_are_independent(spark):
    ids = spark.range(100_000).toDF("id")
    samples = [np.array(sorted(r[0] for r in S.hash_sample(ids, ["id"], 0.1, seed).collect())) for seed in (0, 1, 2, 3)]
    for own in samples:
        assert _within(len(own), 100_000, 0.1)
        gaps, counts = np.unique(np.diff(own), return_counts=True)
        assert len(gaps) > 40 and _within(counts[0], len(own) - 1, 0.1)
    for i in range(4):
        for j in range(i):
            assert _within(len(np.intersect1d(samples[i], samples[j])), len(samples[i]), 0.1)


def test_sample_split_strata_and_batches_are_independent(spark):
    ids = spark.range(100_000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    sample = S.hash_sample(ids, ["id"], 0.1, 3)
    train, val = S.train_val_split(sample, 0.2, 3, ["id"])
    n = sample.count()
    assert train.count() + val.count() == n and _within(val.count(), n, 0.2)
    balanced = S.stratified_sample(ids, "y", ["id"], seed=3)
    _, val = S.train_val_split(balanced, 0.2, 3, ["id"])
    for r in val.groupBy("y").count().collect():
        assert _within(r["count"], 10_000, 0.2)


def test_hash_split_partitions_input_independent_of_layout(spark):
    o = spark.read.parquet(ORDERS).select("o_orderkey")
    a, b = S.hash_split(o, ["o_orderkey"], (0.8, 0.2), seed=3)
    ka = {r[0] for r in a.collect()}
    kb = {r[0] for r in b.collect()}
    assert not ka & kb and len(ka) + len(kb) == o.count()
    a2, _ = S.hash_split(o.repartition(7), ["o_orderkey"], (0.8, 0.2), seed=3)
    assert {r[0] for r in a2.collect()} == ka
    assert 0.75 < len(ka) / (len(ka) + len(kb)) < 0.85


def test_hash_sample_deterministic(spark):
    o = spark.read.parquet(ORDERS).select("o_orderkey")
    s1 = {r[0] for r in S.hash_sample(o, ["o_orderkey"], 0.1, 1).collect()}
    s2 = {r[0] for r in S.hash_sample(o.repartition(5), ["o_orderkey"], 0.1, 1).collect()}
    assert s1 == s2 and 0.07 < len(s1) / 15000 < 0.13


def test_head_rows_ordered(spark):
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(50)], "id int, v double")
    top = [r["id"] for r in S.head_rows(df, 3, [F.col("v").desc(), "id"]).collect()]
    assert top == [6, 13, 20]


def test_global_rank_matches_sort_and_handles_hot_key(spark):
    # A third of the rows share one key: the rank still equals the sorted
    # position and the hot key is spread over several range partitions.
    rows = [(i, 7 if i % 3 == 0 else i) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, k int")
    ranked = R.global_rank(df, [F.col("k"), F.col("id")], "r", partitions=8)
    got = ranked.orderBy("r").select("id", "k", "r").toPandas()
    exp = pd.DataFrame(rows, columns=["id", "k"]).sort_values(["k", "id"]).reset_index(drop=True)
    assert list(got["r"]) == list(range(3000))
    assert list(got["id"]) == list(exp["id"])
    hot_parts = (ranked.where(F.col("k") == 7).select(F.spark_partition_id().alias("p")).distinct().count())
    assert hot_parts > 1


def test_equal_batches_cover_every_row_once(spark):
    o = spark.read.parquet(ORDERS).select("o_orderkey")
    b = B.assign_batches(o, 256, ["o_orderkey"], seed=5)
    pdf = b.toPandas()
    assert len(pdf) == 15000 and pdf["o_orderkey"].is_unique
    sizes = pdf.groupby("batch_id").size()
    assert len(sizes) == 15000 // 256 and sizes.max() - sizes.min() <= 1
    # same assignment under another layout
    b2 = B.assign_batches(o.repartition(3), 256, ["o_orderkey"], seed=5).toPandas()
    m = pdf.merge(b2, on="o_orderkey")
    assert (m["batch_id_x"] == m["batch_id_y"]).all() and (m["batch_pos_x"] == m["batch_pos_y"]).all()


def test_fixed_batches_and_tiny_input(spark):
    df = spark.createDataFrame([(i,) for i in range(1000)], "id int")
    sizes = B.assign_batches(df, 300, ["id"], mode="fixed").groupBy("batch_id").count().toPandas()
    assert sorted(sizes["count"]) == [100, 300, 300, 300]
    tiny = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    out = B.assign_batches(tiny, 256, ["id"]).toPandas()
    assert list(out["batch_id"]) == [0, 0, 0] and sorted(out["batch_pos"]) == [0, 1, 2]
    assert B.batch_count(3, 256) == 1


def test_stratified_sample_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    n = 4000
    pdf = pd.DataFrame({"id": np.arange(n), "y": (rng.random(n) < 0.15).astype(int), "v": rng.random(n)})
    df = spark.createDataFrame(pdf)
    got = S.stratified_sample(df, "y", ["id"], seed=9).toPandas()
    counts = got.groupby("y").size()
    assert counts[0] == counts[1] == (pdf["y"] == 1).sum()
    # brute force: hash order within class
    pdf["h"] = [_int_hash(9, i, tag=3) for i in pdf["id"]]
    m = int((pdf["y"] == 1).sum())
    exp = pdf.sort_values(["y", "h", "id", "v"]).groupby("y").head(m)
    assert set(got["id"]) == set(exp["id"])


def test_stratified_sample_shuffle_path_small_classes_and_null(spark, monkeypatch):
    rng = np.random.default_rng(3)
    n = 3000
    y = rng.integers(0, 4, n).astype(object)
    y[:300] = None         # a null class of 300 rows (more than the sample size)
    y[300:305] = 9         # a class smaller than the sample size
    pdf = pd.DataFrame({"id": np.arange(n), "y": y, "v": rng.random(n)})
    df = spark.createDataFrame(pdf, "id long, y int, v double")
    k = 100
    pdf["h"] = [_int_hash(9, i, tag=3) for i in pdf["id"]]
    exp = pdf.sort_values(["h", "id", "v"]).groupby("y", dropna=False).head(k)
    for max_classes, window_rows in ((S.BROADCAST_MAX_CLASSES, S.WINDOW_MAX_ROWS), (0, S.WINDOW_MAX_ROWS), (0, 0)):
        monkeypatch.setattr(S, "BROADCAST_MAX_CLASSES", max_classes)
        monkeypatch.setattr(S, "WINDOW_MAX_ROWS", window_rows)  # 0: boundary buckets ranked by global_rank
        got = S.stratified_sample(df, "y", ["id"], n_per_class=k, seed=9).toPandas()
        assert sorted(got["id"]) == sorted(exp["id"]), (max_classes, window_rows)
        assert int(got["y"].isna().sum()) == k and int((got["y"] == 9).sum()) == 5
    assert S.stratified_sample(df, "y", ["id"], n_per_class=0, seed=9).count() == 0


def test_global_rank_with_types_parquet_cannot_store(spark):
    df = spark.range(50).selectExpr("id", "NULL AS nothing", "make_dt_interval(0, 0, 0, id) AS span")
    ranked = R.global_rank(df, [F.col("id").desc()], "r", partitions=3).toPandas()
    assert sorted(zip(ranked["id"], ranked["r"])) == [(i, 49 - i) for i in range(50)]


def test_hash_split_keeps_rows_with_null_keys(spark):
    rows = [(i if i % 7 else None, i) for i in range(200)]
    for schema in ("k long, v long", "k string, v long"):
        df = spark.createDataFrame([(None if k is None else (k if "long" in schema.split(",")[0] else str(k)), v)
                                    for k, v in rows], schema)
        sides = S.hash_split(df, ["k"], (0.7, 0.3), seed=4)
        got = sorted(v for side in sides for v in (r["v"] for r in side.collect()))
        assert got == list(range(200)), schema
    out = B.assign_batches(spark.createDataFrame(rows, "k long, v long"), 16, ["k"], seed=1).toPandas()
    assert sorted(out["v"]) == list(range(200)) and out["batch_id"].notna().all()


def test_string_key_hash_split_and_batches(spark):
    df = spark.createDataFrame([(f"doc-{i}", i) for i in range(1000)], "k string, v int")
    a, b = S.hash_split(df, ["k"], (0.8, 0.2), seed=3)
    na, nb = a.count(), b.count()
    assert na + nb == 1000 and 700 < na < 900
    assert sorted(r.v for r in a.union(b).collect()) == list(range(1000))
    again = sorted(r.v for r in S.hash_split(df.repartition(5), ["k"], (0.8, 0.2), seed=3)[1].collect())
    assert again == sorted(r.v for r in b.collect())
    out = B.assign_batches(df, 64, ["k"], seed=3).toPandas()
    sizes = out.groupby("batch_id").size()
    assert sorted(out["v"]) == list(range(1000)) and len(sizes) == 1000 // 64 and sizes.max() - sizes.min() <= 1


def test_stratified_sample_is_one_filter_or_adds_equal_rows(spark):
    """Rows that share keys are told apart by a filter; equal rows that straddle the limit are counted."""
    rows = [(1, k % 2, k) for k in range(60)] + [(2, 1, 7)] * 9
    df = spark.createDataFrame(rows, "k long, y int, v long")
    got = S.stratified_sample(df, "y", ["k"], n_per_class=10, seed=1)
    own = pd.DataFrame(rows, columns=["k", "y", "v"])
    own["h"] = [_int_hash(1, i, tag=3) for i in own["k"]]
    exp = own.sort_values(["y", "h", "k", "v"]).groupby("y").head(10)
    assert sorted(map(tuple, got.collect())) == sorted(exp[["k", "y", "v"]].itertuples(index=False, name=None))
    distinct = spark.createDataFrame(rows[:60], "k long, y int, v long")
    got = S.stratified_sample(distinct, "y", ["k"], n_per_class=10, seed=1)
    assert "Union" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r["v"] for r in got.collect()) == list(range(20))


def test_hash_ranks_in_groups_and_with_a_hot_value(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(int(g), int(i), float(i % 7)) for i, g in enumerate(rng.integers(0, 3, 2000))] + [(1, -5, 0.5)] * 900
    df = spark.createDataFrame(rows, "g int, id long, v double")
    for hot in (R.HOT_ROWS, 100):  # 100: the value of id -5 is hot, ranges instead of buckets
        monkeypatch.setattr(R, "HOT_ROWS", hot)
        out, counts = B.assign_batches_counted(df, 64, ["id"], seed=3, within=["g"])
        got = out.toPandas()
        assert len(got) == len(rows)
        for g in range(3):
            own = got[got["g"] == g]
            alone = B.assign_batches(df.where(F.col("g") == g), 64, ["id"], seed=3).toPandas()
            assert counts[(g,)] == max(1, len(own) // 64) == own["batch_id"].nunique()
            key = ["id", "batch_id", "batch_pos"]
            mine, other = (x[x["id"] >= 0][key].sort_values(key).to_numpy() for x in (own, alone))
            assert (mine == other).all()
            sizes = own.groupby("batch_id").size()
            assert sizes.max() - sizes.min() <= 1
            assert not own.duplicated(["batch_id", "batch_pos"]).any()
