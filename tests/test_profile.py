import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tabspark.operators import profile as P

LINEITEM = "/root/testdata/sf0.01/lineitem.parquet"


def test_histogram_equals_numpy(spark):
    li = spark.read.parquet(LINEITEM)
    h = P.histogram(li, ["l_extendedprice"], bins=10).orderBy("bin").toPandas()
    values = li.select("l_extendedprice").toPandas()["l_extendedprice"].to_numpy()
    counts, edges = np.histogram(values, bins=10)
    assert list(h["count"]) == list(counts)
    assert np.allclose(h["lower"], edges[:-1])


def test_histogram_zero_fill_and_constant(spark):
    df = spark.createDataFrame([(0.0, 5.0), (10.0, 5.0), (10.0, 5.0)], "x double, c double")
    h = P.histogram(df, ["x", "c"], bins=5).toPandas()
    hx = h[h.column_name == "x"].sort_values("bin")
    assert list(hx["count"]) == [1, 0, 0, 0, 2]
    assert h[h.column_name == "c"]["count"].sum() == 3


def test_correlation_with_nulls_and_constant(spark):
    df = spark.createDataFrame([(1.0, 2.0, None, 3.0), (2.0, 4.1, 1.0, 3.0), (3.0, 6.3, 2.0, 3.0),
                                (4.0, 7.9, 2.5, 3.0)], "a double, b double, c double, k double")
    pdf = df.toPandas()
    fast = {(r.col_a, r.col_b): r.corr for r in P.correlation_matrix(df, ["a", "b"]).collect()}
    assert abs(fast[("a", "b")] - pdf["a"].corr(pdf["b"])) < 1e-12
    slow = {(r.col_a, r.col_b): r.corr for r in P.correlation_matrix(df, ["a", "c"]).collect()}
    assert abs(slow[("c", "a")] - pdf["a"].corr(pdf["c"])) < 1e-12
    const = {(r.col_a, r.col_b): r.corr for r in P.correlation_matrix(df, ["a", "k"]).collect()}
    assert const[("a", "k")] is None


def test_null_profile_and_fill(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 4.0, None), (3, float("nan"), "y")], "id int, a double, s string")
    prof = {r.column_name: (r.nulls, r.rows) for r in P.null_profile(df).collect()}
    assert prof == {"id": (0, 3), "a": (2, 3), "s": (1, 3)}
    filled = P.fill_nulls(df.where(~F.isnan("a") | F.col("a").isNull()), {"s": "?"}, numeric="mean").orderBy("id").collect()
    assert [r.a for r in filled] == [4.0, 4.0] and [r.s for r in filled] == ["x", "?"]
    assert P.drop_nulls(df, ["s"]).count() == 2


def test_class_weights_six_to_one(spark):
    df = spark.createDataFrame([(0.0,)] * 60 + [(1.0,)] * 10, "Churn double")
    w = P.collect_class_weights(P.class_weights(df, "Churn"), "Churn")
    assert w == {0.0: 1.0, 1.0: 6.0}
    bal = {r.Churn: round(r.share, 4) for r in P.class_balance(df, "Churn").collect()}
    assert bal == {0.0: round(60 / 70, 4), 1.0: round(10 / 70, 4)}


def test_describe_includes_strings_not_booleans(spark):
    df = spark.createDataFrame([(1, "b", True), (3, "a", False)], "count int, schema string, flag boolean")
    d = P.describe_table(df).toPandas()
    assert set(d.column_name) == {"count", "schema"}
    assert d[(d.column_name == "schema") & (d.statistic == "min")]["text"].iloc[0] == "a"
    assert d[(d.column_name == "count") & (d.statistic == "mean")]["value"].iloc[0] == 2.0


def test_size_estimate(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "ñ")], "id bigint, s string")
    r = P.size_estimate(df).first()
    assert (r.rows, r.bytes) == (2, 2 * 8 + 2 + 2)


def test_summary_quartiles_are_data_values(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)], "x double")
    s = {r.statistic: r.value for r in P.summary_table(df).collect()}
    assert (s["25%"], s["50%"], s["75%"]) == (25.0, 50.0, 75.0)
    assert s["count"] == 100 and s["min"] == 1 and s["max"] == 100


def test_exact_quantiles_brute_force(spark):
    from tabspark.operators.quantiles import exact_quantiles
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 5000), "v": np.round(rng.lognormal(size=5000), 3)})
    pdf.loc[pdf.index[:1700], "v"] = 7.0  # a hot value
    pdf.loc[pdf.index[1700:1710], "v"] = np.nan
    df = spark.createDataFrame(pdf)
    got = {(r.g, r.prob): r.quantile for r in exact_quantiles(df, ["g"], "v", [0.0, 0.1, 0.25, 0.5, 0.9, 1.0],
                                                              bins=16, final_rows=50).collect()}
    for g, part in pdf.groupby("g"):
        vals = np.sort(part["v"].dropna().to_numpy())  # pandas NaN arrives in Spark as null
        for p in [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]:
            k = max(1, int(np.ceil(round(p * len(vals), 9))))
            assert got[(g, p)] == vals[k - 1], (g, p)


def test_exact_quantiles_nan_sorts_last(spark):
    from tabspark.operators.quantiles import exact_quantiles
    rows = [(0, float(i)) for i in range(1, 9)] + [(0, float("nan"))] * 2 + [(0, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r.prob: r.quantile for r in exact_quantiles(df, ["g"], "v", [0.5, 0.8, 0.9, 1.0]).collect()}
    assert got[0.5] == 5.0 and got[0.8] == 8.0
    assert np.isnan(got[0.9]) and np.isnan(got[1.0])


def test_summary_wide_and_long_paths_agree(spark, monkeypatch):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(400):
        b = float(rng.normal()) if i % 7 else (float("nan") if i % 2 else None)
        rows.append((int(rng.integers(-5, 50)), b, None, 3.0))
    df = spark.createDataFrame(rows, "a int, b double, c double, d double")

    def table(frame):
        return {(r.column_name, r.statistic): r.value for r in P.summary_table(frame).collect()}

    wide = table(df)
    monkeypatch.setattr(P, "WIDE_MAX_COLUMNS", 0)
    long = table(df)
    assert set(wide) == set(long) and len(wide) == 4 * len(P.SUMMARY_STATS)
    for k, v in wide.items():
        w = long[k]
        assert (v is None and w is None) or (np.isnan(v) and np.isnan(w)) or np.isclose(v, w, rtol=1e-12), k
    a = np.sort([r[0] for r in rows])
    assert wide[("a", "50%")] == a[int(np.ceil(0.5 * len(a))) - 1]
    assert wide[("c", "count")] == 0 and wide[("c", "min")] is None
    assert wide[("d", "25%")] == 3.0
    assert P.summary_table(df.limit(0)).count() == 0


def test_quantiles_of_many_groups_are_ranked(spark, monkeypatch):
    from tabspark.operators import quantiles as Q
    rng = np.random.default_rng(3)
    rows = [(None if i % 17 == 0 else i % 50, None if i % 13 == 0 else float("nan") if i % 31 == 0 else float(v))
            for i, v in enumerate(rng.integers(0, 40, 3000))]
    df = spark.createDataFrame(rows, "g int, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]

    def both():
        q = {(r.g, r.prob): r.quantile for r in Q.exact_quantiles(df, ["g"], "v", probs).collect()}
        lp = {r.label: (r.rows, round(r["mean"], 9), r.q25, r.q50, r.q75)
              for r in P.label_profile(df.withColumnRenamed("g", "label"), "label", ["v"]).collect()}
        return {k: "nan" if np.isnan(v) else v for k, v in q.items()}, lp

    searched = both()
    monkeypatch.setattr(Q, "MAX_GROUPS", 10)
    assert both() == searched and len(searched[0]) == 51 * len(probs)


def test_a_hundred_thousand_and_one_groups(spark):
    from tabspark.operators import quantiles as Q
    df = spark.range(300_006).selectExpr("id % 100002 AS label", "CAST(id AS DOUBLE) AS v")
    got = P.label_profile(df, "label", ["v"]).where("label IN (0, 77777)").orderBy("label").collect()
    assert 100_002 > Q.MAX_GROUPS
    scaled = [[(k + j * 100_002) / 300_005 for j in range(3)] for k in (0, 77777)]
    assert [(r["rows"], r.q25, r.q50, r.q75) for r in got] == [(3, *s) for s in scaled]


def test_summary_with_strings(spark):
    rows = [(1, "b", 2.0, True), (2, None, float("nan"), False), (3, "12", None, True), (4, "a", 4.0, True), (5, "7", 6.0, None)]
    df = spark.createDataFrame(rows, "i int, `s t` string, x double, flag boolean")
    out = P.summary_table(df, strings=True)
    assert out.columns == ["column_name", "statistic", "value", "text"]
    got = {(r.column_name, r.statistic): (r.value, r.text) for r in out.collect()}
    assert len(got) == 3 * len(P.SUMMARY_STATS)
    assert got[("s t", "count")] == (4.0, None) and got[("s t", "min")] == (None, "12") and got[("s t", "max")] == (None, "b")
    assert got[("s t", "mean")] == (9.5, None) and got[("s t", "50%")] == (7.0, None)
    assert got[("x", "count")] == (3.0, None) and got[("x", "mean")] == (4.0, None) and got[("x", "max")] == (6.0, None)
    assert got[("x", "75%")] == (6.0, None) and got[("i", "25%")] == (2.0, None)
    only = P.summary_table(df.select("s t").where("i > 3 AND i < 5"), strings=True).collect()
    assert {r.statistic: (r.value, r.text) for r in only}["50%"] == (None, None)


def test_nan_is_missing_everywhere(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, "a"), (3.0, "a"), (nan, "a"), (None, "a")], "x double, k string")
    s = {r.statistic: r.value for r in P.summary_table(df).collect()}
    d = {r.statistic: r.value for r in P.describe_table(df, ["x"]).collect()}
    for stat, value in (("count", 2.0), ("mean", 2.0), ("min", 1.0), ("max", 3.0)):
        assert s[stat] == d[stat] == value
    assert s["stddev"] == d["stddev"] and (s["25%"], s["50%"], s["75%"]) == (1.0, 1.0, 3.0)
    lp = P.label_profile(df, "k", ["x"]).first()
    assert (lp["rows"], lp["mean"], lp["q25"], lp["q75"]) == (2, 0.5, 0.0, 1.0)


def test_correlation_of_two_hundred_columns_with_nulls(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 200))
    x[:, 1] = 0.7 * x[:, 0] + 0.3 * x[:, 1]
    x[:, 199] = 3.0
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 50] = np.nan
    pdf = pd.DataFrame(x, columns=[f"c {i}" for i in range(200)])
    rows = [tuple(None if np.isnan(v) and (i + j) % 2 else float(v) for j, v in enumerate(r)) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in pdf.columns)).repartition(3)
    out = P.correlation_matrix(df)
    assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.col_a, r.col_b): r.corr for r in out.collect()}
    exp = pdf.corr()
    assert len(got) == 40_000
    for a in pdf.columns:
        for b in pdf.columns:
            e = exp.loc[a, b]
            if np.isnan(e) or "c 199" in (a, b):
                assert got[a, b] is None, (a, b)
            else:
                assert abs(got[a, b] - e) < 1e-9, (a, b)


def test_class_tables_read_the_source_once(spark):
    df = spark.createDataFrame([(float(i % 7 == 0),) for i in range(70)], "y double")
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    counted = df.mapInArrow(seen, df.schema)
    for make in (P.class_balance, P.class_weights):
        before = reads.value
        assert len(make(counted, "y").collect()) == 2
        assert reads.value - before == 70


def test_histogram_skips_null_and_nan(spark):
    from tabspark.operators import scale as SC
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,), (2.0,)], "x double")
    for stats in (None, SC.scaling_stats(df, ["x"])):  # given stats have max NaN
        h = {r.bin: (r.lower, r.upper, r["count"]) for r in P.histogram(df, ["x"], bins=2, stats=stats).collect()}
        assert h == {0: (1.0, 2.0, 1), 1: (2.0, 3.0, 2)}


def test_describe_wide_and_long_paths_agree(spark, monkeypatch):
    rows = [(i, float(i) / 3 if i % 5 else None, str(i * 7) if i % 3 else "abc", bool(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "a int, b double, s string, flag boolean")

    def table(frame):
        out = P.describe_table(frame)
        assert out.columns == ["column_name", "statistic", "value", "text"]
        return {(r.column_name, r.statistic): (r.value, r.text) for r in out.collect()}

    wide = table(df)
    monkeypatch.setattr(P, "WIDE_MAX_COLUMNS", 0)
    long = table(df)
    assert set(wide) == set(long) and len(wide) == 15
    for k, (v, t) in wide.items():
        lv, lt = long[k]
        assert t == lt and ((v is None and lv is None) or abs(v - lv) < 1e-9 * max(1.0, abs(v))), k
    assert wide[("s", "count")] == (60.0, None) and wide[("s", "min")] == (None, "112")
    monkeypatch.setattr(P, "WIDE_MAX_COLUMNS", 16)
    assert P.describe_table(df.limit(0)).count() == 0


def test_exact_quantiles_null_group(spark):
    from tabspark.operators.quantiles import exact_quantiles
    rows = [(None, float(i)) for i in range(1, 11)] + [(1, float(i)) for i in range(20, 25)]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {(r.g, r.prob): r.quantile for r in exact_quantiles(df, ["g"], "v", [0.5, 1.0]).collect()}
    assert got == {(None, 0.5): 5.0, (None, 1.0): 10.0, (1, 0.5): 22.0, (1, 1.0): 24.0}
    lp = {r.label: r.q50 for r in P.label_profile(df.withColumnRenamed("g", "label"), "label", ["v"]).collect()}
    assert lp[None] is not None and lp[1] is not None


def test_class_weights_with_null_label(spark):
    df = spark.createDataFrame([(0.0,)] * 60 + [(1.0,)] * 10 + [(None,)] * 5, "Churn double")
    assert P.collect_class_weights(P.class_weights(df, "Churn"), "Churn") == {0.0: 1.0, 1.0: 6.0}
    assert P.class_balance(df, "Churn").count() == 3


def test_correlation_mixed_null_and_complete_columns(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"a": rng.normal(size=300), "b": rng.normal(size=300), "k": 5.0})
    pdf["c"] = pdf["a"] * 0.5 + rng.normal(size=300)
    pdf.loc[pdf.index[::9], "c"] = np.nan
    df = spark.createDataFrame(pdf[["a", "b", "c", "k"]]).selectExpr("a", "b", "nanvl(c, NULL) AS c", "k")
    got = {(r.col_a, r.col_b): r.corr for r in P.correlation_matrix(df, ["a", "b", "c", "k"]).collect()}
    exp = pdf[["a", "b", "c"]].corr()
    for u in "abc":
        for v in "abc":
            assert abs(got[(u, v)] - exp.loc[u, v]) < 1e-9, (u, v)
        assert got[(u, "k")] is None and got[("k", u)] is None
    assert len(got) == 16


def test_quartiles_of_any_distribution(spark):
    """Exact or raising, never null: infinite values, many orders of magnitude, hot values."""
    import numpy as np

    from tabspark.operators import quantiles as Q
    from tabspark.operators.profile import summary_table

    rng = np.random.default_rng(0)
    n = 30_000
    wide = 10.0 ** rng.uniform(-300, 300, n) * rng.choice([-1.0, 1.0], n)
    one_inf = rng.standard_normal(n)
    one_inf[0] = np.inf
    many_inf = np.where(rng.random(n) < 0.3, -np.inf, rng.standard_normal(n))
    hot = np.where(rng.random(n) < 0.4, 1e-300, wide)
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(wide, one_inf, many_inf, hot)],
                               "wide double, one_inf double, many_inf double, hot double")
    old, Q.FINAL_ROWS = Q.FINAL_ROWS, 200
    defaults = Q.column_quantiles.__defaults__
    Q.column_quantiles.__defaults__ = tuple(200 if v == old else v for v in defaults)
    try:
        got = {(r["column_name"], r["statistic"]): r["value"] for r in summary_table(df).collect()}
    finally:
        Q.FINAL_ROWS = old
        Q.column_quantiles.__defaults__ = defaults
    for name, values in (("wide", wide), ("one_inf", one_inf), ("many_inf", many_inf), ("hot", hot)):
        order = np.sort(values)
        for stat, p in (("25%", 0.25), ("50%", 0.5), ("75%", 0.75)):
            assert got[(name, stat)] == order[int(np.ceil(n * p)) - 1], (name, stat)


def test_nan_and_infinity_rules(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(nan, 1, nan), (None, None, 1.0), (3.0, 2, 2.0), (1.0, 2, inf)], "a double, b int, c double")
    from tabspark.operators.profile import correlation_matrix, fill_nulls, histogram
    from tabspark.operators.scale import collect_stats, scaling_stats

    st = collect_stats(scaling_stats(df, ["a", "b"]))
    assert (st["a"].count, st["a"].mean, st["a"].min, st["a"].max) == (2.0, 2.0, 1.0, 3.0)
    filled = [tuple(r) for r in fill_nulls(df, numeric="mean").collect()]
    assert filled == [(2.0, 1, 1.5), (2.0, 2, 1.0), (3.0, 2, 2.0), (1.0, 2, inf)]
    bins = {(r["column_name"], r["bin"]): r["count"] for r in histogram(df, ["c"], bins=2).collect()}
    assert bins == {("c", 0): 1, ("c", 1): 1}
    pairs = {(r["col_a"], r["col_b"]): r["corr"] for r in correlation_matrix(df.select("a", "b")).collect()}
    assert pairs[("a", "a")] == 1.0


def test_same_shape_at_16_and_17_columns_of_an_empty_table(spark):
    from tabspark.operators.profile import parallel_coordinates
    from tabspark.operators.scale import scaling_stats, standardize

    for n in (16, 17):
        cols = [f"c{i}" for i in range(n)]
        df = spark.createDataFrame([], ", ".join(f"{c} double" for c in cols) + ", y int")
        assert sorted(tuple(r) for r in scaling_stats(df, cols).collect()) == sorted((c, 0.0, None, None, None, None) for c in cols)
        assert parallel_coordinates(df, "y").count() == 0
        assert standardize(df, scaling_stats(df, cols)).columns == df.columns
