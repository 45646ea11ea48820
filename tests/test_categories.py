"""T4 category index and the size-checked paths of the column statistics."""

from tabspark.operators import categories as CT
from tabspark.operators import scale as SC


def test_index_categories_broadcast_and_shuffle_paths(spark, monkeypatch):
    rows = [(i, "a" if i % 2 else ("b" if i % 3 else "c")) for i in range(60)] + [(100, None)]
    df = spark.createDataFrame(rows, "id int, seg string")
    idx = {r.seg: (r["count"], r["index"]) for r in CT.category_index(df, "seg").collect()}
    assert idx == {"a": (30, 0), "b": (20, 1), "c": (10, 2)}
    outs = []
    for bound in (CT.BROADCAST_MAX_CATEGORIES, 0):
        monkeypatch.setattr(CT, "BROADCAST_MAX_CATEGORIES", bound)
        outs.append(sorted((r.id, r.seg_index) for r in CT.index_categories(df, "seg").collect()))
    assert outs[0] == outs[1] and (100, None) in outs[0] and len(outs[0]) == 61


def test_scaling_stats_wide_and_long_paths(spark, monkeypatch):
    df = spark.createDataFrame([(float(i), float(i % 7), None) for i in range(50)], "a double, b double, c double")
    wide = {r.column_name: tuple(r)[1:] for r in SC.scaling_stats(df, ["a", "b", "c"]).collect()}
    monkeypatch.setattr(SC, "WIDE_MAX_COLUMNS", 0)
    long = {r.column_name: tuple(r)[1:] for r in SC.scaling_stats(df, ["a", "b", "c"]).collect()}
    assert wide.keys() == long.keys()
    for c in wide:
        for x, y in zip(wide[c], long[c]):
            assert (x is None and y is None) or abs(x - y) < 1e-9, c
