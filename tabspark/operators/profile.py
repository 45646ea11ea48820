"""Profiling.

Every profile is computed over **all** rows with one or two aggregate jobs
whose results are bounded by the number of columns, bins or classes.  Wide
aggregates are turned into long tables with ``inline`` of an array of
structs, so any column name (spaces, dots) works.
"""

from __future__ import annotations

import math
import time
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import hash_below
from ..functions.numeric import is_numeric, present
from ..session import ensure_checkpoint_dir
from .columns import numeric_columns
from .quantiles import RANK_ACCURACY, collect_few, column_quantiles, exact_quantiles, ranked_quantiles
from .scale import WIDE_MAX_COLUMNS, ColumnStats, collect_stats, minmax, scaling_stats


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _long(wide: DataFrame, rows: list[Column]) -> DataFrame:
    """Turn a one-row aggregate into a long table, one struct per output row."""
    return wide.select(F.inline(F.array(*rows)))


def row_count(df: DataFrame) -> DataFrame:
    """Row count as a one-row DataFrame (A1)."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def timed_count(df: DataFrame) -> dict:
    """Rows and the seconds a full count took (A5's timing: cost of one pass)."""
    start = time.perf_counter()
    rows = df.count()
    return {"rows": rows, "seconds": time.perf_counter() - start}


def describe_table(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, stddev, min, max of numeric and string columns (A2).

    Long form (column_name, statistic, value, text): numbers go to ``value``,
    string minima and maxima to ``text``.  The mean and stddev of a string
    column are those of its values that parse as numbers (else null).
    Boolean and other columns are left out, as in Spark's ``describe``.  NaN is
    a missing value like null: no statistic counts it.
    Up to ``WIDE_MAX_COLUMNS`` columns use one wide aggregate; wider tables
    are unpivoted to (column_name, number, string) and grouped by column, so
    the generated code does not grow with the column count.  An empty table
    gives no rows.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    numeric = [f.name for f in fields if is_numeric(f.dataType)]
    strings = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    if not numeric and not strings:
        raise ValueError("no numeric or string columns")
    null_s = F.lit(None).cast("string")
    null_d = F.lit(None).cast("double")

    def row(stat: str, value: Column, text: Column) -> Column:
        return F.struct(F.lit(stat).alias("statistic"), value.alias("value"), text.alias("text"))

    if len(numeric) + len(strings) <= WIDE_MAX_COLUMNS:
        aggs, out = [F.count(F.lit(1)).alias("__rows")], []
        for i, c in enumerate(numeric + strings):
            is_str = i >= len(numeric)
            x = present(_q(c).try_cast("double") if is_str else _q(c).cast("double"))
            aggs += [F.count(_q(c) if is_str else x).cast("double").alias(f"n{i}"), F.avg(x).alias(f"m{i}"),
                     F.stddev_samp(x).alias(f"sd{i}"),
                     F.min(_q(c) if is_str else x).alias(f"lo{i}"), F.max(_q(c) if is_str else x).alias(f"hi{i}")]
            lo, hi = F.col(f"lo{i}"), F.col(f"hi{i}")
            stats = [row("count", F.col(f"n{i}"), null_s), row("mean", F.col(f"m{i}"), null_s),
                     row("stddev", F.col(f"sd{i}"), null_s),
                     row("min", null_d, lo) if is_str else row("min", lo, null_s),
                     row("max", null_d, hi) if is_str else row("max", hi, null_s)]
            out += [F.struct(F.lit(c).alias("column_name"), *[st[f] for f in ("statistic", "value", "text")])
                    for st in stats]
        return df.agg(*aggs).where(F.col("__rows") > 0).select(F.inline(F.array(*out)))
    cells = [F.struct(F.lit(c).alias("column_name"), F.lit(False).alias("is_str"),
                      present(_q(c).cast("double")).alias("x"), null_s.alias("s")) for c in numeric]
    cells += [F.struct(F.lit(c).alias("column_name"), F.lit(True).alias("is_str"),
                       present(_q(c).try_cast("double")).alias("x"), _q(c).alias("s")) for c in strings]
    long = df.select(F.inline(F.array(*cells)))
    agg = long.groupBy("column_name").agg(
        F.first("is_str").alias("is_str"),
        F.count_if(F.when(F.col("is_str"), F.col("s").isNotNull()).otherwise(F.col("x").isNotNull()))
        .cast("double").alias("n"),
        F.avg("x").alias("m"), F.stddev_samp("x").alias("sd"),
        F.min("x").alias("lo"), F.max("x").alias("hi"), F.min("s").alias("slo"), F.max("s").alias("shi"))
    is_str = F.col("is_str")
    return agg.select("column_name", F.inline(F.array(
        row("count", F.col("n"), null_s), row("mean", F.col("m"), null_s), row("stddev", F.col("sd"), null_s),
        row("min", F.when(is_str, null_d).otherwise(F.col("lo")), F.when(is_str, F.col("slo"))),
        row("max", F.when(is_str, null_d).otherwise(F.col("hi")), F.when(is_str, F.col("shi"))),
    )))


SUMMARY_STATS = ("count", "mean", "stddev", "min", "25%", "50%", "75%", "max")


def summary_table(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    method: str = "exact",
    accuracy: int = 1_000_000,
    strings: bool = False,
) -> DataFrame:
    """describe + quartiles per numeric column (A3), long form (column_name, statistic, value).

    ``strings=True`` adds the string columns and a column ``text`` with their least and
    greatest value, in the same pass; as in Spark's ``summary``, their mean, stddev and
    quartiles are those of the values that parse as numbers.

    Quartiles are exact by default: a sample brackets them, one pass counts the rows below and inside
    the brackets and one picks the values (``quantiles.column_quantiles``, which searches on where a
    bracket is too wide or misses);
    ``method="approx"`` uses ``percentile_approx`` alone (rank error at most n/accuracy).
    NaN is a missing value like null: no statistic counts it.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    cols = [c for c in columns if strings or is_numeric(kinds[c])] if columns is not None else numeric_columns(df)
    texts = [c for c in (columns if columns is not None else df.columns) if isinstance(kinds[c], T.StringType)] if strings else []
    cols = [c for c in cols if c not in texts]
    if not cols and not texts:
        raise ValueError("no numeric columns" + (" or string columns" if strings else ""))
    if method not in ("exact", "approx"):
        raise ValueError("method must be 'exact' or 'approx'")
    probs = [0.25, 0.5, 0.75]
    source = df
    if texts:
        source = df.select(*[_q(c) for c in cols], *[_q(c) for c in texts])
    rows = _summary_moments(source, cols, texts, probs if method == "approx" else None, accuracy)
    if method == "exact":
        numbers = source.select(*[_q(c) for c in cols], *[_q(c).try_cast("double").alias(c) for c in texts])
        stats = {(c,): (r["parsed"], r["min"], r["max"], 0) for c, r in rows.items()}
        brackets = _brackets(numbers, [c for c, r in rows.items() if r["parsed"]], probs, max((r["parsed"] for r in rows.values()), default=0))
        qs = {(r["column_name"], r["prob"]): r["quantile"]
              for r in column_quantiles(numbers, [*cols, *texts], probs, stats, brackets=brackets).collect()}
    else:
        qs = {(c, p): (r["q"][i] if r["q"] else None) for c, r in rows.items() for i, p in enumerate(probs)}
    out = []
    for c in [*cols, *texts]:
        r = rows.get(c)
        if r is None:
            continue
        is_text = c in texts
        values = {"count": float(r["count"]), "mean": r["mean"], "stddev": r["stddev"], "min": None if is_text else r["min"],
                  "25%": qs.get((c, 0.25)), "50%": qs.get((c, 0.5)), "75%": qs.get((c, 0.75)), "max": None if is_text else r["max"]}
        words = {"min": r["first"], "max": r["last"]} if is_text else {}
        out += [(c, s, None if values[s] is None else float(values[s]), words.get(s)) for s in SUMMARY_STATS]
    schema = "column_name string, statistic string, value double" + (", text string" if strings else "")
    return df.sparkSession.createDataFrame(out if strings else [r[:3] for r in out], schema)


# Rows of the sample that brackets quantiles; the brackets only say where to count, so results do not depend on it.
BRACKET_ROWS = 50_000


def _brackets(df: DataFrame, cols: list[str], probs: Sequence[float], rows: int) -> dict | None:
    """(column, p) -> two values that probably enclose the p-quantile, from about ``BRACKET_ROWS`` rows."""
    if not cols or len(cols) > WIDE_MAX_COLUMNS:
        return None
    share = min(1.0, BRACKET_ROWS / max(1, rows))
    spread = [4.0 / RANK_ACCURACY + (4.0 * math.sqrt(p * (1 - p) / BRACKET_ROWS) if share < 1.0 else 0.0) for p in probs]
    asked = [max(0.0, p - e) for p, e in zip(probs, spread)] + [min(1.0, p + e) for p, e in zip(probs, spread)]
    sample = df if share == 1.0 else df.sample(fraction=share, seed=0)
    long = sample.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), present(_q(c).cast("double")).alias("value")) for c in cols])))
    found = {r["column_name"]: r["q"] for r in long.groupBy("column_name").agg(
        F.percentile_approx("value", asked, RANK_ACCURACY).alias("q")).collect()}
    if any(not found.get(c) for c in cols):  # too few rows to say
        return None
    return {(c, p): (found[c][i], found[c][i + len(probs)]) for c in cols for i, p in enumerate(probs)}


def _summary_moments(df: DataFrame, cols: list[str], texts: list[str], probs: Sequence[float] | None, accuracy: int) -> dict[str, dict]:
    """column -> count, parsed (numbers among them), mean, stddev, min, max, first, last (texts), q (with ``probs``).

    One job.  Up to ``WIDE_MAX_COLUMNS`` columns use one wide aggregate; wider tables, and approximate
    quantiles, are unpivoted to (column_name, value, text) first, so the generated code stays
    small and each column merges on its own task.
    """
    every = [*cols, *texts]
    value = {c: present(_q(c).try_cast("double") if c in texts else _q(c).cast("double")) for c in every}
    if probs is None and len(every) <= WIDE_MAX_COLUMNS:
        aggs = [F.count(F.lit(1)).alias("__rows")]
        for i, c in enumerate(every):
            x = value[c]
            aggs += [F.count(x).alias(f"parsed{i}"), F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"stddev{i}"),
                     F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}")]
            if c in texts:
                aggs += [F.count(_q(c)).alias(f"count{i}"), F.min(_q(c)).alias(f"first{i}"), F.max(_q(c)).alias(f"last{i}")]
        r = df.agg(*aggs).first()
        if not r["__rows"]:
            return {}
        names = {c: ["parsed", "mean", "stddev", "min", "max", *(["count", "first", "last"] if c in texts else [])] for c in every}
        out = {c: {s: r[f"{s}{i}"] for s in names[c]} for i, c in enumerate(every)}
        return {c: {"count": m["parsed"], **m} for c, m in out.items()}
    no_text = F.lit(None).cast("string")
    cells = [F.struct(F.lit(c).alias("column_name"), value[c].alias("value"), (_q(c) if c in texts else no_text).alias("text")) for c in every]
    aggs = [F.count("value").alias("parsed"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("stddev"),
            F.min("value").alias("min"), F.max("value").alias("max")]
    if texts:
        aggs += [F.count("text").alias("n_texts"), F.min("text").alias("first"), F.max("text").alias("last")]
    if probs is not None:
        aggs.append(F.percentile_approx("value", list(probs), accuracy).alias("q"))
    found = df.select(F.inline(F.array(*cells))).groupBy("column_name").agg(*aggs).collect()
    return {r["column_name"]: {**r.asDict(), "count": r["n_texts"] if r["column_name"] in texts else r["parsed"]} for r in found}


def unique_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column (A4); partial distinct on every task."""
    return df.select(_q(column)).distinct()


# Bytes per value of fixed-width types (the JVM / numpy widths).
_FIXED_WIDTH = {
    T.ByteType: 1, T.BooleanType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4,
    T.FloatType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8,
    T.DecimalType: 16,
}


def _width(dtype: T.DataType) -> int | None:
    for cls, width in _FIXED_WIDTH.items():
        if isinstance(dtype, cls):
            return width
    return None


def size_estimate(df: DataFrame) -> DataFrame:
    """Rows, estimated bytes in memory and bytes per row, over all rows (A5).

    Fixed-width columns count their width per row; strings and binaries
    their UTF-8 byte length; arrays of fixed-width elements size x width.
    """
    fixed = 0
    var_parts: list[Column] = []
    for f in df.schema.fields:
        w = _width(f.dataType)
        if w is not None:
            fixed += w
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            var_parts.append(F.coalesce(F.octet_length(_q(f.name)), F.lit(0)).cast("bigint"))
        elif isinstance(f.dataType, T.ArrayType) and _width(f.dataType.elementType) is not None:
            ew = _width(f.dataType.elementType)
            var_parts.append(F.coalesce(F.size(_q(f.name)) * F.lit(ew), F.lit(0)).cast("bigint"))
        else:  # maps, structs, nested arrays: their string form as a proxy
            var_parts.append(F.coalesce(F.octet_length(F.to_json(_q(f.name))), F.lit(0)).cast("bigint"))
    var_sum = F.sum(sum(var_parts[1:], var_parts[0])) if var_parts else F.lit(0)
    agg = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(var_sum, F.lit(0)).cast("bigint").alias("var_bytes"))
    total = F.col("rows") * F.lit(fixed) + F.col("var_bytes")
    return agg.select(
        "rows",
        total.cast("bigint").alias("bytes"),
        F.when(F.col("rows") > 0, total / F.col("rows")).alias("bytes_per_row"),
    )


def _is_finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf))


def histogram(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    bins: int = 10,
    stats: Mapping[str, ColumnStats] | DataFrame | None = None,
) -> DataFrame:
    """Equal-width histogram of every numeric column over all rows.

    (column_name, bin, lower, upper, count), zero-filled.  Bin of x is
    floor((x - min) / (max - min) * bins) with the maximum folded into the
    last bin (numpy's rule).  Nulls, NaN and infinite values are left
    out, and the range is that of the finite values.  Two jobs:
    min/max, then a partial-aggregated group-by on (column, bin) that
    shuffles at most columns x bins rows per task.
    """
    cols = list(columns) if columns is not None else numeric_columns(df)
    bounds: dict[str, tuple] = {}
    if stats is not None:
        st = stats if isinstance(stats, Mapping) else collect_stats(stats)
        for c in cols:
            lo, hi = st[c].min, st[c].max
            # A NaN or infinite bound says nothing about the finite range.
            if lo is not None and hi is not None and math.isfinite(lo) and math.isfinite(hi):
                bounds[c] = (lo, hi)
    todo = [c for c in cols if c not in bounds]
    if todo:
        aggs = []
        for i, c in enumerate(todo):
            x = _q(c).cast("double")
            finite = F.when(_is_finite(x), x)
            aggs += [F.min(finite).alias(f"lo{i}"), F.max(finite).alias(f"hi{i}")]
        r = df.agg(*aggs).first()
        bounds.update({c: (r[f"lo{i}"], r[f"hi{i}"]) for i, c in enumerate(todo)})
    structs = []
    skeleton = []
    for c in cols:
        lo, hi = bounds[c]
        x = _q(c).cast("double")
        if lo is None or hi is None:
            continue
        lo, hi = float(lo), float(hi)
        if hi == lo:
            b = F.when(_is_finite(x), F.lit(0))
        else:
            # least() skips a null argument, so the guard must exclude nulls too.
            b = F.when(_is_finite(x),
                       F.least(F.floor((x - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(bins))),
                               F.lit(bins - 1)).cast("int"))
        structs.append(F.struct(F.lit(c).alias("column_name"), b.alias("bin")))
        width = (hi - lo) / bins
        skeleton += [(c, i, lo + i * width, lo + (i + 1) * width) for i in range(bins)]
    if not structs:
        # No column has a value: no edges, so no bins (numpy needs a range too).
        return df.sparkSession.createDataFrame(
            [], "column_name string, bin int, lower double, upper double, count bigint")
    counts = (df.select(F.inline(F.array(*structs)))
              .where(F.col("bin").isNotNull())
              .groupBy("column_name", "bin").agg(F.count(F.lit(1)).alias("count")))
    edges = df.sparkSession.createDataFrame(
        skeleton, "column_name string, bin int, lower double, upper double")
    # Both sides hold at most columns x bins rows.
    return (edges.join(F.broadcast(counts), ["column_name", "bin"], "left")
            .select("column_name", "bin", "lower", "upper",
                    F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count")))


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(values, present) of a batch of double columns, rows x columns; missing values are 0."""
    x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1) if batch.num_columns else np.zeros((0, 0))
    there = ~np.isnan(x)
    return np.where(there, x, 0.0), there


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of all column pairs (A8a): long form (col_a, col_b, corr).

    Both orientations and the diagonal, each over the rows in which both values are
    present (not null, not NaN).  Two passes: the column means, then Gram matrices.  A task turns its rows into
    matrices of centred values and of presence and adds up four products of them (sums of
    products, of values, of squares, and counts, for every pair at once); no row is
    unpivoted or multiplied.  The products are shuffled and added row by row of the matrix, where its
    correlations are computed.  A zero variance, or an infinite value, gives null.
    """
    cols = list(columns) if columns is not None else numeric_columns(df)
    k = len(cols)
    source = df.select(*[_q(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = np.zeros(k), np.zeros(k)
        for b in batches:
            x, there = _matrix(b)
            n, s = n + there.sum(axis=0), s + np.where(np.isfinite(x), x, 0.0).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(n), pa.array(s)], ["i", "n", "s"])

    means = np.zeros(k)
    if k <= WIDE_MAX_COLUMNS:
        finite = [F.when(_is_finite(F.col(f"x{i}")), F.col(f"x{i}")) for i in range(k)]
        means = np.array([m or 0.0 for m in source.agg(*[F.avg(x) for x in finite]).first()]) if k else means
    else:
        sums = source.mapInArrow(totals, "i int, n double, s double").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        for r in sums.collect():
            means[r["i"]] = r["s"] / r["n"] if r["n"] else 0.0

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((6, k, k))
        for b in batches:
            x, there = _matrix(b)
            with np.errstate(invalid="ignore", over="ignore"):  # an infinite value spoils its own pairs only
                x = np.where(there, x - means, 0.0)
                m = there.astype(float)
                values, squares = x.T @ m, (x * x).T @ m
                sums += np.stack([m.T @ m, x.T @ x, values, values.T, squares, squares.T])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)),
                                          pa.array(list(sums.transpose(1, 0, 2).reshape(k, -1)), pa.list_(pa.float64()))], ["i", "v"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[int, np.ndarray] = {}
        for b in batches:
            for i, v in zip(b.column(0).to_pylist(), b.column(1)):
                own = v.values.to_numpy()
                rows[i] = rows[i] + own if i in rows else own
        for i, flat in rows.items():
            n, xy, sx, sy, xx, yy = flat.reshape(6, k)
            with np.errstate(all="ignore"):
                vx, vy = xx - sx * sx / n, yy - sy * sy / n
                r = (xy - sx * sy / n) / np.sqrt(vx * vy)
            # Rounding leaves a constant column some variance of the last bits.
            ok = (n > 1) & (vx > 1e-14 * xx) & (vy > 1e-14 * yy) & np.isfinite(r)
            yield pa.RecordBatch.from_arrays([pa.array([cols[i]] * k), pa.array(cols), pa.array(r, mask=~ok)], ["col_a", "col_b", "corr"])

    return (source.mapInArrow(products, "i int, v array<double>").repartition("i")
            .mapInArrow(finish, "col_a string, col_b string, corr double"))


def scatter_pairs(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    fraction: float = 0.1,
    seed: int = 0,
) -> DataFrame:
    """Hash-sampled points for a scatter matrix.

    Long form (keys..., x_col, y_col, x, y) for every pair of columns of every
    sampled row; rows per input row are bounded by the column pairs.
    """
    cols = list(columns)
    sampled = df if fraction >= 1.0 else df.where(hash_below(keys, seed, fraction, df))
    pairs = [
        F.struct(F.lit(a).alias("x_col"), F.lit(b).alias("y_col"),
                 _q(a).cast("double").alias("x"), _q(b).cast("double").alias("y"))
        for i, a in enumerate(cols) for b in cols[i + 1:]
    ]
    return sampled.select(*[_q(k) for k in keys], F.inline(F.array(*pairs)))


def parallel_coordinates(
    df: DataFrame,
    label: str,
    columns: Sequence[str] | None = None,
    keys: Sequence[str] | None = None,
    fraction: float | None = None,
    seed: int = 0,
    scale: bool = True,
) -> DataFrame:
    """Lines of a parallel-coordinates plot (A9): (keys..., label, feature, value).

    Features are min-max scaled with the minimum and maximum of **all** rows;
    ``fraction`` (with ``keys``) keeps a deterministic hash sample of lines.
    """
    cols = [c for c in (columns if columns is not None else numeric_columns(df)) if c != label]
    if scale:
        st = collect_stats(scaling_stats(df, cols))
        values = {c: minmax(_q(c), st[c]) for c in cols}
    else:
        values = {c: _q(c).cast("double") for c in cols}
    src = df
    if fraction is not None and fraction < 1.0:
        if not keys:
            raise ValueError("a sample needs key columns for the hash")
        src = src.where(hash_below(keys, seed, fraction, df))
    ids = [_q(k) for k in (keys or [])]
    return src.select(*ids, _q(label), F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), values[c].alias("value")) for c in cols
    ])))


def label_profile(df: DataFrame, label: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Per label value and feature: rows, mean and exact quartiles of min-max scaled values.

    NaN is a missing value like null.  Any number of labels: up to
    ``quantiles.MAX_GROUPS`` (label, feature) groups the quartiles are searched, beyond it the
    values are ranked; the result is the same.
    """
    lines = parallel_coordinates(df, label, columns).withColumn("value", present(F.col("value")))
    # One row per (label, feature): also the statistics the quantile search starts from.
    agg = lines.groupBy(_q(label), "feature").agg(
        F.count("value").alias("rows"), F.avg("value").alias("mean"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    probs = [0.25, 0.5, 0.75]
    found = collect_few(agg)
    if found is None:
        ranked = ranked_quantiles(lines, [label, "feature"], "value", probs)
        wide = ranked.groupBy(_q(label).alias("__l"), F.col("feature").alias("__f")).agg(
            *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(q) for p, q in zip(probs, ("q25", "q50", "q75"))])
        return (agg.join(wide, agg[label].eqNullSafe(wide["__l"]) & (agg["feature"] == wide["__f"]), "left")
                .select(_q(label), "feature", "rows", "mean", "q25", "q50", "q75"))
    stats = {(r[label], r["feature"]): (r["rows"], r["lo"], r["hi"], 0) for r in found}
    qs = {(r[label], r["feature"], r["prob"]): r["quantile"]
          for r in exact_quantiles(lines, [label, "feature"], "value", probs, stats).collect()}
    out = [(r[label], r["feature"], r["rows"], r["mean"],
            *[qs.get((r[label], r["feature"], p)) for p in probs]) for r in found]
    schema = T.StructType([df.schema[label], T.StructField("feature", T.StringType()),
                           T.StructField("rows", T.LongType()), T.StructField("mean", T.DoubleType()),
                           T.StructField("q25", T.DoubleType()), T.StructField("q50", T.DoubleType()),
                           T.StructField("q75", T.DoubleType())])
    return df.sparkSession.createDataFrame(out, schema)


def _class_counts(df: DataFrame, label: str) -> tuple[DataFrame, int, int]:
    """((label, count) per class, rows, largest count): the table is read once, unless there are more than
    ``MAX_CLASSES`` classes, whose counts are written to the checkpoint folder."""
    counts = df.groupBy(_q(label)).agg(F.count(F.lit(1)).alias("count"))
    rows = collect_few(counts, MAX_CLASSES)
    if rows is not None:
        sizes = [r["count"] for r in rows]
        return df.sparkSession.createDataFrame(rows, counts.schema), sum(sizes), max(sizes, default=0)
    ensure_checkpoint_dir(df.sparkSession)
    counts = counts.checkpoint(eager=True)
    total, biggest = counts.agg(F.sum("count"), F.max("count")).first()
    return counts, total, biggest


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """(label, count, share) per label value (A10)."""
    counts, total, _ = _class_counts(df, label)
    return counts.withColumn("share", F.col("count") / F.lit(total))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, count, weight) with weight = largest class count / class count (A10).

    A 6:1 imbalance gives weights 1 and 6, the reference's ``class_weight``.
    """
    counts, _, biggest = _class_counts(df, label)
    return counts.withColumn("weight", F.lit(biggest) / F.col("count"))


MAX_CLASSES = 100_000


def collect_class_weights(weights: DataFrame, label: str) -> dict[float, float]:
    """Class-weight table to a dict; a null class has no weight.

    More than ``MAX_CLASSES`` classes are no label of a network and are refused.
    """
    rows = collect_few(weights, MAX_CLASSES)
    if rows is None:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    return {float(r[label]): float(r["weight"]) for r in rows if r[label] is not None}


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, nulls, rows, share) per column, one pass.

    NaN in floating columns counts as missing too.
    """
    cols = list(columns) if columns is not None else df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(cols):
        missing = _q(c).isNull()
        if isinstance(types[c], (T.DoubleType, T.FloatType)):
            missing = missing | F.isnan(_q(c))
        aggs.append(F.count_if(missing).alias(f"n{i}"))
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("nulls"), F.col("rows").alias("rows"),
                     F.when(F.col("rows") > 0, F.col(f"n{i}") / F.col("rows")).alias("share"))
            for i, c in enumerate(cols)]
    return _long(df.agg(*aggs), rows)


def _filled(df: DataFrame, c: str, v: object) -> Column:
    """Column ``c`` with ``v`` for null, and for NaN in a floating column."""
    dtype = df.schema[c].dataType
    own = present(_q(c)) if isinstance(dtype, (T.DoubleType, T.FloatType)) else _q(c)
    return F.coalesce(own, F.lit(v).cast(dtype))


def fill_nulls(
    df: DataFrame,
    values: Mapping[str, object] | None = None,
    numeric: str | None = None,
) -> DataFrame:
    """Replace nulls and NaN (T3): fixed ``values`` per column, and/or ``numeric="mean"``.

    The means are those of the finite values, from one aggregate over all rows
    (one value per column); an integer column gets the nearest integer.
    """
    fills: dict[str, Column] = {}
    if numeric == "mean":
        cols = [c for c in numeric_columns(df) if not values or c not in values]
        if cols:
            means = df.agg(*[F.avg(F.when(_is_finite(_q(c).cast("double")), _q(c))).alias(f"m{i}")
                             for i, c in enumerate(cols)]).first()
            for i, c in enumerate(cols):
                mean = means[f"m{i}"]
                if mean is not None:
                    whole = isinstance(df.schema[c].dataType, T.IntegralType)
                    fills[c] = _filled(df, c, round(mean) if whole else mean)
    elif numeric is not None:
        raise ValueError("numeric must be None or 'mean'")
    for c, v in (values or {}).items():
        if c in df.columns:
            fills[c] = _filled(df, c, v)
    return df.withColumns(fills) if fills else df


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any of ``columns`` (all columns by default)."""
    return df.na.drop(how="any", subset=list(columns) if columns is not None else None)
