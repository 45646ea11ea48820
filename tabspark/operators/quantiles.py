"""Exact quantiles by distributed selection.

The p-quantile of a group is its ceil(n p)-th smallest non-null value (SQL
``percentile_disc``, DuckDB ``quantile_disc``).  Instead of sorting, each
pass narrows an interval per (group, p) target:

1. count / min / max per group (usually shared with the caller's aggregate);
2. while equal-width bins narrow it well, values inside each target's interval are put into ``bins`` equal-width
   bins; a group-by on (target, bin) shuffles at most targets x bins rows
   per task, and a window per target over those bins (bounded by ``bins``
   rows) finds the bin holding the target rank;
3. the bin's own min and max become the next interval;  once a bin holds at
   most ``final_rows`` rows (or one distinct value, e.g. a hot value), its
   distinct values are counted and the exact value is picked.

4. an interval that a histogram pass left with most of its rows (values over
   many orders of magnitude), or with an infinite end, is narrowed by rank
   instead: ``percentile_approx`` inside it brackets the target rank, and an
   exact count of the rows below and in the bracket verifies it (a bracket
   that misses still cuts the interval).

A caller that has brackets of the targets (``column_quantiles(brackets=)``: from a sample) starts there: one scan counts the rows below and inside each
bracket, and the rest of the search sees only the rows inside.

Groups beyond ``MAX_GROUPS`` are not searched but ranked: the rows are numbered in the order
(group, value) by range partitions (``global_rank``, which splits hot groups and values), and the
value at each target's number is looked up; nothing per group is on the driver.

Uniform data at 10^12 rows needs three histogram passes, any other
distribution some two passes for each factor of 1,000 in rows; every pass is a
filtered scan plus a small aggregate.  A target that no pass could narrow
raises; no quantile is ever left null.  Results reaching the driver are
bounded by the number of targets.  NaN sorts after every number.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ranking import global_rank

BINS = 4096
FINAL_ROWS = 100_000
RANK_ACCURACY = 10_000  # of percentile_approx
# Each pass narrows every open interval, so this is only reached by a fault.
MAX_PASSES = 200
# The search keeps one interval per (group, p) on the driver and broadcasts
# the open ones; more groups than this are ranked instead.
MAX_GROUPS = 100_000


def collect_few(df: DataFrame, limit: int | None = None) -> list | None:
    """The rows of a per-group table, or None if there are more than ``limit`` (``MAX_GROUPS``)."""
    limit = MAX_GROUPS if limit is None else limit
    rows = df.limit(limit + 1).collect()
    return None if len(rows) > limit else rows


def target_rank(n: int, p: float) -> int:
    """1-based rank of the p-quantile among n values: max(1, ceil(n p)), p read as a decimal."""
    return max(1, math.ceil(Fraction(str(p)) * n))


def _select(spark, targets: dict, rows_in, bins: int, final_rows: int) -> None:
    """Narrow every open target to its exact value (fills ``targets[i][6]``).

    ``rows_in(intervals, bins)`` returns a DataFrame (__iid, __v) of the
    finite values inside each interval [lo, hi] of its group, plus ``__bin``
    (the equal-width bin of the value in its interval) when ``bins`` is
    given; ``intervals`` is a list of (group tuple, interval id, lo, hi).
    """

    def intervals(ids):
        """Distinct (group, lo, hi) of the targets; targets sharing one share its rows."""
        iid: dict[tuple, int] = {}
        members: dict[int, list[int]] = {}
        for i in ids:
            key = (tuple(targets[i][0]), float(targets[i][3]), float(targets[i][4]))
            j = iid.setdefault(key, len(iid))
            members.setdefault(j, []).append(i)
        return [(g, j, lo, hi) for (g, lo, hi), j in iid.items()], members

    def pick(per_unit: DataFrame, order: str, members) -> list:
        """Rows (tid, unit, n, cum) of the unit holding each target rank."""
        need = spark.createDataFrame(
            [(j, i, targets[i][2] - targets[i][5]) for j, tids in members.items() for i in tids],
            "__iid bigint, __tid bigint, __need bigint")
        # One window partition per interval, at most ``bins`` (or ``final_rows``) rows.
        cum = F.sum("__n").over(Window.partitionBy("__iid").orderBy(order)
                                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return (per_unit.withColumn("__cum", cum).join(F.broadcast(need), "__iid")
                .where((F.col("__cum") >= F.col("__need")) & (F.col("__cum") - F.col("__n") < F.col("__need")))
                .collect())

    def exact_pick(ids) -> None:
        """Exact pick among the distinct values of small intervals."""
        ivs, members = intervals(ids)
        per_value = rows_in(ivs, None).groupBy("__iid", "__v").agg(F.count(F.lit(1)).alias("__n"))
        for r in pick(per_value, "__v", members):
            targets[r["__tid"]][6] = r["__v"]

    # Groups that are small already need no histogram pass.
    direct = [i for i, t in targets.items() if t[6] is None and t[7] <= final_rows]
    if direct:
        exact_pick(direct)
    by_rank = {i for i, t in targets.items() if t[6] is None and not (math.isfinite(t[3]) and math.isfinite(t[4]))}
    for _ in range(MAX_PASSES):
        open_ids = [i for i, t in targets.items() if t[6] is None]
        if not open_ids:
            return
        ranked = [i for i in open_ids if i in by_rank]
        small = _narrow_by_rank(targets, ranked, intervals, rows_in, final_rows) if ranked else []
        if small:
            exact_pick(small)
        open_ids = [i for i in open_ids if i not in by_rank]
        if not open_ids:
            continue
        ivs, members = intervals(open_ids)
        hist = (rows_in(ivs, bins)
                .groupBy("__iid", "__bin").agg(F.count(F.lit(1)).alias("__n"),
                                               F.min("__v").alias("__bmin"), F.max("__v").alias("__bmax")))
        small = []
        for r in pick(hist, "__bin", members):
            t = targets[r["__tid"]]
            t[5] += r["__cum"] - r["__n"]
            t[3], t[4] = r["__bmin"], r["__bmax"]
            if r["__n"] * 8 > t[7]:
                by_rank.add(r["__tid"])
            t[7] = r["__n"]
            if t[3] == t[4]:
                t[6] = t[3]
            elif r["__n"] <= final_rows:
                small.append(r["__tid"])
        if small:
            exact_pick(small)
    raise RuntimeError("a quantile could not be narrowed down")


def _narrow_by_rank(targets: dict, ids: list, intervals, rows_in, final_rows: int) -> list:
    """One bracket for each target, verified by exact counts; returns the targets that are small now."""
    ivs, members = intervals(ids)
    place, spread = {}, 4.0 / RANK_ACCURACY
    for j, tids in members.items():
        for i in tids:
            at = (targets[i][2] - targets[i][5]) / targets[i][7]
            place[i] = (max(0.0, at - spread), min(1.0, at + spread))
    probs = sorted({p for pair in place.values() for p in pair})
    found = {r["__iid"]: dict(zip(probs, r["q"])) for r in rows_in(ivs, None).groupBy("__iid").agg(
        F.percentile_approx("__v", probs, RANK_ACCURACY).alias("q")).collect()}
    asked = []
    for g, j, lo, hi in ivs:
        for i in members[j]:
            a, b = (found[j][p] for p in place[i])
            asked += [(g, 2 * i, lo, math.nextafter(a, -math.inf)), (g, 2 * i + 1, a, b)]
    counted = {r["__iid"]: r for r in rows_in([a for a in asked if a[2] <= a[3]], None).groupBy("__iid").agg(
        F.count(F.lit(1)).alias("n"), F.min("__v").alias("lo"), F.max("__v").alias("hi")).collect()}
    small = []
    for i in ids:
        t = targets[i]
        below = counted[2 * i]["n"] if 2 * i in counted else 0
        inside = counted[2 * i + 1]
        need = t[2] - t[5]
        if need <= below:
            t[4], t[7] = counted[2 * i]["hi"], below
        elif need <= below + inside["n"]:
            t[3], t[4], t[5], t[7] = inside["lo"], inside["hi"], t[5] + below, inside["n"]
        else:
            t[3], t[5], t[7] = math.nextafter(inside["hi"], math.inf), t[5] + below + inside["n"], t[7] - below - inside["n"]
        if t[3] == t[4]:
            t[6] = t[3]
        elif t[7] <= final_rows:
            small.append(i)
    return small


def bin_of(v: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Equal-width bin 0..bins-1 of ``v`` in [lo, hi]; the top edge folds into the last bin."""
    width = hi - lo
    b = F.least(F.floor((v - lo) / width * F.lit(float(bins))), F.lit(bins - 1))
    return F.when(width > 0, b).otherwise(F.lit(0)).cast("long")


def _targets(stats: dict, probs: Sequence[float]) -> dict[int, list]:
    """target id -> [group, p, rank, lo, hi, rows below lo, answer, rows in group]."""
    targets: dict[int, list] = {}
    for g, (n, lo, hi, nan) in stats.items():
        for p in probs:
            total = n + (nan or 0)
            if total == 0:
                continue
            r = target_rank(total, p)
            answer = None
            if r > n:
                answer = float("nan")
            elif lo == hi:
                answer = lo
            targets[len(targets)] = [tuple(g), p, r, lo, hi, 0, answer, n]
    return targets


def exact_quantiles(
    long: DataFrame,
    groups: Sequence[str],
    value: str,
    probs: Sequence[float],
    stats: dict | None = None,
    bins: int = BINS,
    final_rows: int = FINAL_ROWS,
) -> DataFrame:
    """(groups..., prob, quantile) for every group of a long table and every p.

    ``stats`` may map a group tuple to (non-NaN count, min, max, NaN count)
    when the caller has it already; otherwise one aggregate computes it.
    Intervals reach the rows by a broadcast join on the group columns.
    """
    spark = long.sparkSession
    gcols = list(groups)
    gtypes = {f.name: f.dataType for f in long.schema.fields if f.name in gcols}
    v = long.where(F.col(value).isNotNull()).select(*gcols, F.col(value).cast("double").alias("__v"))
    if stats is None:
        per_group = (v.groupBy(*gcols).agg(F.count_if(~F.isnan("__v")).alias("n"),
                                      F.min(F.when(~F.isnan("__v"), F.col("__v"))).alias("lo"),
                                      F.max(F.when(~F.isnan("__v"), F.col("__v"))).alias("hi"),
                                      F.count_if(F.isnan("__v")).alias("nan")))
        rows = collect_few(per_group)
        if rows is None:
            return ranked_quantiles(v, gcols, "__v", probs)
        stats = {tuple(r[g] for g in gcols): (r["n"], r["lo"], r["hi"], r["nan"]) for r in rows}
    targets = _targets(stats, probs)
    finite = v.where(~F.isnan("__v"))
    schema = T.StructType([T.StructField(f"__g{i}", gtypes[c]) for i, c in enumerate(gcols)] + [
        T.StructField("__iid", T.LongType()), T.StructField("__ilo", T.DoubleType()),
        T.StructField("__ihi", T.DoubleType())])

    def rows_in(ivs, bins):
        # One row per interval: a broadcast of bounded size.  Null-safe keys:
        # a null group value is a group too.
        table = F.broadcast(spark.createDataFrame([(*g, j, lo, hi) for g, j, lo, hi in ivs], schema))
        cond = None
        for i, c in enumerate(gcols):
            eq = finite[c].eqNullSafe(table[f"__g{i}"])
            cond = eq if cond is None else cond & eq
        inside = (finite.join(table, cond)
                  .where((F.col("__v") >= F.col("__ilo")) & (F.col("__v") <= F.col("__ihi"))))
        if bins is None:
            return inside.select("__iid", "__v")
        return inside.select("__iid", "__v", bin_of(F.col("__v"), F.col("__ilo"), F.col("__ihi"), bins).alias("__bin"))

    _select(spark, targets, rows_in, bins, final_rows)
    return _result(spark, targets, [T.StructField(c, gtypes[c]) for c in gcols])


def ranked_quantiles(long: DataFrame, groups: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """(groups..., prob, quantile) of any number of groups, exact: rows numbered by (group, value).

    Null values do not count; NaN sorts after every number.  One range shuffle of
    (group, value), written, and one join on the row number.
    """
    gcols = list(groups)
    rows = long.where(F.col(value).isNotNull()).select(*[F.col(f"`{g}`") for g in gcols], F.col(value).cast("double").alias("__q"))
    ranked = global_rank(rows, [*[F.col(f"`{g}`") for g in gcols], F.col("__q")], "__r")
    spans = ranked.groupBy(*[F.col(f"`{g}`") for g in gcols]).agg(F.min("__r").alias("__first"), F.count(F.lit(1)).alias("__n"))
    places = []
    for p in probs:  # max(1, ceil(n p)), p read as a decimal
        share = Fraction(str(p))
        nth = F.floor((F.col("__n") * F.lit(share.numerator) + F.lit(share.denominator - 1)) / F.lit(share.denominator))
        places.append(F.struct(F.lit(float(p)).alias("prob"), (F.col("__first") + F.greatest(nth, F.lit(1)) - 1).alias("__r")))
    wanted = spans.select(*[F.col(f"`{g}`") for g in gcols], F.inline(F.array(*places)))
    return wanted.join(ranked.select("__r", "__q"), "__r").select(*[F.col(f"`{g}`") for g in gcols], "prob", F.col("__q").alias("quantile"))


def _use_brackets(df: DataFrame, targets: dict, brackets: dict) -> None:
    """Count the rows below and inside each target's bracket, one aggregate; the target's interval becomes the part
    that holds its rank."""
    aggs = []
    for i, t in targets.items():
        x, (a, b) = F.col(f"`{t[0][0]}`").cast("double"), brackets[t[0][0], t[1]]
        aggs += [F.count_if(x < F.lit(a)).alias(f"below{i}"), F.count_if((x >= F.lit(a)) & (x <= F.lit(b))).alias(f"in{i}")]
    found = df.agg(*aggs).first()
    for i, t in targets.items():
        a, b = brackets[t[0][0], t[1]]
        below, inside = found[f"below{i}"], found[f"in{i}"]
        if t[2] <= below:
            t[4], t[7] = math.nextafter(a, -math.inf), below
        elif t[2] <= below + inside:
            t[3], t[4], t[5], t[7] = a, b, below, inside
        else:
            t[3], t[5], t[7] = math.nextafter(b, math.inf), below + inside, t[7] - below - inside
        if t[3] == t[4]:
            t[6] = t[3]


def column_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    stats: dict,
    bins: int = BINS,
    final_rows: int = FINAL_ROWS,
    brackets: dict | None = None,
) -> DataFrame:
    """(column_name, prob, quantile) for numeric columns of a wide table.

    ``stats[(column,)]`` = (non-NaN count, min, max, NaN count);
    ``brackets[column, p]`` = two values that probably enclose the quantile.  The
    intervals are literals in one projection: each row emits only the
    (interval, value[, bin]) entries that fall inside an open interval, no join.
    """
    spark = df.sparkSession
    targets = _targets(stats, probs)

    def rows_in(ivs, bins):
        pairs, any_inside = [], F.lit(False)
        for (c,), j, lo, hi in ivs:
            x = F.col(f"`{c}`").cast("double")
            any_inside = any_inside | ((x >= F.lit(lo)) & (x <= F.lit(hi)))
            fields = [F.lit(j).cast("long").alias("__iid"), x.alias("__v")]
            if bins is not None:
                fields.append(bin_of(x, F.lit(float(lo)), F.lit(float(hi)), bins).alias("__bin"))
            pairs.append(F.when((x >= F.lit(lo)) & (x <= F.lit(hi)), F.struct(*fields)))
        # A value outside every interval gives null entries; they are dropped
        # after the generator (a lambda ``filter`` would run uncompiled, 4x slower).
        # Intervals that are small hold values of few rows.
        return (df if bins else df.where(any_inside)).select(F.inline(F.array(*pairs))).where(F.col("__iid").isNotNull())

    unknown = {i: t for i, t in targets.items() if t[6] is None}
    if brackets and unknown:
        _use_brackets(df, unknown, brackets)
    _select(spark, targets, rows_in, bins, final_rows)
    return _result(spark, targets, [T.StructField("column_name", T.StringType())])


def _result(spark, targets: dict, group_fields: list) -> DataFrame:
    out_schema = T.StructType(group_fields + [
        T.StructField("prob", T.DoubleType()), T.StructField("quantile", T.DoubleType())])
    data = [(*t[0], float(t[1]), None if t[6] is None else float(t[6])) for t in targets.values()]
    return spark.createDataFrame(data, out_schema)
