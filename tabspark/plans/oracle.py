"""SQL (DuckDB dialect) equivalents of the checked queries in ``catalog.py``.

Each string runs against views named after the driver's tables.  Column
names and rounding follow the Spark side exactly.  Queries whose result
depends on training (Q30, Q31, Q33) have no SQL form.
"""

from __future__ import annotations

from ..functions import hashing
from . import fixed

SEED = fixed.SEED
TWO32 = 4294967296


def _hashed(src: str, keys: list[str], tag: int, name: str = "__h", seed: int = SEED) -> str:
    """``src`` plus the integer key hash of a purpose as column ``name`` (the same arithmetic as Spark's)."""
    p = hashing.KEY_PRIME
    h = f"CAST({hashing.tagged_seed(seed, tag)} AS BIGINT)"
    for k in keys:
        folded = f"(((CAST({k} AS BIGINT)) % {p}) + {p}) % {p}"
        h = f"((({h}) * {hashing.STEP}) % {p} + ({folded}) * {hashing.KEY_MULT} % {p}) % {p}"
    one = f"(xor({name}, {name} >> 16) * {hashing.MIX_1}) & {hashing.MASK_32}"
    two = f"(xor({name}, {name} >> 15) * {hashing.MIX_2}) & {hashing.MASK_32}"
    return (f"(SELECT * REPLACE ({two} AS {name}) FROM (SELECT * REPLACE ({one} AS {name}) "
            f"FROM (SELECT *, {h} AS {name} FROM {src})))")


def _below(fraction: float) -> str:
    return f"__h < {int(fraction * TWO32)}"


def _num(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def _linear(inputs: list[str], w_col: list[float], b: float) -> str:
    """b + x0*w0 + x1*w1 ..., left to right like the Spark expression."""
    expr = _num(b)
    for x, w in zip(inputs, w_col):
        expr = f"({expr} + {x} * {_num(w)})"
    return expr


def _sigmoid(z: str) -> str:
    return f"(1.0 / (1.0 + exp(-({z}))))"


def _pred_class(p: str) -> str:
    return f"(round_even(LEAST(GREATEST({p}, 0.0), 1.0), 0) + 0.0)"


def _zscore_cte(table: str, cols: list[str], name: str = "s") -> str:
    parts = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in cols)
    return f"{name} AS (SELECT {parts} FROM {table})"


def _z(c: str, s: str = "s") -> str:
    return f"(({c} - {s}.m_{c}) / {s}.s_{c})"


LINEITEM_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                    "l_quantity", "l_extendedprice", "l_discount", "l_tax"]

SQL: dict[str, str] = {}

SQL["q00_row_count_lineitem"] = "SELECT count(*) AS rows FROM lineitem"

_casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in LINEITEM_NUMERIC)
SQL["q01_summary_lineitem"] = f"""
WITH wide AS (SELECT {_casts} FROM lineitem),
long AS (UNPIVOT wide ON {', '.join(LINEITEM_NUMERIC)} INTO NAME column_name VALUE value),
agg AS (
  SELECT column_name,
         CAST(count(value) AS DOUBLE) AS "count", avg(value) AS "mean", stddev_samp(value) AS "stddev",
         min(value) AS "min", quantile_disc(value, 0.25) AS "25%", quantile_disc(value, 0.5) AS "50%",
         quantile_disc(value, 0.75) AS "75%", max(value) AS "max"
  FROM long GROUP BY column_name)
SELECT column_name, statistic, ROUND(value, 6) AS value
FROM agg UNPIVOT INCLUDE NULLS (value FOR statistic IN ("count", "mean", "stddev", "min", "25%", "50%", "75%", "max"))
"""


def _describe_sql() -> str:
    parts = []
    for c in ["c_custkey", "c_nationkey", "c_acctbal"]:
        x = f"CAST({c} AS DOUBLE)"
        for stat, agg in (("count", f"CAST(count({c}) AS DOUBLE)"), ("mean", f"avg({x})"),
                          ("stddev", f"stddev_samp({x})"), ("min", f"min({x})"), ("max", f"max({x})")):
            parts.append(f"SELECT '{c}' AS column_name, '{stat}' AS statistic, ROUND({agg}, 6) AS value, "
                         f"CAST(NULL AS VARCHAR) AS text FROM customer")
    for c in ["c_name", "c_mktsegment"]:
        x = f"TRY_CAST({c} AS DOUBLE)"
        for stat, agg in (("count", f"CAST(count({c}) AS DOUBLE)"), ("mean", f"avg({x})"),
                          ("stddev", f"stddev_samp({x})")):
            parts.append(f"SELECT '{c}' AS column_name, '{stat}' AS statistic, ROUND({agg}, 6) AS value, "
                         f"CAST(NULL AS VARCHAR) AS text FROM customer")
        for stat, agg in (("min", f"min({c})"), ("max", f"max({c})")):
            parts.append(f"SELECT '{c}' AS column_name, '{stat}' AS statistic, CAST(NULL AS DOUBLE) AS value, "
                         f"{agg} AS text FROM customer")
    return "\nUNION ALL ".join(parts)


SQL["q02_describe_customer"] = _describe_sql()

SQL["q03_unique_orderpriority"] = "SELECT DISTINCT o_orderpriority FROM orders"

SQL["q04a_size_documents"] = """
SELECT count(*) AS rows,
       CAST(count(*) * 16 + COALESCE(sum(COALESCE(strlen(text), 0) + COALESCE(strlen(lang), 0)
            + COALESCE(strlen(source), 0)), 0) AS BIGINT) AS bytes,
       ROUND((count(*) * 16 + COALESCE(sum(COALESCE(strlen(text), 0) + COALESCE(strlen(lang), 0)
            + COALESCE(strlen(source), 0)), 0)) / count(*), 6) AS bytes_per_row
FROM documents
"""

SQL["q04b_size_customer"] = """
SELECT count(*) AS rows,
       CAST(count(*) * 20 + COALESCE(sum(COALESCE(strlen(c_name), 0) + COALESCE(strlen(c_mktsegment), 0)), 0)
            AS BIGINT) AS bytes,
       ROUND((count(*) * 20 + COALESCE(sum(COALESCE(strlen(c_name), 0) + COALESCE(strlen(c_mktsegment), 0)), 0))
             / count(*), 6) AS bytes_per_row
FROM customer
"""

SQL["q05_scaling_lineitem"] = "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, ROUND(CAST(count({c}) AS DOUBLE), 6) AS \"count\", "
    f"ROUND(avg(CAST({c} AS DOUBLE)), 6) AS mean, ROUND(stddev_samp(CAST({c} AS DOUBLE)), 6) AS stddev, "
    f"ROUND(min(CAST({c} AS DOUBLE)), 6) AS \"min\", ROUND(max(CAST({c} AS DOUBLE)), 6) AS \"max\" FROM lineitem"
    for c in LINEITEM_NUMERIC)


def _histogram_sql(table: str, cols: list[str], bins: int) -> str:
    parts = []
    for c in cols:
        parts.append(f"""
SELECT '{c}' AS column_name, CAST(g.bin AS INTEGER) AS bin,
       ROUND(s.lo + g.bin * ((s.hi - s.lo) / {bins}), 6) AS lower,
       ROUND(s.lo + (g.bin + 1) * ((s.hi - s.lo) / {bins}), 6) AS upper,
       CAST(COALESCE(c.cnt, 0) AS BIGINT) AS "count"
FROM (SELECT range AS bin FROM range({bins})) g
CROSS JOIN (SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM {table}) s
LEFT JOIN (
  SELECT LEAST(CAST(floor((CAST({c} AS DOUBLE) - s2.lo) / (s2.hi - s2.lo) * {float(bins)}) AS BIGINT), {bins - 1}) AS bin,
         count(*) AS cnt
  FROM {table}, (SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM {table}) s2
  WHERE {c} IS NOT NULL GROUP BY 1) c ON c.bin = g.bin""")
    return "\nUNION ALL ".join(parts)


SQL["q06_histogram_lineitem"] = _histogram_sql("lineitem", ["l_extendedprice", "l_quantity"], 10)


def _corr_sql() -> str:
    parts = []
    for a in LINEITEM_NUMERIC:
        for b in LINEITEM_NUMERIC:
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, "
                         f"ROUND(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr FROM lineitem")
    return "\nUNION ALL ".join(parts)


SQL["q07_correlation_lineitem"] = _corr_sql()


def _scatter_sql() -> str:
    cols = fixed.LINE_FEATURES
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            parts.append(f"SELECT l_partkey, '{a}' AS x_col, '{b}' AS y_col, CAST({a} AS DOUBLE) AS x, "
                         f"CAST({b} AS DOUBLE) AS y FROM s")
    return (f"WITH s AS (SELECT * FROM {_hashed('lineitem', ['l_partkey'], hashing.SAMPLE)} WHERE {_below(0.1)})\n"
            + "\nUNION ALL ".join(parts))


SQL["q08_scatter_pairs_lineitem"] = _scatter_sql()


def _minmax_cte(table: str, cols: list[str]) -> str:
    parts = ", ".join(f"CAST(min({c}) AS DOUBLE) AS lo_{c}, CAST(max({c}) AS DOUBLE) AS hi_{c}" for c in cols)
    return f"mm AS (SELECT {parts} FROM {table})"


def _mm(c: str) -> str:
    return f"((CAST({c} AS DOUBLE) - mm.lo_{c}) / (mm.hi_{c} - mm.lo_{c}))"


SQL["q09a_parallel_coordinates_orders"] = f"""
WITH {_minmax_cte('orders', fixed.ORDER_FEATURES)}
""" + "\nUNION ALL ".join(
    f"SELECT o_orderkey, o_orderstatus, '{c}' AS feature, ROUND({_mm(c)}, 6) AS value FROM orders, mm"
    for c in fixed.ORDER_FEATURES)

SQL["q09b_label_profile_orders"] = f"""
WITH {_minmax_cte('orders', fixed.ORDER_FEATURES)},
lines AS (""" + "\nUNION ALL ".join(
    f"SELECT o_orderstatus, '{c}' AS feature, {_mm(c)} AS value FROM orders, mm" for c in fixed.ORDER_FEATURES) + """)
SELECT o_orderstatus, feature, count(value) AS rows, ROUND(avg(value), 6) AS mean,
       ROUND(quantile_disc(value, 0.25), 6) AS q25, ROUND(quantile_disc(value, 0.5), 6) AS q50,
       ROUND(quantile_disc(value, 0.75), 6) AS q75
FROM lines GROUP BY o_orderstatus, feature
"""

SQL["q10a_class_balance_linestatus"] = """
SELECT l_linestatus, count(*) AS "count", ROUND(count(*) / sum(count(*)) OVER (), 6) AS share
FROM lineitem GROUP BY l_linestatus
"""

SQL["q10b_class_weights_quality"] = """
SELECT quality, count(*) AS "count", ROUND(max(count(*)) OVER () / count(*), 6) AS weight
FROM labels GROUP BY quality
"""

_NULLS = """injected AS (
  SELECT o_orderkey, nullif(o_orderpriority, '1-URGENT') AS o_orderpriority,
         nullif(o_orderstatus, 'P') AS o_orderstatus,
         CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END AS o_totalprice
  FROM orders)"""

SQL["q36a_null_profile_orders"] = f"WITH {_NULLS}\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL{' OR isnan(' + c + ')' if c == 'o_totalprice' else ''}) AS nulls, "
    f"count(*) AS rows, ROUND(count(*) FILTER (WHERE {c} IS NULL) / count(*), 6) AS share FROM injected"
    for c in ["o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice"])

SQL["q36b_fill_nulls_orders"] = f"""
WITH {_NULLS}
SELECT o_orderkey, COALESCE(o_orderpriority, 'UNKNOWN') AS o_orderpriority,
       COALESCE(o_orderstatus, 'U') AS o_orderstatus,
       ROUND(COALESCE(o_totalprice, (SELECT avg(o_totalprice) FROM injected)), 6) AS o_totalprice
FROM injected
"""

SQL["q11_drop_columns_orders"] = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"

SQL["q12_rename_columns_customer"] = """
SELECT c_custkey, c_name AS customer_name, c_nationkey, c_acctbal AS balance, c_mktsegment FROM customer
"""

SQL["q13_modify_columns_lineitem"] = """
SELECT l_orderkey, l_linenumber,
       ROUND(l_extendedprice * (1.0 - l_discount), 6) AS l_extendedprice,
       ROUND((l_extendedprice * (1.0 - l_discount)) * l_tax, 6) AS l_tax,
       l_discount
FROM lineitem
"""

LINEITEM_COLUMNS = LINEITEM_NUMERIC + ["l_returnflag", "l_linestatus", "l_shipdate"]

SQL["q14a_dtypes_lineitem"] = f"""
WITH n AS (SELECT {', '.join(f'count({c}) AS {c}' for c in LINEITEM_COLUMNS)} FROM lineitem),
u AS (UNPIVOT n ON COLUMNS(*) INTO NAME column_name VALUE non_null)
SELECT i.column_name,
       CASE i.data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
            WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(i.data_type) END AS dtype,
       i.data_type IN ('BIGINT', 'INTEGER', 'DOUBLE', 'FLOAT', 'SMALLINT', 'TINYINT') AS is_numeric,
       u.non_null
FROM information_schema.columns i JOIN u ON i.column_name = u.column_name
WHERE i.table_name = 'lineitem'
"""

SQL["q14b_numeric_projection_lineitem"] = f"SELECT {', '.join(LINEITEM_NUMERIC)} FROM lineitem"

_STATUS = "CASE {c} WHEN 'O' THEN 1.0 WHEN 'F' THEN 0.0 END"

SQL["q15a_encode_linestatus"] = (
    f"SELECT l_orderkey, l_linenumber, CAST({_STATUS.format(c='l_linestatus')} AS DOUBLE) AS l_linestatus "
    "FROM lineitem")

SQL["q15b_encode_orderstatus_unknown"] = (
    f"SELECT o_orderkey, CAST({_STATUS.format(c='o_orderstatus')} AS DOUBLE) AS o_orderstatus FROM orders")

SQL["q15c_unknown_counts_orders"] = """
SELECT 'o_orderstatus' AS column_name,
       count(*) FILTER (WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('O', 'F')) AS unknown FROM orders
UNION ALL
SELECT 'o_orderpriority' AS column_name,
       count(*) FILTER (WHERE o_orderpriority IS NOT NULL AND o_orderpriority NOT IN ('O', 'F')) AS unknown FROM orders
"""

SQL["q16_encode_booleans_orders"] = "SELECT o_orderkey, CAST(o_totalprice > 250000 AS DOUBLE) AS is_big FROM orders"

SQL["q17_prepare_lineitem"] = (
    f"SELECT {', '.join(LINEITEM_NUMERIC)}, CAST({_STATUS.format(c='l_linestatus')} AS DOUBLE) AS l_linestatus "
    "FROM lineitem")

SQL["q18_standardize_orders"] = f"""
WITH {_zscore_cte('orders', ['o_totalprice'])}
SELECT o_orderkey, ROUND({_z('o_totalprice')}, 6) AS o_totalprice FROM orders, s
"""

SQL["q19_minmax_orders"] = f"""
WITH {_minmax_cte('orders', ['o_totalprice'])}
SELECT o_orderkey, ROUND({_mm('o_totalprice')}, 6) AS o_totalprice FROM orders, mm
"""

SQL["q20a_hash_split_orders"] = f"""
SELECT o_orderkey, CAST(CASE WHEN __h < {int(0.8 * TWO32)} THEN 0 ELSE 1 END AS INTEGER) AS side
FROM {_hashed('orders', ['o_orderkey'], hashing.SPLIT)}
"""

SQL["q20b_split_stats_orders"] = f"""
SELECT side, count(*) AS rows, ROUND(avg(o_totalprice), 6) AS mean_totalprice
FROM (SELECT o_totalprice,
             CAST(CASE WHEN __h < {int(0.8 * TWO32)} THEN 0 ELSE 1 END AS INTEGER) AS side
      FROM {_hashed('orders', ['o_orderkey'], hashing.SPLIT)})
GROUP BY side
"""

SQL["q20c_batch_counts_orders"] = f"""
SELECT split, rows, GREATEST(1, rows // {fixed.BATCH}) AS batches
FROM (SELECT CASE WHEN __h < {int(0.8 * TWO32)} THEN 'train' ELSE 'val' END AS split,
             count(*) AS rows
      FROM {_hashed('orders', ['o_orderkey'], hashing.SPLIT)} GROUP BY 1)
"""

SQL["q21_hash_sample_events"] = f"""
SELECT event_id, user_id, event_type, value FROM {_hashed('events', ['event_id'], hashing.SAMPLE)} WHERE {_below(0.1)}
"""

SQL["q40_sample_then_split_orders"] = f"""
SELECT side, o_orderstatus, count(*) AS rows
FROM (SELECT o_orderstatus, CAST(CASE WHEN __h < {int(0.8 * TWO32)} THEN 0 ELSE 1 END AS INTEGER) AS side
      FROM {_hashed('(SELECT * EXCLUDE (__h) FROM ' + _hashed('orders', ['o_orderkey'], hashing.SAMPLE)
                    + ' WHERE ' + _below(0.5) + ')', ['o_orderkey'], hashing.SPLIT)})
GROUP BY ALL
"""

SQL["q41_stratified_then_split_orders"] = f"""
WITH c AS (SELECT min(n) AS n FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderstatus)),
r AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY __h, o_orderkey) AS rn
      FROM {_hashed('orders', ['o_orderkey'], hashing.STRATA)}),
t AS (SELECT o_orderkey, o_orderstatus FROM r, c WHERE rn <= c.n)
SELECT side, o_orderstatus, count(*) AS rows
FROM (SELECT o_orderstatus, CAST(CASE WHEN __h < {int(0.8 * TWO32)} THEN 0 ELSE 1 END AS INTEGER) AS side
      FROM {_hashed('t', ['o_orderkey'], hashing.SPLIT)})
GROUP BY ALL
"""

SQL["q22_head_customer"] = "SELECT * FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 5"

_RANK_ORDERS = """r AS (SELECT *, row_number() OVER (ORDER BY __h, o_orderkey) - 1 AS rk FROM {src}),
nb AS (SELECT GREATEST(1, count(*) // """ + str(fixed.BATCH) + """) AS nb FROM orders)"""

SQL["q23a_batches_equal_orders"] = f"""
WITH {_RANK_ORDERS.format(src=_hashed('orders', ['o_orderkey'], hashing.BATCH))}
SELECT r.* EXCLUDE (__h, rk), rk % nb AS batch_id, rk // nb AS batch_pos FROM r, nb
"""

SQL["q23b_batches_fixed_orders"] = f"""
WITH {_RANK_ORDERS.format(src=_hashed('orders', ['o_orderkey'], hashing.BATCH))}
SELECT r.* EXCLUDE (__h, rk), rk // {fixed.BATCH} AS batch_id, rk % {fixed.BATCH} AS batch_pos FROM r
"""

SQL["q24_batch_profile_orders"] = f"""
WITH {_zscore_cte('orders', ['o_totalprice'])},
{_RANK_ORDERS.format(src=_hashed('orders', ['o_orderkey'], hashing.BATCH))}
SELECT rk % nb AS batch_id, count(*) AS rows, ROUND(avg({_z('o_totalprice')}), 6) AS mean_o_totalprice
FROM r, nb, s GROUP BY 1
"""

SQL["q34_stratified_lineitem"] = f"""
WITH c AS (SELECT min(n) AS n FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_linestatus)),
r AS (SELECT *, row_number() OVER (
        PARTITION BY l_linestatus
        ORDER BY __h, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                 l_discount, l_tax, l_returnflag, l_shipdate) AS rn
      FROM {_hashed('lineitem', ['l_orderkey', 'l_linenumber'], hashing.STRATA)})
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus
FROM r, c WHERE rn <= c.n
"""

# ---- scoring: features standardized with whole-table statistics
_LX = [f"x{i}" for i in range(len(fixed.LINE_FEATURES))]
_LINE_Z = f"""{_zscore_cte('lineitem', fixed.LINE_FEATURES)},
z AS (SELECT l_orderkey, l_linenumber, CAST({_STATUS.format(c='l_linestatus')} AS DOUBLE) AS y,
             {', '.join(f"{_z(c)} AS x{i}" for i, c in enumerate(fixed.LINE_FEATURES))}
      FROM lineitem, s)"""


def _relu_sql() -> str:
    w0, b0, w1, b1 = fixed.RELU_W0, fixed.RELU_B0, fixed.RELU_W1, fixed.RELU_B1
    hidden = [f"GREATEST(0.0, {_linear(_LX, [row[j] for row in w0], b0[j])}) AS h{j}" for j in range(len(b0))]
    out = _linear([f"h{j}" for j in range(len(b0))], [row[0] for row in w1], b1[0])
    return f"""WITH {_LINE_Z},
h AS (SELECT l_orderkey, l_linenumber, {', '.join(hidden)} FROM z)
SELECT l_orderkey, l_linenumber, ROUND({_sigmoid(out)}, 6) AS prediction FROM h"""


SQL["q25a_predict_relu_lineitem"] = _relu_sql()


def _embedding_net_sql() -> str:
    from ..operators.mlp import MLPSpec, init_model
    m = init_model(MLPSpec(64, ((16, 0.0),), 1), seed=SEED)
    xs = [f"CAST(embedding[{i + 1}] AS DOUBLE)" for i in range(64)]
    hidden = [f"GREATEST(0.0, {_linear(xs, list(m.weights[0][:, j]), m.biases[0][j])}) AS h{j}" for j in range(16)]
    out = _linear([f"h{j}" for j in range(16)], list(m.weights[1][:, 0]), m.biases[1][0])
    return f"""WITH h AS (SELECT vec_id, {', '.join(hidden)} FROM embeddings)
SELECT vec_id, ROUND({_sigmoid(out)}, 6) AS prediction FROM h"""


SQL["q25b_predict_udf_embeddings"] = _embedding_net_sql()


def _line_scored() -> str:
    w = [row[0] for row in fixed.LINE_SCORER_W]
    return f"""WITH {_LINE_Z},
sc AS (SELECT y, {_sigmoid(_linear(_LX, w, fixed.LINE_SCORER_B[0]))} AS p FROM z),
pc AS (SELECT y, {_pred_class('p')} AS yhat FROM sc)"""


def _metric_select(src: str, group: str = "") -> str:
    """accuracy / precision / recall / f1 rows from (y, yhat), optionally per group."""
    g = f"{group}, " if group else ""
    gb = f" GROUP BY {group}" if group else ""
    counts = f"""SELECT {g}count(*) AS n, count(*) FILTER (WHERE y = yhat) AS correct,
       count(*) FILTER (WHERE y = 0.0 AND yhat = 0.0) AS tp0, count(*) FILTER (WHERE yhat = 0.0) AS pred0,
       count(*) FILTER (WHERE y = 0.0) AS true0,
       count(*) FILTER (WHERE y = 1.0 AND yhat = 1.0) AS tp1, count(*) FILTER (WHERE yhat = 1.0) AS pred1,
       count(*) FILTER (WHERE y = 1.0) AS true1
FROM {src}{gb}"""
    rows = [f"SELECT {g}'accuracy' AS metric, CAST(NULL AS DOUBLE) AS class, "
            f"CASE WHEN n = 0 THEN 0.0 ELSE correct / n END AS value FROM cnt"]
    for k in (0, 1):
        p = f"(CASE WHEN pred{k} = 0 THEN 0.0 ELSE tp{k} / pred{k} END)"
        r = f"(CASE WHEN true{k} = 0 THEN 0.0 ELSE tp{k} / true{k} END)"
        f1 = f"(CASE WHEN {p} + {r} = 0 THEN 0.0 ELSE 2.0 * {p} * {r} / ({p} + {r}) END)"
        for name, v in (("precision", p), ("recall", r), ("f1", f1)):
            rows.append(f"SELECT {g}'{name}' AS metric, {float(k)} AS class, {v} AS value FROM cnt")
    return f"cnt AS ({counts}),\nmetric_rows AS ({' UNION ALL '.join(rows)})"


SQL["q26a_metrics_lineitem"] = f"""{_line_scored()},
{_metric_select('pc')}
SELECT metric, class, ROUND(value, 6) AS value FROM metric_rows
"""

SQL["q26b_confusion_lineitem"] = f"""{_line_scored()}
SELECT a.actual, p.predicted,
       ROUND((SELECT count(*) FROM pc WHERE y = a.actual AND yhat = p.predicted) / (SELECT count(*) FROM pc), 6)
         AS value
FROM (VALUES (0.0::DOUBLE), (1.0::DOUBLE)) a(actual), (VALUES (0.0::DOUBLE), (1.0::DOUBLE)) p(predicted)
"""

_ORDERS_SCORED = f"""{_zscore_cte('orders', fixed.ORDER_FEATURES)},
sc AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END AS y,
              {_sigmoid(_linear([_z(c) for c in fixed.ORDER_FEATURES], [r[0] for r in fixed.ORDER_SCORER_W],
                                fixed.ORDER_SCORER_B[0]))} AS p
       FROM orders, s)"""

_ORDERS_BATCHED = f"""{_ORDERS_SCORED},
{_RANK_ORDERS.format(src=_hashed('sc', ['o_orderkey'], hashing.BATCH))},
bt AS (SELECT rk % nb AS batch_id, y, p, {_pred_class('p')} AS yhat FROM r, nb)"""

SQL["q27_batch_metrics_orders"] = f"""WITH {_ORDERS_BATCHED},
{_metric_select('bt', 'batch_id')},
mse AS (SELECT batch_id, 'mse' AS metric, CAST(NULL AS DOUBLE) AS class, avg((p - y) * (p - y)) AS value
        FROM bt GROUP BY batch_id)
SELECT metric, class, ROUND(avg(value), 6) AS value
FROM (SELECT metric, class, value FROM metric_rows UNION ALL SELECT metric, class, value FROM mse)
GROUP BY metric, class
"""

# R1 (score_model) computes the same batch-averaged metrics in one plan.
SQL["q39_score_model_orders"] = SQL["q27_batch_metrics_orders"]


def _bce(y: str, p: str) -> str:
    q = f"LEAST(GREATEST({p}, 1e-7), 1.0 - 1e-7)"
    return f"(-({y} * ln({q}) + (1.0 - {y}) * ln(1.0 - {q})))"


SQL["q28_losses_orders"] = f"""WITH {_ORDERS_SCORED},
s2 AS (SELECT avg(o_totalprice) AS m_t, stddev_samp(o_totalprice) AS s_t,
              avg(o_custkey) AS m_c, stddev_samp(o_custkey) AS s_c FROM orders)
SELECT 'log_loss' AS metric, ROUND(avg({_bce('y', 'p')}), 6) AS value FROM sc
UNION ALL
SELECT 'log_loss_weighted', ROUND(avg(CASE WHEN y = 0.0 THEN 1.0 WHEN y = 1.0 THEN 2.0 ELSE 1.0 END
                                      * {_bce('y', 'p')}), 6) FROM sc
UNION ALL
SELECT 'mse', ROUND(avg((p - y) * (p - y)), 6) FROM sc
UNION ALL
SELECT 'mse_scaled_label',
       ROUND(avg(POWER(((o_custkey - m_c) / s_c) * 0.1 - (o_totalprice - m_t) / s_t, 2)), 6)
FROM orders, s2
"""


def _grad_sql() -> str:
    w = [row[0] for row in fixed.GRAD_START_W]
    p = _sigmoid(_linear(_LX, w, fixed.GRAD_START_B[0]))
    cw = "CASE WHEN y = 0.0 THEN 1.0 WHEN y = 1.0 THEN 2.0 ELSE 1.0 END"
    rows = [f"SELECT 0 AS layer, 'W' AS kind, {i} AS row, 0 AS col, ROUND(avg(w * (p - y) * x{i}), 6) AS gradient FROM g"
            for i in range(len(_LX))]
    rows.append("SELECT 0 AS layer, 'b' AS kind, 0 AS row, 0 AS col, ROUND(avg(w * (p - y)), 6) AS gradient FROM g")
    return f"""WITH {_LINE_Z},
g AS (SELECT *, {p} AS p, {cw} AS w FROM z)
""" + "\nUNION ALL ".join(rows)


SQL["q29_sync_gradient_lineitem"] = _grad_sql()

SQL["q33b_save_load_score_lineitem"] = SQL["q25a_predict_relu_lineitem"]


def _sync_ctes(rate: float) -> str:
    """Two full-batch steps: s1 and s2 hold each epoch's loss, accuracy and gradients."""
    cw = "CASE WHEN y = 0.0 THEN 1.0 WHEN y = 1.0 THEN 2.0 ELSE 1.0 END"
    grads = ", ".join([f"avg(w * (p - y) * x{i}) AS g{i}" for i in range(len(_LX))] + ["avg(w * (p - y)) AS gb"])
    sums = f"avg(w * {_bce('y', 'p')}) AS loss, avg(CASE WHEN {_pred_class('p')} = y THEN 1.0 ELSE 0.0 END) AS acc, {grads}"
    w, b = [row[0] for row in fixed.GRAD_START_W], fixed.GRAD_START_B[0]
    terms = " + ".join([f"({_num(b)} - {_num(rate)} * gb)"]
                       + [f"{x} * ({_num(w[i])} - {_num(rate)} * g{i})" for i, x in enumerate(_LX)])
    return f"""{_LINE_Z},
e1 AS (SELECT *, {_sigmoid(_linear(_LX, w, b))} AS p, {cw} AS w FROM z),
s1 AS (SELECT {sums} FROM e1),
e2 AS (SELECT y, w, {', '.join(_LX)}, {_sigmoid(terms)} AS p FROM (SELECT * EXCLUDE (p) FROM e1), s1),
s2 AS (SELECT {sums} FROM e2)"""


def _sync_sql(rate: float) -> str:
    rows = [f"SELECT {e} AS epoch, '{m}' AS metric, ROUND({m}, 6) AS value FROM s{e}" for e in (1, 2) for m in ("loss", "acc")]
    return f"WITH {_sync_ctes(rate)}\n" + "\nUNION ALL ".join(rows)


SQL["q30b_sync_history_lineitem"] = _sync_sql(0.5)
SQL["q42_loss_curve_lineitem"] = f"""WITH {_sync_ctes(0.5)}
SELECT 1 AS epoch, ROUND(loss, 6) AS loss, CAST(NULL AS DOUBLE) AS val_loss FROM s1
UNION ALL SELECT 2, ROUND(loss, 6), NULL FROM s2"""


def _evaluate_sql() -> str:
    p = _sigmoid(_linear(_LX, [row[0] for row in fixed.LINE_SCORER_W], fixed.LINE_SCORER_B[0]))
    rows = [f"SELECT dataset, '{m}' AS metric, {e} AS value FROM sc GROUP BY dataset" for m, e in (
        ("loss", f"ROUND(avg({_bce('y', 'p')}), 6)"),
        ("acc", f"ROUND(avg(CASE WHEN {_pred_class('p')} = y THEN 1.0 ELSE 0.0 END), 6)"),
        ("rows", "CAST(count(*) AS DOUBLE)"))]
    return f"""WITH {_LINE_Z},
sc AS (SELECT y, {p} AS p, CASE WHEN __h < {int(0.8 * TWO32)} THEN 'train' ELSE 'validation' END AS dataset
       FROM {_hashed('z', ['l_orderkey', 'l_linenumber'], hashing.SPLIT)})
""" + "\nUNION ALL ".join(rows)


SQL["q31b_evaluate_fixed_lineitem"] = _evaluate_sql()

SQL["q32_custom_metric_orders"] = f"""WITH {_ORDERS_BATCHED}
SELECT 'mean_absolute_error' AS metric, 0 AS idx, ROUND(avg(mae), 6) AS value
FROM (SELECT batch_id, avg(abs(y - p)) AS mae FROM bt GROUP BY batch_id)
"""


def _ensemble_sql() -> str:
    zs = [_z(c) for c in fixed.ORDER_FEATURES]
    scores = [_sigmoid(_linear(zs, [r[0] for r in w], b[0])) for w, b in fixed.ENSEMBLE]
    mean = f"(({' + '.join(scores)}) / {float(len(scores))})"
    return f"""WITH {_zscore_cte('orders', fixed.ORDER_FEATURES)}
SELECT o_orderkey, ROUND({mean}, 6) AS prediction FROM orders, s"""


SQL["q35_ensemble_orders"] = _ensemble_sql()

SQL["q37a_category_index_customer"] = """
SELECT c_mktsegment, count(*) AS "count", row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1 AS "index"
FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment
"""

SQL["q37b_index_categories_customer"] = """
WITH idx AS (
  SELECT c_mktsegment, row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1 AS i
  FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment)
SELECT c.c_custkey, CAST(idx.i AS DOUBLE) AS c_mktsegment_index
FROM customer c LEFT JOIN idx ON c.c_mktsegment = idx.c_mktsegment
"""

from . import oracle_fits  # noqa: E402, F401  (registers the SQL of the fits)
