"""SQL (DuckDB dialect) of the queries in ``catalog_fits.py``.

A fit by full-batch steps is written out step by step: CTE ``p<t>`` holds the
scores of every row at step t, ``s<t>`` the loss, the metrics and the gradients,
and a parameter at step t is its start less the rate times the gradients so far.
"""

from __future__ import annotations

from ..functions import hashing
from . import fixed
from .oracle import (_LX, _ORDERS_SCORED, _RANK_ORDERS, _STATUS, SQL, TWO32, _bce, _hashed, _metric_select,
                     _num, _pred_class, _sigmoid, _z, _zscore_cte)

KEYS = ["l_orderkey", "l_linenumber"]
CLASS_WEIGHT = "CASE WHEN y0 = 0.0 THEN 1.0 WHEN y0 = 1.0 THEN 2.0 ELSE 1.0 END"
RATE = 0.5


def _labelled(src: str = "lineitem", columns: list[str] | None = None) -> str:
    """Scaled features and three labels of lineitem."""
    flag = "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END"
    return f"""{_zscore_cte('lineitem', fixed.LINE_FEATURES)},
z AS (SELECT {', '.join([*KEYS, *(columns or [])])}, CAST({_STATUS.format(c='l_linestatus')} AS DOUBLE) AS y0,
             CAST(l_returnflag = 'R' AS DOUBLE) AS y1, {flag} AS flag,
             {', '.join(f"{_z(c)} AS x{i}" for i, c in enumerate(fixed.LINE_FEATURES))}
      FROM {src}, s)"""


def _param(start: float, gradients: list[str], rate: float) -> str:
    return "(" + " - ".join([_num(start), *[f"{_num(rate)} * {g}" for g in gradients]]) + ")"


def _activated(output: str, zs: list[str]) -> list[str]:
    if output == "sigmoid":
        return [_sigmoid(z) for z in zs]
    if output == "softmax":
        total = " + ".join(f"exp({z})" for z in zs)
        return [f"(exp({z}) / ({total}))" for z in zs]
    return zs


def _steps(src: str, w: list, b: list, rate: float, steps: int, output: str, loss: str, dz: list[str], metrics: dict[str, str],
           weight: str = "1.0", tag: str = "") -> str:
    """CTEs of a fit without hidden layer on ``src`` (y..., x...); ``loss``, ``dz`` and ``metrics`` over y and p."""
    k, n, parts = len(b), len(w), []
    for t in range(1, steps + 1):
        before = [f"s{tag}{u}" for u in range(1, t)]
        zs = [" + ".join([_param(b[j], [f"{s}.gb{j}" for s in before], rate)]
                         + [f"x{i} * {_param(w[i][j], [f'{s}.g{i}_{j}' for s in before], rate)}" for i in range(n)]) for j in range(k)]
        ps = ", ".join(f"{p} AS p{j}" for j, p in enumerate(_activated(output, [f"z{j}" for j in range(k)])))
        parts.append(f"p{tag}{t} AS (SELECT *, {ps} FROM (SELECT src.*, {', '.join(f'{z} AS z{j}' for j, z in enumerate(zs))} "
                     f"FROM {src} src{''.join(', ' + s for s in before)}))")
        sums = [f"avg(({weight}) * ({loss})) AS loss", *[f"{m} AS {name}" for name, m in metrics.items()]]
        sums += [f"avg(({weight}) * ({dz[j]}) * x{i}) AS g{i}_{j}" for i in range(n) for j in range(k)]
        sums += [f"avg(({weight}) * ({dz[j]})) AS gb{j}" for j in range(k)]
        parts.append(f"s{tag}{t} AS (SELECT {', '.join(sums)} FROM p{tag}{t})")
    return ",\n".join(parts)


def _rows(steps: int, names: dict[str, str], tag: str = "", extra: str = "") -> str:
    return "\nUNION ALL ".join(f"SELECT {extra}{t} AS epoch, '{metric}' AS metric, ROUND({column}, 6) AS value FROM s{tag}{t}"
                               for t in range(1, steps + 1) for metric, column in names.items())


def _hit(j: int) -> str:
    return f"CAST({_pred_class(f'p{j}')} = y{j} AS DOUBLE)"


_two = _steps("z", fixed.TWO_OUTPUTS_W, fixed.TWO_OUTPUTS_B, RATE, 2, "sigmoid",
              f"({_bce('y0', 'p0')} + {_bce('y1', 'p1')}) / 2", ["(p0 - y0) / 2", "(p1 - y1) / 2"],
              {"acc": f"avg(({_hit(0)} + {_hit(1)}) / 2)", "acc1": f"avg({_hit(1)})", "mse": "avg(((p0 - y0)**2 + (p1 - y1)**2) / 2)",
               "recall0": f"avg({_pred_class('p0')}) FILTER (WHERE y0 = 1.0)"})
SQL["q43_two_outputs_history_lineitem"] = f"WITH {_labelled()},\n{_two}\n" + _rows(
    2, {"loss": "loss", "acc": "acc", "acc[1]": "acc1", "mse": "mse", "recall[0]": "recall0"})

_first = _steps("z", fixed.TWO_OUTPUTS_W, fixed.TWO_OUTPUTS_B, RATE, 1, "sigmoid", "0.0", ["0.0", "0.0"], {})
SQL["q44_predicted_actual_lineitem"] = f"WITH {_labelled()},\n{_first}\n" + "\nUNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, {j} AS output, y{j} AS actual, ROUND(p{j}, 6) AS prediction FROM p1" for j in (0, 1))

_mse = _steps("z", fixed.GRAD_START_W, fixed.GRAD_START_B, 0.1, 2, "linear", "(p0 - y0)**2", ["2 * (p0 - y0)"],
              {"mae": "avg(abs(p0 - y0))", "r2": "1 - sum((p0 - y0)**2) / (sum(y0 * y0) - sum(y0) * sum(y0) / count(*))"}, CLASS_WEIGHT)
SQL["q45_mse_history_lineitem"] = f"WITH {_labelled()},\n{_mse}\n" + _rows(2, {"loss": "loss", "mae": "mae", "r2": "r2"})

_is = [f"CAST(flag = {j} AS DOUBLE)" for j in range(3)]
_soft = _steps("z", fixed.CLASSES_W, fixed.CLASSES_B, RATE, 2, "softmax", "-ln(CASE flag WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END)",
               [f"p{j} - {y}" for j, y in enumerate(_is)],
               {"mse": f"avg(({' + '.join(f'(p{j} - {y})**2' for j, y in enumerate(_is))}) / 3)"})
SQL["q46_softmax_history_lineitem"] = f"WITH {_labelled()},\n{_soft}\n" + _rows(2, {"loss": "loss", "mse": "mse"})

SQL["q47_resumed_history_lineitem"] = SQL["q30b_sync_history_lineitem"]
SQL["q33c_stored_history_lineitem"] = SQL["q30b_sync_history_lineitem"]


def _logistic(src: str, steps: int, w: list, b: list, tag: str = "", weight: str = "1.0") -> str:
    return _steps(src, w, b, RATE, steps, "sigmoid", _bce("y0", "p0"), ["p0 - y0"],
                  {"acc": f"avg({_hit(0)})", "mse": "avg((p0 - y0)**2)"}, weight, tag)


def _ensemble_sql() -> str:
    ctes, rows = [_labelled(columns=["l_partkey", "l_suppkey", "l_returnflag"]),
                  "c AS (SELECT min(n) AS n FROM (SELECT count(*) AS n FROM z GROUP BY y0))"], []
    starts = [(fixed.GRAD_START_W, fixed.GRAD_START_B), (fixed.LINE_SCORER_W, fixed.LINE_SCORER_B)]
    for k, (w, b) in enumerate(starts):
        hashed = _hashed("z", KEYS, hashing.STRATA, seed=fixed.SEED + k)
        ctes.append(f"""t{k} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY y0 ORDER BY __h, l_orderkey, l_linenumber,
          l_partkey, l_suppkey, {', '.join(_LX)}, l_returnflag) AS rn FROM {hashed}), c WHERE rn <= c.n)""")
        ctes.append(_logistic(f"t{k}", 2, w, b, f"m{k}_"))
        rows.append(_rows(2, {"loss": "loss", "acc": "acc"}, f"m{k}_", f"{k} AS member, "))
    return "WITH " + ",\n".join(ctes) + "\n" + "\nUNION ALL ".join(rows)


SQL["q48_ensemble_history_lineitem"] = _ensemble_sql()


def _hidden_sql(steps: int = 2) -> str:
    w0, b0, w1, b1, parts = fixed.RELU_W0, fixed.RELU_B0, fixed.RELU_W1, fixed.RELU_B1, []
    n, m = len(w0), len(b0)
    for t in range(1, steps + 1):
        before = [f"s{u}" for u in range(1, t)]
        now = {f"w{i}_{j}": _param(w0[i][j], [f"{s}.gw{i}_{j}" for s in before], RATE) for i in range(n) for j in range(m)}
        now |= {f"b{j}": _param(b0[j], [f"{s}.gb{j}" for s in before], RATE) for j in range(m)}
        now |= {f"v{j}": _param(w1[j][0], [f"{s}.gv{j}" for s in before], RATE) for j in range(m)}
        now["c"] = _param(b1[0], [f"{s}.gc" for s in before], RATE)
        parts.append(f"q{t} AS (SELECT {', '.join(f'{e} AS {name}' for name, e in now.items())}"
                     f"{' FROM ' + ', '.join(before) if before else ''})")
        pre = [" + ".join([f"b{j}", *[f"x{i} * w{i}_{j}" for i in range(n)]]) for j in range(m)]
        score = _sigmoid(" + ".join(["c", *[f"greatest(0.0, a{j}) * v{j}" for j in range(m)]]))
        parts.append(f"e{t} AS (SELECT *, {score} AS p FROM (SELECT z.*, q.*, {', '.join(f'{a} AS a{j}' for j, a in enumerate(pre))} "
                     f"FROM z, q{t} q))")
        penalty = " + ".join(f"w{i}_{j} * w{i}_{j}" for i in range(n) for j in range(m))
        sums = [f"avg({_bce('y0', 'p')}) + {fixed.HIDDEN_L2} * any_value({penalty}) AS loss",
                f"avg(CAST({_pred_class('p')} = y0 AS DOUBLE)) AS acc", "avg(p - y0) AS gc"]
        sums += [f"avg((p - y0) * greatest(0.0, a{j})) AS gv{j}" for j in range(m)]
        back = [f"((p - y0) * v{j} * CAST(a{j} > 0 AS DOUBLE))" for j in range(m)]
        sums += [f"avg({back[j]}) AS gb{j}" for j in range(m)]
        sums += [f"avg({back[j]} * x{i}) + {2 * fixed.HIDDEN_L2} * any_value(w{i}_{j}) AS gw{i}_{j}" for i in range(n) for j in range(m)]
        parts.append(f"s{t} AS (SELECT {', '.join(sums)} FROM e{t})")
    return f"WITH {_labelled()},\n" + ",\n".join(parts) + "\n" + _rows(steps, {"loss": "loss", "acc": "acc"})


SQL["q49_hidden_l2_history_lineitem"] = _hidden_sql()


def _workflow_ctes(steps: int) -> str:
    """The split, both sides scaled by the training side's statistics, the steps, and the validation after each."""
    names = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in fixed.LINE_FEATURES)
    parts = [f"h AS (SELECT *, __h < {int(0.8 * TWO32)} AS is_train FROM {_hashed('lineitem', KEYS, hashing.SPLIT)})",
             f"s AS (SELECT {names} FROM h WHERE is_train)",
             f"""z AS (SELECT l_orderkey, l_linenumber, is_train, CAST({_STATUS.format(c='l_linestatus')} AS DOUBLE) AS y0,
             {', '.join(f"{_z(c)} AS x{i}" for i, c in enumerate(fixed.LINE_FEATURES))} FROM h, s)""",
             "tr AS (SELECT * FROM z WHERE is_train)",
             _logistic("tr", steps, fixed.GRAD_START_W, fixed.GRAD_START_B, weight=CLASS_WEIGHT)]
    w, b = fixed.GRAD_START_W, fixed.GRAD_START_B
    for t in range(1, steps + 1):
        before = [f"s{u}" for u in range(1, t + 1)]
        score = " + ".join([_param(b[0], [f"{s}.gb0" for s in before], RATE)]
                           + [f"x{i} * {_param(w[i][0], [f'{s}.g{i}_0' for s in before], RATE)}" for i in range(len(w))])
        parts.append(f"after{t} AS (SELECT z.*, {_sigmoid(score)} AS p0 FROM z, {', '.join(before)})")
        parts.append(f"m{t} AS (SELECT is_train, avg({_bce('y0', 'p0')}) AS loss, avg({_hit(0)}) AS acc, "
                     f"avg((p0 - y0)**2) AS mse, CAST(count(*) AS DOUBLE) AS rows FROM after{t} GROUP BY is_train)")
    return ",\n".join(parts)


def _workflow_sql(steps: int) -> str:
    names = {"loss": "loss", "acc": "acc", "mse": "mse"}
    rows = [_rows(steps, names)]
    rows += [f"SELECT {t} AS epoch, 'val_{m}' AS metric, ROUND({m}, 6) AS value FROM m{t} WHERE NOT is_train"
             for t in range(1, steps + 1) for m in names]
    best = "SELECT 1 AS t, loss FROM m1 WHERE NOT is_train" + "".join(
        f" UNION ALL SELECT {t}, loss FROM m{t} WHERE NOT is_train" for t in range(2, steps + 1))
    rows += [f"SELECT 0 AS epoch, CASE WHEN is_train THEN 'train_' ELSE 'validation_' END || '{m}' AS metric, ROUND({m}, 6) AS value "
             f"FROM m{t} WHERE (SELECT arg_min(t, loss) FROM best) = {t}" for t in range(1, steps + 1) for m in [*names, "rows"]]
    return f"WITH {_workflow_ctes(steps)},\nbest AS ({best})\n" + "\nUNION ALL ".join(rows)


SQL["q38b_sync_workflow_lineitem"] = _workflow_sql(2)
SQL["q50_stored_workflow_lineitem"] = (f"WITH {_workflow_ctes(1)}\n"
                                       "SELECT l_orderkey, l_linenumber, ROUND(p0, 6) AS prediction FROM after1")

# ---- scores

SQL["q26c_pooled_score_orders"] = f"""WITH {_ORDERS_SCORED},
pc AS (SELECT y, p, {_pred_class('p')} AS yhat FROM sc),
{_metric_select('pc')}
SELECT metric, class, ROUND(value, 6) AS value FROM metric_rows WHERE metric IN ('accuracy', 'f1')
UNION ALL SELECT 'mse', NULL, ROUND(avg((p - y) * (p - y)), 6) FROM sc
UNION ALL SELECT 'mae', NULL, ROUND(avg(abs(p - y)), 6) FROM sc
UNION ALL SELECT 'log_loss', NULL, ROUND(avg({_bce('y', 'p')}), 6) FROM sc
UNION ALL SELECT 'share_above_half', NULL, ROUND(avg(CAST(p > 0.5 AS DOUBLE)), 6) FROM sc
"""

_REGRESSION = f"""{_zscore_cte('orders', ['o_custkey', 'o_totalprice'])},
sc AS (SELECT o_orderkey, {_z('o_totalprice')} AS y,
              {_num(fixed.ORDER_LINEAR_B[0])} + {_z('o_custkey')} * {_num(fixed.ORDER_LINEAR_W[0][0])} AS p,
              o_totalprice, s.m_o_totalprice AS m, s.s_o_totalprice AS sd FROM orders, s)"""

SQL["q39b_score_regression_orders"] = f"""WITH {_REGRESSION},
{_RANK_ORDERS.format(src=_hashed('sc', ['o_orderkey'], hashing.BATCH))},
b AS (SELECT rk % nb AS batch_id, avg((p - y) * (p - y)) AS mse, avg(abs(p - y)) AS mae, max(abs(y - p)) AS worst,
             avg(p) AS mean_p, avg(CAST(p > 0.5 AS DOUBLE)) AS above FROM r, nb GROUP BY 1)
SELECT 'mse' AS metric, CAST(NULL AS DOUBLE) AS class, ROUND(avg(mse), 6) AS value FROM b
UNION ALL SELECT 'mae', NULL, ROUND(avg(mae), 6) FROM b
UNION ALL SELECT 'worst_error', NULL, ROUND(avg(worst), 6) FROM b
UNION ALL SELECT 'mean_and_error', 0.0, ROUND(avg(mean_p), 6) FROM b
UNION ALL SELECT 'mean_and_error', 1.0, ROUND(avg(mae), 6) FROM b
UNION ALL SELECT 'share_above_half', NULL, ROUND(avg(above), 6) FROM b
"""

SQL["q39c_score_original_units_orders"] = f"""WITH {_REGRESSION}
SELECT 'mse' AS metric, CAST(NULL AS DOUBLE) AS class, ROUND(avg((p * sd + m - o_totalprice)**2), 2) AS value FROM sc
UNION ALL SELECT 'mae', NULL, ROUND(avg(abs(p * sd + m - o_totalprice)), 2) FROM sc
"""

# ---- missing values: null and NaN alike

_MISSING = """o AS (SELECT * REPLACE (CASE WHEN o_orderpriority NOT IN ('5-LOW', '3-MEDIUM') THEN o_totalprice END AS o_totalprice)
              FROM orders)"""
_INFINITE = """o AS (SELECT * REPLACE (CASE WHEN o_orderpriority IN ('5-LOW', '3-MEDIUM') THEN NULL WHEN o_orderstatus = 'P'
                       THEN 'infinity'::DOUBLE ELSE o_totalprice END AS o_totalprice) FROM orders)"""


def _summary_rows(table: str, numbers: list[str], strings: list[str], stats: tuple[str, ...], text: bool) -> str:
    rows = []
    for c in [*numbers, *strings]:
        x = f"TRY_CAST({c} AS DOUBLE)" if c in strings else f"CAST({c} AS DOUBLE)"
        values = {"count": f"CAST(count({c}) AS DOUBLE)", "mean": f"avg({x})", "stddev": f"stddev_samp({x})", "min": f"min({x})",
                  "25%": f"quantile_disc({x}, 0.25)", "50%": f"quantile_disc({x}, 0.5)", "75%": f"quantile_disc({x}, 0.75)",
                  "max": f"max({x})"}
        for stat in stats:
            is_word = c in strings and stat in ("min", "max")
            value = "CAST(NULL AS DOUBLE)" if is_word else f"ROUND({values[stat]}, 6)"
            word = f", {f'{stat}({c})' if is_word else 'CAST(NULL AS VARCHAR)'} AS text" if text else ""
            rows.append(f"SELECT '{c}' AS column_name, '{stat}' AS statistic, {value} AS value{word} FROM {table}")
    return "\nUNION ALL ".join(rows)


_ALL = ("count", "mean", "stddev", "min", "25%", "50%", "75%", "max")
SQL["q01b_summary_customer"] = _summary_rows("customer", ["c_custkey", "c_nationkey", "c_acctbal"], ["c_name", "c_mktsegment"], _ALL, True)
SQL["q01c_summary_missing_orders"] = f"WITH {_MISSING}\n" + _summary_rows("o", ["o_totalprice", "o_custkey"], [], _ALL, False)
SQL["q01d_summary_infinite_orders"] = f"WITH {_INFINITE}\n" + _summary_rows(
    "o", ["o_totalprice"], [], tuple(s for s in _ALL if s not in ("mean", "stddev")), False)
SQL["q02b_describe_missing_orders"] = f"WITH {_MISSING}\n" + _summary_rows(
    "o", ["o_totalprice"], ["o_orderstatus"], ("count", "mean", "stddev", "min", "max"), True)


def _profile_sql(label: str, src: str) -> str:
    return f"""mm AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM {src}),
v AS (SELECT {label}, (o_totalprice - lo) / (hi - lo) AS value FROM {src}, mm)
SELECT {label}, 'o_totalprice' AS feature, count(value) AS rows, ROUND(avg(value), 6) AS mean,
       ROUND(quantile_disc(value, 0.25), 6) AS q25, ROUND(quantile_disc(value, 0.5), 6) AS q50,
       ROUND(quantile_disc(value, 0.75), 6) AS q75
FROM v GROUP BY {label}"""


SQL["q09c_label_profile_missing_orders"] = f"WITH {_MISSING},\n{_profile_sql('o_orderpriority', 'o')}"
SQL["q09d_label_profile_keys_orders"] = f"WITH {_profile_sql('o_orderkey', 'orders')}"

_SCORED_MISSING = f"""{_ORDERS_SCORED},
missing AS (SELECT y, p, {_pred_class('p')} AS yhat FROM sc JOIN orders USING (o_orderkey)
            WHERE o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P')"""

SQL["q26d_metrics_missing_orders"] = f"""WITH {_SCORED_MISSING},
{_metric_select('missing')}
SELECT metric, class, ROUND(value, 6) AS value FROM metric_rows
UNION ALL SELECT 'mse', NULL, ROUND(avg((p - y) * (p - y)), 6) FROM missing
UNION ALL SELECT 'unscored', NULL, CAST((SELECT count(*) FROM orders) - count(*) AS DOUBLE) FROM missing
"""

SQL["q26e_confusion_missing_orders"] = f"""WITH {_SCORED_MISSING}
SELECT a.c AS actual, b.c AS predicted,
       ROUND((SELECT count(*) FROM missing WHERE y = a.c AND yhat = b.c) / (SELECT count(*) FROM missing), 6) AS value
FROM (VALUES (0.0::DOUBLE), (1.0::DOUBLE)) a(c), (VALUES (0.0::DOUBLE), (1.0::DOUBLE)) b(c)
"""


def _classes_sql() -> str:
    rows = ["SELECT 'accuracy' AS metric, CAST(NULL AS DOUBLE) AS class, ROUND(avg(CAST(y = yhat AS DOUBLE)), 6) AS value FROM pc"]
    for c in (0.0, 1.0, 2.0):
        tp = f"count(*) FILTER (WHERE y = {c} AND yhat = {c})"
        pred, true = f"count(*) FILTER (WHERE yhat = {c})", f"count(*) FILTER (WHERE y = {c})"
        rows += [f"SELECT 'precision', {c}, ROUND({tp} / {pred}, 6) FROM pc", f"SELECT 'recall', {c}, ROUND({tp} / {true}, 6) FROM pc",
                 f"SELECT 'f1', {c}, ROUND(2 * {tp} / ({pred} + {true}), 6) FROM pc"]
    return ("WITH pc AS (SELECT round_even(l_tax * 25, 0) + 0.0 AS y, round_even(LEAST(GREATEST(l_discount * 25, 0.0), 2.0), 0) + 0.0 "
            "AS yhat FROM lineitem)\n" + "\nUNION ALL ".join(rows))


SQL["q26f_classes_lineitem"] = _classes_sql()

# ---- columns and tables

SQL["q14c_non_numeric_part"] = "SELECT p_name, p_brand, p_type FROM part"
SQL["q14d_feature_columns_part"] = "SELECT p_partkey, p_retailprice FROM part"
SQL["q00b_get_table_customer"] = "SELECT * FROM customer"
SQL["q22b_take_nation"] = "SELECT * FROM nation"
