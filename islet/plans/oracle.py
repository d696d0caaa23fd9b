"""DuckDB SQL equivalents of the catalogue queries (the correctness oracle).

Same column names as the Spark side; computed doubles rounded to 6 decimals;
DuckDB's HUGEINT sums and window counters cast to BIGINT.
"""

from __future__ import annotations

import math

from islet.functions.scalars import DAY_QUARTER_EDGES, DAY_QUARTER_LABELS, LENGTH_TIERS, TIER_ORDINAL
from islet.plans.catalogue import (SPEARMAN_COLS, TWO_ALPHAS, DESCRIBE_COLS, STATUS_LABELS, CUTOFF, EVENT_GAP, EVENT_PHASES, EVENT_TYPES, M1, M2,
                                   PART_CLASSES, PART_NAME_PATTERNS, PRIORITY_ORDER, SHIFT_DATE)
from islet.operators.rollup import snake


def _q(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def _in(vals) -> str:
    return ", ".join(_q(v) if isinstance(v, str) else str(v) for v in vals)


def islands_cte(keys: list[str]) -> str:
    k = ", ".join(keys)
    return f"""
b AS (SELECT *, CAST(FLOOR(value) AS BIGINT) AS dur,
             ts + to_minutes(CAST(FLOOR(value) AS BIGINT)) AS ts_end FROM events),
g AS (SELECT *, DATEDIFF('minute', LAG(ts_end) OVER (PARTITION BY {k} ORDER BY ts, event_id), ts) AS gap FROM b),
s AS (SELECT *, CAST(SUM(CASE WHEN gap IS NULL OR gap > {EVENT_GAP} THEN 1 ELSE 0 END)
                     OVER (PARTITION BY {k} ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS sid
      FROM g)"""


def day_quarter_sql(hour: str) -> str:
    parts = [f"WHEN {hour} > {lo} AND {hour} <= {hi} THEN {_q(lab)}"
             for lo, hi, lab in zip(DAY_QUARTER_EDGES[:-1], DAY_QUARTER_EDGES[1:], DAY_QUARTER_LABELS)]
    return "CASE " + " ".join(parts) + " END"


def classify_sql(col: str, mapping: dict, default: str | None) -> str:
    parts = [f"WHEN {col} IN ({_in(v)}) THEN {_q(k)}" for k, v in mapping.items()]
    tail = f" ELSE {_q(default)}" if default is not None else ""
    return "CASE " + " ".join(parts) + tail + " END"


def rollup_cols(key: str, cat: str, phases: dict, categories: list, descriptive: list = ()) -> list[str]:
    """Select list of the entity roll-up over a table p(key, cat, ph, d, duration)."""
    creation = _in(["Pre-Processing", "Processing"])

    def hrs(cond):
        return f"ROUND(SUM(CASE WHEN {cond} THEN duration ELSE 0 END) / 60.0, 2)"

    def span(a, b):
        return f"CAST(DATEDIFF('day', {a}, {b}) + 1 AS INTEGER)"

    cols = [key] + [f"MIN({c}) AS {c}" for c in descriptive]
    cols += ["ROUND(SUM(duration) / 60.0, 2) AS total_hours", "MIN(d) AS date_first",
             "MAX(d) AS date_last", f"{span('MIN(d)', 'MAX(d)')} AS total_day_span",
             "COUNT(DISTINCT d) AS active_days_worked", f"{hrs(f'ph IN ({creation})')} AS hours_creation",
             f"{span(f'MIN(CASE WHEN ph IN ({creation}) THEN d END)', f'MAX(CASE WHEN ph IN ({creation}) THEN d END)')}"
             " AS creation_day_span"]
    cols += [f"{hrs(f'{cat} = {_q(c)}')} AS hours_{snake(c)}" for c in categories]
    cols += [f"{hrs(f'ph = {_q(p)}')} AS hours_{snake(p)}" for p in list(phases) + ["Uncategorised"]]
    for p in phases:
        w = f"CASE WHEN ph = {_q(p)} THEN d END"
        cols += [f"MIN({w}) AS {snake(p)}_date_first", f"MAX({w}) AS {snake(p)}_date_last",
                 f"{span(f'MIN({w})', f'MAX({w})')} AS {snake(p)}_total_day_span",
                 f"COUNT(DISTINCT {w}) AS {snake(p)}_active_days"]
    return cols


def rollup_sql() -> str:
    ph = classify_sql("event_type", EVENT_PHASES, "Uncategorised")
    cols = rollup_cols("user_id", "event_type", EVENT_PHASES, EVENT_TYPES)
    return f"""WITH {islands_cte(['user_id', 'event_type'])},
sess AS (SELECT user_id, event_type, sid, MIN(CAST(ts AS DATE)) AS d, SUM(dur) AS duration
         FROM s GROUP BY user_id, event_type, sid),
p AS (SELECT *, {ph} AS ph FROM sess)
SELECT {', '.join(cols)} FROM p GROUP BY user_id"""


def tier_sql(col: str) -> tuple[str, str]:
    lab = classify_sql(col, LENGTH_TIERS, None)
    ordn = "CASE " + " ".join(f"WHEN {col} IN ({_in(v)}) THEN {TIER_ORDINAL[k]}" for k, v in LENGTH_TIERS.items()) + " END"
    return lab, ordn


def _like_sql(col: str) -> str:
    norm = f"TRIM(LOWER({col}))"
    return "CASE " + " ".join(f"WHEN {norm} LIKE {_q(p)} THEN {_q(l)}" for p, l in PART_NAME_PATTERNS) + f" ELSE TRIM({col}) END"


ORD = "ORDER BY o_orderdate, o_orderkey"

FEAT = f"""f AS (SELECT *,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 2 WHEN o_orderpriority = '3-MEDIUM' THEN 1 ELSE 0 END AS f_tier,
  CAST(o_orderstatus = 'O' AS INTEGER) AS f_new, CAST(o_orderstatus = 'F' AS INTEGER) AS f_depth,
  CAST(o_totalprice > 250000 AS INTEGER) AS f_delivery, o_totalprice / 10000.0 AS y,
  CASE WHEN CAST(o_orderdate AS DATE) <= DATE '{CUTOFF}' THEN 'train' ELSE 'post' END AS era
  FROM orders)"""


# the errors e(outer_, p, alpha, rmse) of ridge on two features over the splits s, by the closed 2 x 2 solution
RIDGE_TWO = f"""g AS (SELECT s.outer_, s.p, s.a, s.b, AVG(f_tier) AS ma, AVG(f_delivery) AS mb, AVG(y) AS my, COUNT(*) AS n_train, VAR_POP(f_tier) * COUNT(*) AS aa, VAR_POP(f_delivery) * COUNT(*) AS bb,
  COVAR_POP(f_tier, f_delivery) * COUNT(*) AS ab, COVAR_POP(f_tier, y) * COUNT(*) AS ay, COVAR_POP(f_delivery, y) * COUNT(*) AS bxy FROM s JOIN x ON x.j < s.a GROUP BY ALL),
al AS (SELECT CAST(unnest({TWO_ALPHAS}) AS DOUBLE) AS alpha),
w AS (SELECT *, ((bb + alpha) * ay - ab * bxy) / ((aa + alpha) * (bb + alpha) - ab * ab) AS wa, ((aa + alpha) * bxy - ab * ay) / ((aa + alpha) * (bb + alpha) - ab * ab) AS wb FROM g, al),
e AS (SELECT outer_, p, alpha, n_train, COUNT(*) AS n_test, SQRT(AVG(POWER(x.y - (my - wa * ma - wb * mb) - wa * f_tier - wb * f_delivery, 2))) AS rmse FROM w JOIN x ON x.j >= w.a AND x.j < w.b GROUP BY ALL)"""


# the tree models' features, the prime of the draws and the steps of a Poisson(1) distribution
TREE_FEATS = ["f_tier", "f_new", "f_depth", "f_delivery", "f_odd", "f_late"]
TREE = f"{FEAT}, tf AS (SELECT *, CAST(o_custkey % 2 AS INTEGER) AS f_odd, CAST(month(o_orderdate) > 6 AS INTEGER) AS f_late FROM f)"
DRAW_PRIME = 2**31 - 1
BOOTSTRAP_STEPS = [int(sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) * DRAW_PRIME) for k in range(12)]


def _lin(m) -> str:
    """The linear score in DOUBLE arithmetic (DuckDB would keep decimal
    literals exact), summed in the same order as the Spark expression."""
    terms = [f"CAST({m['intercept']!r} AS DOUBLE)"]
    terms += [f"CAST({f} AS DOUBLE) * CAST({w!r} AS DOUBLE)" for f, w in m["coefficients"].items()]
    return " + ".join(terms)


SCORED = f"""{FEAT},
sc AS (SELECT *, {_lin(M1)} AS pred_m1, y - ({_lin(M1)}) AS resid_m1,
              {_lin(M2)} AS pred_m2, y - ({_lin(M2)}) AS resid_m2 FROM f)"""

DRIFT = f"""{SCORED},
pp AS (SELECT *, ROW_NUMBER() OVER ({ORD}) AS step FROM sc WHERE era = 'post'),
dr AS (SELECT step, o_orderkey,
   CASE WHEN COUNT(resid_m1) OVER w >= 3 THEN AVG(resid_m1) OVER w END AS rm,
   CASE WHEN COUNT(resid_m1) OVER w >= 3 THEN SQRT(AVG(resid_m1 * resid_m1) OVER w) END AS rr
   FROM pp WINDOW w AS (ORDER BY step ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)),
d2 AS (SELECT * FROM dr WHERE rm IS NOT NULL)"""

SPLIT = f"""sp AS (SELECT *, ROW_NUMBER() OVER ({ORD}) - 1 AS idx, COUNT(*) OVER () AS n FROM orders),
sp2 AS (SELECT *, CASE WHEN idx >= n - FLOOR(n * 0.25) THEN 'test' ELSE 'train' END AS role FROM sp)"""

EVH = f"""eh AS (SELECT *, HOUR(ts) AS hour, {day_quarter_sql('HOUR(ts)')} AS day_quarter FROM events)"""

CHI_CELLS = f"""{EVH},
lv AS (SELECT event_type, UNNEST((SELECT list(DISTINCT day_quarter) FROM eh)) AS day_quarter
       FROM (SELECT DISTINCT event_type FROM eh)),
cnt AS (SELECT event_type, day_quarter, COUNT(*) AS o FROM eh GROUP BY ALL),
cells AS (SELECT lv.event_type, lv.day_quarter, COALESCE(cnt.o, 0) AS observed FROM lv LEFT JOIN cnt USING (event_type, day_quarter)),
ex AS (SELECT *, SUM(observed) OVER (PARTITION BY event_type) * SUM(observed) OVER (PARTITION BY day_quarter)
                 / SUM(observed) OVER () AS expected FROM cells)"""

DL = "dl AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"

_tier_lab, _tier_ord = tier_sql("p_size")

SQL: dict[str, str] = {
    "sessionize_gap": f"""WITH {islands_cte(['user_id'])}
SELECT user_id, sid AS session_id, COUNT(*) AS sessions_combined, MIN(ts) AS session_start,
       MAX(ts_end) AS session_end, CAST(SUM(dur) AS BIGINT) AS total_minutes, MIN(event_id) AS first_event_id
FROM s GROUP BY user_id, sid""",
    "islands_rows": f"""WITH {islands_cte(['user_id'])}
SELECT event_id, user_id, ts, ts_end AS ts_end_computed, gap AS gap_from_prev_minutes, sid AS island_id FROM s""",
    "sessionize_last_start": f"""WITH {islands_cte(['user_id', 'event_type'])}
SELECT user_id, event_type, sid AS island_id, COUNT(*) AS sessions_combined, MIN(CAST(ts AS DATE)) AS date,
       MIN(strftime(ts, '%Y_%m')) AS month_year, MIN(strftime(ts, '%H:%M:%S')) AS time_start,
       MAX(strftime(ts, '%H:%M:%S')) AS time_end, CAST(SUM(dur) AS BIGINT) AS duration
FROM s GROUP BY user_id, event_type, sid""",
    "island_size_hist": f"""WITH {islands_cte(['user_id'])},
sizes AS (SELECT user_id, sid, COUNT(*) AS sc FROM s GROUP BY user_id, sid)
SELECT sc AS sessions_combined, COUNT(*) AS num_groups, CAST(SUM(sc) AS BIGINT) AS total_raw_sessions,
       ROUND(SUM(sc) * 100.0 / (SELECT COUNT(*) FROM events), 6) AS pct_of_total_sessions
FROM sizes GROUP BY sc""",
    "topk_islands_rows": f"""WITH {islands_cte(['user_id'])},
grp AS (SELECT user_id, sid, COUNT(*) AS sc FROM s GROUP BY user_id, sid HAVING COUNT(*) >= 2
        ORDER BY sc DESC, user_id, sid LIMIT 10)
SELECT s.user_id, s.sid AS island_id, grp.sc AS sessions_combined, s.event_id, s.ts, s.gap AS gap_from_prev_minutes
FROM s JOIN grp ON s.user_id = grp.user_id AND s.sid = grp.sid""",
    "entity_rollup": rollup_sql(),
    "category_case": f"SELECT p_partkey, p_type, {classify_sql('p_type', PART_CLASSES, 'Other')} AS p_class FROM part",
    "like_normalise": f"SELECT p_partkey, {_like_sql('p_name')} AS name_norm FROM part",
    "tier_encode": f"SELECT p_partkey, p_size, {_tier_lab} AS length_tier, {_tier_ord} AS length_tier_ord FROM part",
    "hash_key": "SELECT p_partkey, md5(p_name || '|' || p_brand || '|' || p_type) AS key_hash FROM part",
    "time_12h_roundtrip": "SELECT event_id, strftime(ts, '%-I:%M:%S %p') AS t12, strftime(ts, '%H:%M:%S') AS t24 FROM events",
    "duration_repair": """SELECT event_id, CAST(FLOOR(value) AS BIGINT) - 50 AS raw,
  CASE WHEN CAST(FLOOR(value) AS BIGINT) - 50 < 0 THEN CAST(FLOOR(value) AS BIGINT) - 50 + 1440
       ELSE CAST(FLOOR(value) AS BIGINT) - 50 END AS duration FROM events""",
    "raw_filter_then_replace": """SELECT o_orderkey, lower(trim(substr(o_orderpriority, 3))) AS o_orderpriority, o_orderstatus
FROM orders WHERE o_orderpriority NOT IN ('5-LOW') AND trim(o_orderstatus) != 'P'""",
    "forward_fill": f"""WITH {DL}
SELECT doc_id, quality, LAST_VALUE(quality IGNORE NULLS) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS quality_filled FROM dl""",
    "rolling_mean": f"""SELECT o_orderkey, ROW_NUMBER() OVER ({ORD}) - 1 AS idx,
  ROUND(CASE WHEN COUNT(o_totalprice) OVER w >= 3 THEN AVG(o_totalprice / 1000.0) OVER w END, 6) AS rolling_mean
FROM orders WINDOW w AS ({ORD} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
    "rolling_rmse": f"""SELECT o_orderkey, ROW_NUMBER() OVER ({ORD}) - 1 AS idx,
  ROUND(CASE WHEN COUNT(o_totalprice) OVER w >= 3 THEN SQRT(AVG((o_totalprice / 1000.0) * (o_totalprice / 1000.0)) OVER w) END, 6) AS rolling_rmse
FROM orders WINDOW w AS ({ORD} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
    "global_index": f"SELECT o_orderkey, ROW_NUMBER() OVER ({ORD}) - 1 AS idx FROM orders",
    "order_violations": """WITH o AS (SELECT value, ROW_NUMBER() OVER (ORDER BY event_id) AS rn,
  LAG(value) OVER (ORDER BY event_id) AS prev_value FROM events WHERE value IS NOT NULL)
SELECT rn, prev_value, value FROM o WHERE value < prev_value""",
    "context_rows": """WITH n AS (SELECT event_id, event_type, value, ROW_NUMBER() OVER (ORDER BY event_id) AS rn FROM events),
h AS (SELECT rn FROM n WHERE event_type = 'error' AND value > 200)
SELECT rn, event_id, event_type, value FROM n
WHERE rn IN (SELECT h.rn + UNNEST([-1, 0, 1]) FROM h)""",
    "label_left_join": f"WITH {DL} SELECT * FROM dl",
    "pending_left_join": """SELECT l.doc_id, l.toxic, d.lang, d.source, d.n_chars
FROM labels l LEFT JOIN documents d USING (doc_id) WHERE l.quality = 0""",
    "anti_key_list": """SELECT c_custkey, c_name FROM customer c
WHERE NOT (EXISTS (SELECT 1 FROM nation n WHERE n.n_regionkey = 0 AND n.n_nationkey = c.c_nationkey
                   AND c.c_mktsegment = 'BUILDING') OR c.c_acctbal < 0)""",
    "semi_join": """SELECT c_custkey, c_name FROM customer WHERE c_nationkey IN
(SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA')""",
    "dedupe_rows": "SELECT md5(text) AS text_md5, lang, source FROM (SELECT DISTINCT lang, source, text FROM documents)",
    "duplicate_groups": """SELECT md5(text) AS text_md5, COUNT(*) AS n_copies, MIN(doc_id) AS first_doc
FROM documents GROUP BY text HAVING COUNT(*) > 1""",
    "freq_table": "SELECT event_type, COUNT(*) AS count FROM events GROUP BY event_type",
    "freq_with_null": f"WITH {DL} SELECT quality, COUNT(*) AS count FROM dl GROUP BY quality",
    "month_rollup": "SELECT strftime(o_orderdate, '%Y_%m') AS month, COUNT(*) AS n FROM orders GROUP BY 1",
    "coverage_span": """SELECT MIN(CAST(o_orderdate AS DATE)) AS first, MAX(CAST(o_orderdate AS DATE)) AS last,
  CAST(DATEDIFF('day', MIN(CAST(o_orderdate AS DATE)), MAX(CAST(o_orderdate AS DATE))) AS INTEGER) AS span_days,
  COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE o_orderdate IS NULL) AS n_null FROM orders""",
    "filtered_counts": """SELECT COUNT(*) FILTER (WHERE HOUR(ts) <= 4) AS midnight_starts, COUNT(*) AS total_rows,
  COUNT(*) FILTER (WHERE value > 240) AS long_rows, COUNT(*) FILTER (WHERE value < 1) AS short_rows,
  ROUND(COUNT(*) FILTER (WHERE HOUR(ts) <= 4) * 100.0 / COUNT(*), 6) AS pct_midnight FROM events""",
    "group_summary": """SELECT event_type, ROUND(AVG(value), 6) AS mean, ROUND(quantile_cont(value, 0.5), 6) AS median,
  ROUND(STDDEV_SAMP(value), 6) AS std, COUNT(value) AS count FROM events GROUP BY event_type""",
    "quantiles_box": """SELECT l_returnflag, ROUND(quantile_cont(l_extendedprice, 0.25), 6) AS q1,
  ROUND(quantile_cont(l_extendedprice, 0.5), 6) AS median, ROUND(quantile_cont(l_extendedprice, 0.75), 6) AS q3
FROM lineitem GROUP BY l_returnflag""",
    "histogram": """WITH r AS (SELECT MIN(l_extendedprice) AS lo, MAX(l_extendedprice) AS hi FROM lineitem),
y AS (SELECT l_extendedprice, (SELECT lo FROM r) AS lo, (SELECT hi FROM r) AS hi FROM lineitem WHERE l_extendedprice IS NOT NULL),
x AS (SELECT CAST(CASE WHEN hi - lo = 0 THEN 0 ELSE LEAST(FLOOR((l_extendedprice - lo) / (hi - lo) * 20), 19) END AS INTEGER) AS bin,
             lo, hi FROM y)
SELECT bin, COUNT(*) AS count, ROUND(MIN(lo) + (MIN(hi) - MIN(lo)) * bin / 20, 6) AS bin_lo FROM x GROUP BY bin""",
    "crosstab": """SELECT o_orderpriority, COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS "F",
  COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS "O", COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS "P"
FROM orders GROUP BY o_orderpriority""",
    "crosstab_norm": """WITH c AS (SELECT o_orderpriority, o_orderstatus, COUNT(*) AS n FROM orders GROUP BY ALL)
SELECT o_orderpriority, o_orderstatus, n, ROUND(n / SUM(n) OVER (PARTITION BY o_orderstatus), 6) AS share FROM c""",
    "crosstab_margins": """SELECT CASE WHEN GROUPING(o_orderpriority) = 1 THEN 'All' ELSE o_orderpriority END AS o_orderpriority,
  CASE WHEN GROUPING(o_orderstatus) = 1 THEN 'All' ELSE o_orderstatus END AS o_orderstatus, COUNT(*) AS n
FROM orders GROUP BY CUBE (o_orderpriority, o_orderstatus)""",
    "share_over_time": f"""WITH {EVH}, c AS (SELECT strftime(ts, '%Y-%m-%d') AS month_year, day_quarter, COUNT(*) AS count
  FROM eh WHERE event_type = 'view' GROUP BY ALL)
SELECT month_year, day_quarter, count, ROUND(count / SUM(count) OVER (PARTITION BY month_year), 6) AS proportion FROM c""",
    "day_quarter": f"""WITH {EVH}
SELECT day_quarter, ROUND(AVG(value), 6) AS mean, ROUND(quantile_cont(value, 0.5), 6) AS median,
  ROUND(STDDEV_SAMP(value), 6) AS std, COUNT(value) AS count FROM eh GROUP BY day_quarter""",
    "group_trend": """WITH x AS (SELECT event_type, value, CAST(DATEDIFF('day', DATE '1970-01-01', CAST(ts AS DATE)) AS DOUBLE) AS dn FROM events)
SELECT event_type, ROUND(regr_slope(value, dn), 6) AS slope, ROUND(regr_intercept(value, dn), 6) AS intercept,
  COUNT(value) AS n FROM x GROUP BY event_type""",
    "argmin_per_group": """SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice FROM lineitem
QUALIFY ROW_NUMBER() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice, l_orderkey, l_linenumber) = 1""",
    "pivot_heat": """SELECT l_returnflag, ROUND(AVG(l_discount) FILTER (WHERE l_linestatus = 'F'), 6) AS "F",
  ROUND(AVG(l_discount) FILTER (WHERE l_linestatus = 'O'), 6) AS "O" FROM lineitem GROUP BY l_returnflag""",
    "range_stats": """SELECT l_returnflag, MIN(l_extendedprice) AS min, MAX(l_extendedprice) AS max,
  ROUND(AVG(l_extendedprice), 6) AS mean, ROUND(MAX(l_extendedprice) - MIN(l_extendedprice), 6) AS spread
FROM lineitem GROUP BY l_returnflag""",
    "one_hot": "SELECT o_orderkey, " + ", ".join(
        f"CASE WHEN o_orderpriority = {_q(lv)} THEN 1 ELSE 0 END AS \"o_orderpriority_{lv}\"" for lv in PRIORITY_ORDER[1:]
    ) + " FROM orders",
    "winsorise": """SELECT l_orderkey, l_linenumber,
  ROUND(LEAST(l_extendedprice, (SELECT quantile_cont(l_extendedprice, 0.99) FROM lineitem)), 6) AS price_capped FROM lineitem""",
    "null_profile": f"WITH {DL} " + " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, COUNT({c}) AS non_null, COUNT(*) - COUNT({c}) AS nulls FROM dl"
        for i, c in enumerate(["doc_id", "lang", "source", "n_chars", "quality", "toxic"])),
    "dq_checks": """WITH c AS (
  SELECT 'not_null:doc_id' AS "check", COUNT(*) FILTER (WHERE doc_id IS NULL) AS n_failures FROM labels
  UNION ALL SELECT 'not_null:quality', COUNT(*) FILTER (WHERE quality IS NULL) FROM labels
  UNION ALL SELECT 'accepted_values:quality', COUNT(*) FILTER (WHERE quality IS NOT NULL AND quality NOT IN (0, 1)) FROM labels
  UNION ALL SELECT 'accepted_values:toxic', COUNT(*) FILTER (WHERE toxic IS NOT NULL AND toxic NOT IN (0, 1)) FROM labels
  UNION ALL SELECT 'unique:doc_id', COUNT(*) FILTER (WHERE n > 1) FROM (SELECT doc_id, COUNT(*) AS n FROM labels GROUP BY doc_id)
  UNION ALL SELECT 'not_null_where:toxic', COUNT(*) FILTER (WHERE quality = 1 AND toxic IS NULL) FROM labels)
SELECT "check", n_failures, n_failures = 0 AS passed FROM c""",
    "pearson": " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, ROUND(CORR(CASE WHEN {c} IS NOT NULL AND l_extendedprice IS NOT NULL THEN {c} END,
  CASE WHEN {c} IS NOT NULL AND l_extendedprice IS NOT NULL THEN l_extendedprice END), 6) AS r,
  COUNT(*) FILTER (WHERE {c} IS NOT NULL AND l_extendedprice IS NOT NULL) AS n FROM lineitem"""
        for c in ["l_quantity", "l_discount", "l_tax"]),
    "spearman": """WITH b AS (SELECT * FROM lineitem WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL),
r AS (SELECT RANK() OVER (ORDER BY l_quantity) + (COUNT(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS rx,
             RANK() OVER (ORDER BY l_extendedprice) + (COUNT(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS ry FROM b)
SELECT ROUND(CORR(rx, ry), 6) AS rho, COUNT(*) AS n FROM r""",
    "chi2_independence": f"""WITH {CHI_CELLS}
SELECT ROUND(SUM((observed - expected) * (observed - expected) / expected), 6) AS chi2,
  CAST((COUNT(DISTINCT event_type) - 1) * (COUNT(DISTINCT day_quarter) - 1) AS BIGINT) AS dof,
  CAST(SUM(observed) AS BIGINT) AS n FROM ex""",
    "score_stump": """WITH x AS (SELECT o_orderkey, o_totalprice / 10000.0 AS y,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 2 WHEN o_orderpriority = '3-MEDIUM' THEN 1 ELSE 0 END AS f_tier,
  CAST(o_orderstatus = 'O' AS INTEGER) AS f_new, CAST(o_orderstatus = 'F' AS INTEGER) AS f_depth,
  CAST(o_totalprice > 250000 AS INTEGER) AS f_delivery FROM orders),
l AS (UNPIVOT x ON f_tier, f_new, f_depth, f_delivery INTO NAME f VALUE v),
cut AS (SELECT f, t.t AS t, AVG(y) FILTER (WHERE v <= t.t) AS lo, AVG(y) FILTER (WHERE v > t.t) AS hi,
  COUNT(*) FILTER (WHERE v <= t.t) AS nlo, COUNT(*) FILTER (WHERE v > t.t) AS nhi
  FROM l, (VALUES (0), (1)) t(t) GROUP BY f, t.t),
best AS (SELECT * FROM cut WHERE nlo > 0 AND nhi > 0
  ORDER BY CAST(nlo AS DOUBLE) * nhi / (nlo + nhi) * (lo - hi) * (lo - hi) DESC LIMIT 1),
p AS (SELECT l.o_orderkey, l.y, CASE WHEN l.v <= best.t THEN lo ELSE hi END AS pred FROM l JOIN best ON l.f = best.f)
SELECT o_orderkey, ROUND(pred, 6) AS pred_stump, ROUND(y - pred, 6) AS resid_stump FROM p""",
    "chi2_yates": f"""WITH {DL}, t AS (SELECT lang = 'en' AS r, toxic AS c FROM dl WHERE lang IS NOT NULL AND toxic IS NOT NULL),
o AS (SELECT r, c, COUNT(*) AS observed FROM t GROUP BY r, c),
d AS (SELECT r, c, COALESCE(observed, 0) AS observed FROM (SELECT DISTINCT r FROM t) CROSS JOIN (SELECT DISTINCT c FROM t)
  LEFT JOIN o USING (r, c)),
e AS (SELECT *, ABS(observed - expected) AS gap FROM (SELECT *, SUM(observed) OVER (PARTITION BY r)
  * SUM(observed) OVER (PARTITION BY c) / SUM(observed) OVER () AS expected FROM d)),
f AS (SELECT SUM(gap * gap / expected) AS plain, SUM(POWER(gap - LEAST(0.5, gap), 2) / expected) AS yates,
  CAST((COUNT(DISTINCT r) - 1) * (COUNT(DISTINCT c) - 1) AS BIGINT) AS dof, CAST(SUM(observed) AS BIGINT) AS n FROM e)
SELECT ROUND(plain, 6) AS chi2, ROUND(CASE WHEN dof = 1 THEN yates ELSE plain END, 6) AS chi2_corrected, dof, n FROM f""",
    "chi2_residuals": f"""WITH {CHI_CELLS}
SELECT event_type, day_quarter, observed, ROUND(expected, 6) AS expected,
  ROUND((observed - expected) / SQRT(expected), 6) AS residual FROM ex""",
    "normality": """WITH m AS (SELECT AVG(o_totalprice) AS mu, COUNT(o_totalprice) AS n FROM orders),
om AS (SELECT o_totalprice, (SELECT mu FROM m) AS mu, (SELECT n FROM m) AS n FROM orders),
c AS (SELECT AVG(POWER(o_totalprice - mu, 2)) AS m2, AVG(POWER(o_totalprice - mu, 3)) AS m3,
             AVG(POWER(o_totalprice - mu, 4)) AS m4, MIN(n) AS n, MIN(mu) AS mu FROM om),
g AS (SELECT n, mu, m3 / POWER(m2, 1.5) AS g1, m4 / (m2 * m2) - 3 AS g2 FROM c)
SELECT n, ROUND(mu, 6) AS mean, ROUND(g1, 6) AS skewness, ROUND(g2, 6) AS kurtosis,
  ROUND(n / 6.0 * (g1 * g1 + g2 * g2 / 4.0), 6) AS jarque_bera FROM g""",
    "time_split": f"WITH {SPLIT} SELECT o_orderkey, idx, role FROM sp2",
    "split_summary": f"""WITH {SPLIT}
SELECT role, COUNT(*) AS n, MIN(o_orderdate) AS date_min, MAX(o_orderdate) AS date_max,
  ROUND(AVG(o_totalprice), 6) AS target_mean, ROUND(AVG(CAST(o_orderstatus = 'F' AS DOUBLE)) * 100, 6) AS flag_pct, """
    + ", ".join(f"COUNT(*) FILTER (WHERE o_orderpriority = {_q(p)}) AS \"{p}\"" for p in PRIORITY_ORDER)
    + " FROM sp2 GROUP BY role",
    "rolling_folds": f"""WITH {SPLIT}, sf AS (SELECT *, UNNEST([0, 1, 2]) AS fold, FLOOR(n * 0.35) AS st,
  FLOOR((n - FLOOR(n * 0.35)) / 3) AS sz FROM sp),
x AS (SELECT fold, CASE WHEN idx < st + sz * fold THEN 'train' WHEN idx < st + sz * (fold + 1) THEN 'test' END AS role,
  o_orderkey, idx FROM sf)
SELECT fold, role, o_orderkey, idx FROM x WHERE role IS NOT NULL""",
    "inner_folds": f"""WITH {SPLIT}, sf AS (SELECT *, UNNEST([0, 1, 2]) AS fold, FLOOR(n / 4) AS ts FROM sp),
x AS (SELECT fold, CASE WHEN idx < n - ts * (3 - fold) THEN 'train'
  WHEN idx < n - ts * (2 - fold) THEN 'test' END AS role, o_orderkey, idx FROM sf)
SELECT fold, role, o_orderkey, idx FROM x WHERE role IS NOT NULL""",
    "baseline_global": f"""WITH {SPLIT}, mu AS (SELECT AVG(o_totalprice) AS pred FROM sp2 WHERE role = 'train')
SELECT 'B0' AS model, ROUND(SQRT(AVG(POWER(pred - o_totalprice, 2))), 6) AS rmse,
  COUNT(pred - o_totalprice) AS n_scored, COUNT(*) AS n_test
FROM (SELECT o_totalprice, (SELECT pred FROM mu) AS pred FROM sp2 WHERE role = 'test')""",
    "baseline_group": f"""WITH {SPLIT}, mu AS (SELECT o_orderpriority, AVG(o_totalprice) AS pred FROM sp2 WHERE role = 'train' GROUP BY 1)
SELECT 'B1' AS model, ROUND(SQRT(AVG(POWER(pred - o_totalprice, 2))), 6) AS rmse,
  COUNT(pred - o_totalprice) AS n_scored, COUNT(*) AS n_test FROM sp2 LEFT JOIN mu USING (o_orderpriority) WHERE role = 'test'""",
    "tree_cells": f"""WITH {TREE}, x AS (SELECT *, ROW_NUMBER() OVER ({ORD}) - 1 AS i, COUNT(*) OVER () AS nn FROM tf),
t AS (SELECT * FROM x WHERE i < nn - FLOOR(nn * 0.25)), n AS (SELECT COUNT(*) AS n, CAST(FLOOR(COUNT(*) * 0.35) AS BIGINT) AS st FROM t),
b AS (SELECT n, st, (n - st) // 3 AS size FROM n), l AS (SELECT unnest([st, st + size, st + 2 * size, n]) AS lo FROM b),
c AS (SELECT DISTINCT cut FROM (SELECT unnest([lo - 3 * (lo // 4), lo - 2 * (lo // 4), lo - lo // 4, lo]) AS cut FROM l UNION ALL SELECT st + 3 * size FROM b UNION ALL SELECT 0)),
cl AS (SELECT list(cut) AS cuts FROM c)
SELECT CAST(len(list_filter(cuts, lambda v: v <= i)) AS INTEGER) AS segment, {", ".join(TREE_FEATS)}, COUNT(*) AS n, ROUND(SUM(y), 6) AS sum_y, ROUND(SUM(y * y), 6) AS sum_yy
FROM t, cl GROUP BY ALL""",
    "forest_stumps": f"""WITH {TREE}, h AS (SELECT *, md5(CAST(o_orderkey AS VARCHAR)) AS h FROM tf),
r AS (SELECT *, unnest(range(200)) AS replicate FROM h),
u AS (SELECT *, (CAST('0x' || substr(h, 1, 8) AS BIGINT) % {DRAW_PRIME} + CAST('0x' || substr(h, 9, 8) AS BIGINT) % {DRAW_PRIME} * replicate
  + CAST('0x' || substr(h, 17, 8) AS BIGINT) % {DRAW_PRIME} * replicate * replicate) % {DRAW_PRIME} AS u FROM r),
w AS (SELECT *, {" + ".join(f"CAST(u >= {v} AS BIGINT)" for v in BOOTSTRAP_STEPS)} AS w FROM u),
k AS (SELECT replicate, {", ".join(TREE_FEATS)}, COUNT(*) AS n, SUM(w) AS w, SUM(w * y) AS s FROM w WHERE w > 0 GROUP BY ALL),
v AS ({" UNION ALL ".join(f"SELECT replicate, {i} AS place, '{f}' AS feature, CAST({f} AS DOUBLE) AS value, SUM(n) AS n, SUM(w) AS w, SUM(s) AS s FROM k GROUP BY ALL" for i, f in enumerate(TREE_FEATS))}),
q AS (SELECT *, SUM(n) OVER o AS ln, SUM(w) OVER o AS lw, SUM(s) OVER o AS ls, SUM(n) OVER p AS tn, SUM(w) OVER p AS tw, SUM(s) OVER p AS ts, LEAD(value) OVER o AS nxt
  FROM v WINDOW o AS (PARTITION BY replicate, place ORDER BY value), p AS (PARTITION BY replicate, place)),
g AS (SELECT *, ls * ls / lw + (ts - ls) * (ts - ls) / (tw - lw) - ts * ts / tw AS gain FROM q WHERE ln >= 2 AND tn - ln >= 2)
SELECT replicate, feature, (value + nxt) / 2 AS threshold, ROUND(ls / lw, 6) AS left_mean, ROUND((ts - ls) / (tw - lw), 6) AS right_mean
FROM g QUALIFY ROW_NUMBER() OVER (PARTITION BY replicate ORDER BY gain DESC, place, value) = 1""",
    "ridge_two": f"""WITH {FEAT}, g AS (SELECT AVG(f_tier) AS ma, AVG(f_delivery) AS mb, AVG(y) AS my, VAR_POP(f_tier) * COUNT(*) + 50.0 AS aa, VAR_POP(f_delivery) * COUNT(*) + 50.0 AS bb,
  COVAR_POP(f_tier, f_delivery) * COUNT(*) AS ab, COVAR_POP(f_tier, y) * COUNT(*) AS ay, COVAR_POP(f_delivery, y) * COUNT(*) AS bxy FROM f),
w AS (SELECT *, (bb * ay - ab * bxy) / (aa * bb - ab * ab) AS wa, (aa * bxy - ab * ay) / (aa * bb - ab * ab) AS wb FROM g)
SELECT 'intercept' AS term, ROUND(my - wa * ma - wb * mb, 6) AS value, CAST(50.0 AS DOUBLE) AS alpha FROM w
UNION ALL SELECT 'f_tier', ROUND(wa, 6), 50.0 FROM w UNION ALL SELECT 'f_delivery', ROUND(wb, 6), 50.0 FROM w""",
    "ridge_two_curve": f"""WITH {FEAT}, x AS (SELECT *, ROW_NUMBER() OVER ({ORD}) - 1 AS j, COUNT(*) OVER () AS n FROM f),
s AS (SELECT DISTINCT 0 AS outer_, p, n - (n // 4) * (3 - p) AS a, n - (n // 4) * (2 - p) AS b FROM x, (SELECT unnest([0, 1, 2]) AS p)),
{RIDGE_TWO}
SELECT alpha, ROUND(AVG(rmse), 6) AS mean_rmse, ROUND(STDDEV_POP(rmse), 6) AS std_rmse FROM e GROUP BY alpha""",
    "ridge_two_rolling": f"""WITH {FEAT}, x AS (SELECT *, ROW_NUMBER() OVER ({ORD}) - 1 AS j, COUNT(*) OVER () AS n FROM f),
m AS (SELECT DISTINCT n, CAST(FLOOR(n * 0.35) AS BIGINT) AS st FROM x), o AS (SELECT outer_, st + ((n - st) // 3) * outer_ AS lo, st + ((n - st) // 3) * (outer_ + 1) AS hi FROM m, (SELECT unnest([0, 1, 2]) AS outer_)),
s AS (SELECT outer_, p, lo - (lo // 4) * (3 - p) AS a, lo - (lo // 4) * (2 - p) AS b FROM o, (SELECT unnest([0, 1, 2]) AS p) UNION ALL SELECT outer_, -1, lo, hi FROM o),
{RIDGE_TWO},
best AS (SELECT outer_, alpha FROM (SELECT outer_, alpha, AVG(rmse) AS m FROM e WHERE p >= 0 GROUP BY ALL) QUALIFY ROW_NUMBER() OVER (PARTITION BY outer_ ORDER BY m, alpha) = 1)
SELECT CAST(e.outer_ AS INTEGER) AS fold, e.alpha, ROUND(rmse, 6) AS rmse, n_train, n_test FROM e JOIN best USING (outer_, alpha) WHERE p = -1""",
    "ridge_single": """WITH l AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem),
m AS (SELECT AVG(x) AS mx, AVG(y) AS my FROM l),
lm AS (SELECT x, y, (SELECT mx FROM m) AS mx, (SELECT my FROM m) AS my FROM l),
s AS (SELECT SUM((x - mx) * (y - my)) AS sxy, SUM((x - mx) * (x - mx)) AS sxx, MIN(mx) AS mx, MIN(my) AS my FROM lm),
fit AS (SELECT sxy / (sxx + 10.0) AS coef, my - sxy / (sxx + 10.0) * mx AS intercept FROM s)
SELECT ROUND(intercept, 6) AS intercept, ROUND(coef, 6) AS coef,
  ROUND((SELECT SQRT(AVG(POWER(y - intercept - coef * x, 2))) FROM l), 6) AS rmse FROM fit""",
    "score_linear": f"WITH {FEAT} SELECT o_orderkey, ROUND_EVEN({_lin(M1)}, 1) AS predicted FROM f",
    "score_many": f"""WITH {SCORED} SELECT o_orderkey, era, ROUND(pred_m1, 6) AS pred_m1, ROUND(resid_m1, 6) AS resid_m1,
  ROUND(pred_m2, 6) AS pred_m2, ROUND(resid_m2, 6) AS resid_m2 FROM sc""",
    "era_rmse": f"""WITH {SCORED}, r AS (
  SELECT 'm1' AS model_id, SQRT(AVG(resid_m1 * resid_m1)) AS overall_rmse,
    SQRT(AVG(resid_m1 * resid_m1) FILTER (WHERE era = 'post')) AS post_rmse,
    COUNT(resid_m1) AS n_total, COUNT(resid_m1) FILTER (WHERE era = 'post') AS n_post FROM sc
  UNION ALL SELECT 'm2', SQRT(AVG(resid_m2 * resid_m2)), SQRT(AVG(resid_m2 * resid_m2) FILTER (WHERE era = 'post')),
    COUNT(resid_m2), COUNT(resid_m2) FILTER (WHERE era = 'post') FROM sc)
SELECT model_id, ROUND(overall_rmse, 6) AS overall_rmse, ROUND(post_rmse, 6) AS post_rmse, n_total, n_post,
  CASE WHEN overall_rmse < 4.68 THEN 'BEATS HOLDOUT' WHEN overall_rmse < 5.45 THEN 'beats B1' ELSE 'below B1' END AS verdict FROM r""",
    "drift_report": f"""WITH {DRIFT}
SELECT step, o_orderkey, ROUND(rm, 6) AS rolling_mean_resid, ROUND(rr, 6) AS rolling_rmse, ABS(rm) > 2.0 AS drift FROM d2""",
    "retrain_signal": f"""WITH {DRIFT}, l AS (SELECT * FROM d2 ORDER BY step DESC LIMIT 1)
SELECT (SELECT COUNT(*) FROM d2) AS n_rows, l.step, ROUND(l.rm, 6) AS latest_mean_resid, ROUND(l.rr, 6) AS latest_rolling_rmse,
  CAST(ABS(l.rm) > 2.0 AS INTEGER) AS drift_flag,
  CASE WHEN ABS(l.rm) > 2.0 THEN CASE WHEN l.rm > 0 THEN 'underpredicting' ELSE 'overpredicting' END END AS direction,
  CAST(ABS(l.rm) > 2.0 OR l.rr > 5.45 AS INTEGER) AS retrain FROM l""",
    "residuals_by_group": f"""WITH {SCORED}
SELECT o_orderpriority, COUNT(resid_m1) AS n, ROUND(AVG(resid_m1), 6) AS mean, ROUND(SQRT(AVG(resid_m1 * resid_m1)), 6) AS rmse,
  CAST(COALESCE(list_position([{_in(PRIORITY_ORDER)}], o_orderpriority), 0) AS BIGINT) AS rank FROM sc GROUP BY o_orderpriority""",
    "feature_shift": f"""WITH {SCORED}, m AS (""" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, AVG(CAST({c} AS DOUBLE)) FILTER (WHERE era = 'train') AS tm, "
        f"AVG(CAST({c} AS DOUBLE)) FILTER (WHERE era = 'post') AS pm FROM sc" for c in ["f_new", "f_depth", "f_delivery"])
    + """)
SELECT feature, ROUND(tm, 6) AS train_mean, ROUND(pm, 6) AS post_mean, ROUND(pm - tm, 6) AS delta, ABS(pm - tm) > 0.15 AS shifted FROM m""",
    "tier_mix": f"""WITH {SCORED}, c AS (SELECT era, f_tier, COUNT(*) AS n FROM sc GROUP BY ALL)
SELECT era, f_tier, n, ROUND(n * 1.0 / SUM(n) OVER (PARTITION BY era) * 100, 6) AS pct FROM c""",
    "regime_view": f"""WITH i AS (SELECT *, ROW_NUMBER() OVER ({ORD}) - 1 AS idx,
  CASE WHEN CAST(o_orderdate AS DATE) >= DATE '{SHIFT_DATE}' THEN 'after' ELSE 'before' END AS regime FROM orders)
SELECT o_orderstatus, regime, ROUND(AVG(o_totalprice), 6) AS mean, COUNT(*) AS n,
  (SELECT MIN(idx) FROM i WHERE regime = 'after') AS shift_index FROM i GROUP BY o_orderstatus, regime""",
    "top_k": """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 10""",
    "audit": """WITH e AS (SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS d, CAST(FLOOR(value) AS BIGINT) AS dur FROM events),
o AS (SELECT d, LAG(d) OVER (ORDER BY event_id) AS p FROM e WHERE d IS NOT NULL)
SELECT * FROM (VALUES
  ('null_dates', (SELECT COUNT(*) FROM e WHERE d IS NULL)),
  ('zero_duration', (SELECT COUNT(*) FROM e WHERE dur = 0)),
  ('over_long', (SELECT COUNT(*) FROM e WHERE dur > 240)),
  ('duplicate_groups', (SELECT COUNT(*) FROM (SELECT 1 FROM e GROUP BY user_id, event_type, d, dur HAVING COUNT(*) >= 2))),
  ('out_of_order', (SELECT COUNT(*) FROM o WHERE d < p))) AS t("check", n)""",
    "group_means": """SELECT l_returnflag, ROUND(AVG(l_quantity), 6) AS mean_l_quantity, ROUND(AVG(l_discount), 6) AS mean_l_discount,
  ROUND(AVG(l_tax), 6) AS mean_l_tax FROM lineitem GROUP BY l_returnflag""",
    "describe_columns": " UNION ALL ".join(f"""SELECT '{c}' AS "column", COUNT({c}) AS count, ROUND(AVG({c}), 6) AS mean, ROUND(STDDEV_SAMP({c}), 6) AS std, ROUND(CAST(MIN({c}) AS DOUBLE), 6) AS min,
  {", ".join(f"ROUND(quantile_cont(CAST({c} AS DOUBLE), {q}), 6) AS q{int(q * 100)}" for q in (0.1, 0.25, 0.5, 0.9))}, ROUND(CAST(MAX({c}) AS DOUBLE), 6) AS max FROM lineitem""" for c in DESCRIBE_COLS),
    "histogram_auto": """WITH s AS (SELECT CAST(o_totalprice AS DOUBLE) AS v FROM orders WHERE o_totalprice IS NOT NULL),
f AS (SELECT MIN(v) AS lo, MAX(v) AS hi, COUNT(*) AS n, 2 * (quantile_cont(v, 0.75) - quantile_cont(v, 0.25)) / POWER(COUNT(*), 1.0 / 3) AS fd, (MAX(v) - MIN(v)) / (LOG2(COUNT(*)) + 1) AS st FROM s),
b AS (SELECT lo, hi, CAST(CASE WHEN hi > lo THEN CEIL((hi - lo) / CASE WHEN fd > 0 THEN LEAST(fd, st) ELSE st END) ELSE 1 END AS BIGINT) AS n_bins FROM f),
x AS (SELECT CAST(CASE WHEN hi > lo THEN LEAST(FLOOR((v - lo) / (hi - lo) * n_bins), n_bins - 1) ELSE 0 END AS BIGINT) AS bin, lo, hi, n_bins FROM s, b)
SELECT bin, COUNT(*) AS count, ROUND(lo + (hi - lo) * bin / n_bins, 6) AS bin_lo, n_bins FROM x GROUP BY bin, lo, hi, n_bins""",
    "crosstab_all": """WITH c AS (SELECT o_orderpriority, o_orderstatus, COUNT(*) AS n FROM orders WHERE o_orderpriority IS NOT NULL AND o_orderstatus IS NOT NULL GROUP BY ALL)
SELECT o_orderpriority, o_orderstatus, n, ROUND(n / SUM(n) OVER (), 6) AS share FROM c""",
    "chi2_p": f"""WITH {CHI_CELLS}, x AS (SELECT SUM((observed - expected) * (observed - expected) / expected) / 2 AS x,
  CAST((COUNT(DISTINCT event_type) - 1) * (COUNT(DISTINCT day_quarter) - 1) AS BIGINT) AS dof FROM ex)
SELECT dof, ROUND(list_sum(list_transform(range(dof // 2), lambda k: EXP(-x + k * LN(x) - LGAMMA(k + 1)))), 9) AS p FROM x""",
    "normality_distance": """WITH s AS (SELECT COUNT(o_totalprice) AS n, AVG(CAST(o_totalprice AS DOUBLE)) AS mean, STDDEV_SAMP(CAST(o_totalprice AS DOUBLE)) AS std FROM orders),
v AS (SELECT CAST(o_totalprice AS DOUBLE) AS v, COUNT(*) AS c FROM orders WHERE o_totalprice IS NOT NULL GROUP BY 1),
r AS (SELECT v, c, SUM(c) OVER (ORDER BY v) AS upto FROM v),
z AS (SELECT c, upto, n, (v - mean) / std AS z FROM r, s),
p AS (SELECT c, upto, n, 0.5 + SIGN(z) / 2 * CASE WHEN z = 0 THEN 0 ELSE list_sum(list_transform(range(200), lambda k: EXP((2 * k + 1) * LN(ABS(z) / SQRT(2.0)) - z * z / 2 - LGAMMA(k + 1.5)))) END AS p FROM z)
SELECT MAX(s.n) AS n, ROUND(MAX(mean), 6) AS mean, ROUND(MAX(std), 6) AS std, ROUND(MAX(GREATEST(ABS(upto / p.n - p), ABS(p - (upto - c) / p.n))), 6) AS distance FROM p, s""",
    "relabel": f"""SELECT CASE {" ".join(f"WHEN o_orderstatus = '{k}' THEN '{v}'" for k, v in STATUS_LABELS.items())} ELSE o_orderstatus END AS label, COUNT(*) AS n FROM orders GROUP BY ALL""",
    "run_history": """WITH m AS (SELECT ROUND(AVG(o_totalprice), 6) AS v FROM orders WHERE year(o_orderdate) = (SELECT MAX(year(o_orderdate)) FROM orders))
SELECT 'orders' AS experiment, r AS run_id, 'alpha ' || a AS run_name, a AS alpha, CAST(3 AS DOUBLE) AS n_folds, CAST(v AS DOUBLE) AS mean_price FROM m, (VALUES ('r1', '0.9'), ('r2', '0.5')) t(r, a)""",
    "summary_with_without": """SELECT ROUND(median(o_totalprice), 6) AS median_all, ROUND(median(o_totalprice) FILTER (WHERE NOT (o_totalprice > 400000)), 6) AS median_without, ROUND(AVG(o_totalprice), 6) AS mean_all, ROUND(STDDEV_SAMP(o_totalprice), 6) AS std_all,
  ROUND(AVG(o_totalprice) FILTER (WHERE NOT (o_totalprice > 400000)), 6) AS mean_without,
  ROUND(STDDEV_SAMP(o_totalprice) FILTER (WHERE NOT (o_totalprice > 400000)), 6) AS std_without,
  COUNT(*) FILTER (WHERE o_totalprice > 400000) AS n_outliers FROM orders""",
    "sparse_levels": "SELECT p_brand, COUNT(*) AS n, COUNT(*) < 50 AS sparse FROM part GROUP BY p_brand",
    "bias_std": f"""WITH {SCORED} SELECT era, ROUND(AVG(resid_m1), 6) AS bias, ROUND(STDDEV_POP(resid_m1), 6) AS std FROM sc GROUP BY era""",
    "share_where": """SELECT o_orderpriority, COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS n_true, COUNT(*) AS n,
  ROUND(AVG(CAST(o_orderstatus = 'F' AS INTEGER)) * 100, 6) AS pct FROM orders GROUP BY o_orderpriority""",
    "n_unique": "SELECT event_type, COUNT(DISTINCT user_id) AS n_users FROM events GROUP BY event_type",
    "describe": """SELECT COUNT(o_totalprice) AS count, ROUND(AVG(o_totalprice), 6) AS mean, ROUND(STDDEV_SAMP(o_totalprice), 6) AS std,
  ROUND(MIN(o_totalprice), 6) AS min, ROUND(quantile_cont(o_totalprice, 0.25), 6) AS q25,
  ROUND(quantile_cont(o_totalprice, 0.5), 6) AS q50, ROUND(quantile_cont(o_totalprice, 0.75), 6) AS q75,
  ROUND(MAX(o_totalprice), 6) AS max FROM orders""",
    "evaluate": f"""WITH {FEAT}, i AS (SELECT *, ROW_NUMBER() OVER ({ORD}) - 1 AS idx, COUNT(*) OVER () AS n FROM f),
t AS (SELECT *, y - ({_lin(M1)}) AS d FROM i WHERE idx >= n - FLOOR(n * 0.25))
SELECT o_orderpriority, COUNT(d) AS n, ROUND(SQRT(AVG(d * d)), 6) AS rmse, ROUND(AVG(d), 6) AS bias,
  ROUND(STDDEV_POP(d), 6) AS std FROM t GROUP BY o_orderpriority""",
    "distinct_values": "SELECT DISTINCT o_orderpriority FROM orders",
    "drop_incomplete": f"""WITH {DL} SELECT COUNT(*) FILTER (WHERE quality IS NOT NULL AND toxic IS NOT NULL) AS n_kept,
  COUNT(*) FILTER (WHERE quality IS NULL OR toxic IS NULL) AS n_dropped FROM dl""",
}

# ---- the log's view chain on the events-derived raw log ----

#: What the cleaner has to make of the raw log, stated by event and not by the
#: library's vocabularies: each type's categories in turn (None: out of scope).
CLEAN_CATEGORY = {"view": ["Editing"] * 4, "click": ["Script", "Script", "Script", "Processing Raw Video"],
                  "purchase": ["Thumbnail", "Thumbnail", "Thumbnail", "Subtitles"],
                  "signup": ["Uploading", "Recording Audio", "Recording Video", "Recording Video"],
                  "error": [None, None, None, "Dancing"]}
CLEAN_MEDIA_TYPE = ["Movies", "Movies", "Video Games", "Books", "Video Games", None]
CLEAN_PHASE = {"Pre-Processing": ["Processing Raw Video", "Script"], "Processing": ["Editing", "Recording Audio", "Recording Video"],
               "Post-Processing": ["Thumbnail", "Subtitles", "Uploading"]}
OUT_OF_SCOPE = [89, 83, 53, 59, 61, 67, 71, 73, 79]  # each n-th event breaks a rule


def _list(values) -> str:
    return "[" + ", ".join("NULL" if v is None else _q(v) if isinstance(v, str) else str(v) for v in values) + "]"


_CAT = "CASE " + " ".join(f"WHEN event_type = {_q(t)} THEN ({_list(v)})[event_id % 4 + 1]" for t, v in CLEAN_CATEGORY.items()) + " END"
_TIE = ", ".join(f"{c} NULLS LAST" for c in "ts0 date_workflow time_start time_end duration media_title video_type video_subtype media_type media_series".split())

LOG_STG = f"""raw AS (
  SELECT event_id AS _seq, ({_list(CLEAN_MEDIA_TYPE)})[user_id % 6 + 1] AS media_type, 'S' AS media_series,
    'u' || CAST(user_id AS VARCHAR) AS media_title, (['Review', 'Essay'])[user_id % 2 + 1] AS video_type,
    (['A', 'B', 'A'])[event_id % 3 + 1] AS video_subtype, {_CAT} AS creation_category,
    CASE WHEN event_id >= 20 AND event_id % 7 <> 3 THEN CAST(ts AS DATE) END AS date,
    strftime(ts, '%H:%M:%S') AS time_start, strftime(ts + to_minutes(dur), '%H:%M:%S') AS time_end,
    CASE WHEN CAST(ts + to_minutes(dur) AS DATE) > CAST(ts AS DATE) THEN dur - 1440 ELSE dur END AS duration
  FROM (SELECT *, CAST(FLOOR(value) AS BIGINT) AS dur FROM events)
  WHERE {' AND '.join(f'event_id % {n} <> 0' for n in OUT_OF_SCOPE)}),
cleaned AS (SELECT * FROM raw WHERE media_type IS NOT NULL AND creation_category IS NOT NULL),
filled AS (SELECT *, LAST_VALUE(date IGNORE NULLS) OVER (ORDER BY _seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
           AS date_workflow FROM cleaned),
stg AS (SELECT DISTINCT media_title, video_type, video_subtype, creation_category, date_workflow, time_start, time_end,
          CASE WHEN duration < 0 THEN duration + 1440 ELSE duration END AS duration, media_type, media_series FROM filled),
stg2 AS (SELECT *, md5(media_title || '|' || video_type || '|' || video_subtype) AS video_id FROM stg)"""

LOG_SESS = f"""{LOG_STG},
b AS (SELECT *, date_workflow + CAST(time_start AS TIME) AS ts0,
        date_workflow + CAST(time_start AS TIME) + to_minutes(duration) AS te FROM stg2),
g AS (SELECT *, DATEDIFF('minute', LAG(te) OVER (PARTITION BY video_id, creation_category ORDER BY {_TIE}), ts0) AS gap FROM b),
s AS (SELECT *, SUM(CASE WHEN gap IS NULL OR gap > 15 THEN 1 ELSE 0 END) OVER (PARTITION BY video_id, creation_category
        ORDER BY {_TIE} ROWS UNBOUNDED PRECEDING) AS sid FROM g),
sess AS (SELECT video_id, creation_category, CAST(sid AS BIGINT) AS session_id, COUNT(*) AS sessions_combined,
    MIN(date_workflow) AS date_workflow, MIN(media_title) AS media_title, MIN(video_type) AS video_type,
    MIN(video_subtype) AS video_subtype, MIN(media_type) AS media_type, MIN(media_series) AS media_series,
    MIN(time_start) AS time_start, MAX(time_end) AS time_end, CAST(SUM(duration) AS BIGINT) AS duration,
    MIN(ts0) AS ts_start, MAX(te) AS ts_end FROM s GROUP BY video_id, creation_category, sid)"""

SQL["log_stg"] = f"WITH {LOG_STG} SELECT * FROM stg2"
SQL["log_sessions"] = f"WITH {LOG_SESS} SELECT * FROM sess"
LOG_DIM = f"""{LOG_SESS},
p AS (SELECT *, {classify_sql('creation_category', CLEAN_PHASE, 'Uncategorised')} AS ph, date_workflow AS d FROM sess),
dim AS (SELECT {', '.join(rollup_cols('video_id', 'creation_category', CLEAN_PHASE, [
    "Editing", "Processing Raw Video", "Recording Audio", "Recording Video", "Script", "Subtitles", "Thumbnail", "Uploading"],
    ['media_title', 'video_type', 'video_subtype', 'media_type', 'media_series']))}
  FROM p GROUP BY video_id),
seed AS (SELECT 'u' || CAST(c_custkey AS VARCHAR) AS media_title, (['Review', 'Essay'])[c_custkey % 2 + 1] AS video_type,
    (['A', 'A', 'B'])[c_custkey % 3 + 1] AS video_subtype,
    CAST(([7, 10, 15, 20, 25, 30, 12, NULL])[c_custkey % 8 + 1] AS INTEGER) AS expected_length_mins,
    CAST(c_acctbal > 0 AS INTEGER) AS complexity_new, CAST(c_nationkey % 2 AS INTEGER) AS complexity_media_depth,
    CAST(c_nationkey > 12 AS INTEGER) AS complexity_delivery_style, CAST(c_acctbal > 5000 AS INTEGER) AS complexity_logistics,
    CASE WHEN c_nationkey > 2 THEN CAST(c_nationkey % 3 = 0 AS INTEGER) END AS complexity_worklife,
    CAST(c_custkey % 4 <> 0 AS INTEGER) AS is_complete,
    (['Short', 'Short', 'Average', 'Long', 'Long', 'Long', NULL, NULL])[c_custkey % 8 + 1] AS length_tier,
    CAST(([0, 0, 1, 2, 2, 2, NULL, NULL])[c_custkey % 8 + 1] AS INTEGER) AS length_tier_ord FROM customer)"""

SQL["log_dim"] = f"WITH {LOG_DIM} SELECT * FROM dim"
SQL["log_dim_staged"] = SQL["log_dim"]
SQL["load_report"] = """WITH e AS (SELECT event_id, ts, CAST(FLOOR(value) AS BIGINT) AS dur FROM events),
r AS (SELECT CASE WHEN event_id % 97 = 1 THEN 'line' WHEN event_id % 101 = 1 OR event_id % 103 = 1 THEN 'time' ELSE 'accepted' END AS reason,
  CASE WHEN CAST(ts + to_minutes(dur) AS DATE) > CAST(ts AS DATE) THEN dur - 1440 ELSE dur END AS duration FROM e)
SELECT reason, COUNT(*) AS n, CAST(SUM(duration) FILTER (WHERE reason = 'accepted') AS BIGINT) AS minutes, COUNT(*) AS observed FROM r GROUP BY reason"""
SQL["log_ml"] = f"""WITH {LOG_DIM} SELECT d.*, l.* EXCLUDE (media_title, video_type, video_subtype)
FROM dim d LEFT JOIN seed l ON d.media_title = l.media_title AND d.video_type = l.video_type AND d.video_subtype = l.video_subtype"""
SQL["log_pending"] = f"""WITH {LOG_DIM} SELECT md5(l.media_title || '|' || l.video_type || '|' || l.video_subtype) AS video_id,
  l.* EXCLUDE (is_complete), d.media_type, d.date_first FROM seed l
LEFT JOIN dim d ON d.media_title = l.media_title AND d.video_type = l.video_type AND d.video_subtype = l.video_subtype
WHERE l.is_complete = 0"""


def _spearman_matrix_sql(cols) -> str:
    ranks = ", ".join(f"RANK() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS r_{c}" for c in cols)
    pairs = " UNION ALL ".join(f"SELECT '{a}' AS x, '{b}' AS y, ROUND(CORR(r_{a}, r_{b}), 6) AS r FROM rk"
                               for a in cols for b in cols)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    return f"WITH rk AS (SELECT {ranks} FROM lineitem WHERE {nn}) {pairs}"


SQL["spearman_matrix"] = _spearman_matrix_sql(SPEARMAN_COLS)

SQL["head_tail"] = """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 5"""
