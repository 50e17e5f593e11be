"""Oracle SQL (DuckDB dialect) of the model queries.

The models are fitted again in SQL, from the same tables: the split by a window over the
digests, logistic regression by Newton steps with Gauss-Jordan elimination, a boosting round
by cumulative sums, bags by the digests.  Nothing that Spark computed enters these texts.
"""

from __future__ import annotations

from staylens import config as C

NUMERIC = ("age_at_admit", "admit_hour", "admit_dayofweek", "is_weekend_admit", "admit_month")
CATEGORICAL = ("age_band", "gender", "admission_type", "admission_location", "insurance", "language", "marital_status", "race")
SEED = C.DEFAULT_SEED
NEWTON_STEPS = 8
TREES = 20


def digest(purpose: str, ident: str, first: int = 1, digits: int = 15) -> str:
    return f"('0x' || substr(md5('{SEED}:{purpose}:' || {ident}), {first}, {digits}))::BIGINT"


SPLIT = f"""
, mt AS MATERIALIZED (SELECT *, CASE WHEN los_days > 7.0 THEN 1 ELSE 0 END AS y FROM featured),
cls AS (SELECT y AS label, COUNT(*) AS nc FROM mt GROUP BY 1),
tot AS (SELECT SUM(nc) AS n, CAST(CEIL(CAST(0.2 AS DOUBLE) * CAST(SUM(nc) AS DOUBLE)) AS BIGINT) AS ntest FROM cls),
alloc AS (SELECT c.label, c.nc, CAST(c.nc AS DOUBLE) * CAST(t.n - t.ntest AS DOUBLE) / CAST(t.n AS DOUBLE) AS cont, t.n, t.ntest FROM cls c CROSS JOIN tot t),
alloc2 AS (
  SELECT *, FLOOR(cont) AS fl, (n - ntest) - SUM(FLOOR(cont)) OVER () AS need, ROW_NUMBER() OVER (ORDER BY cont - FLOOR(cont) DESC, label) AS rk FROM alloc
),
fin AS (SELECT label, nc, CAST(fl + CASE WHEN rk <= need THEN 1 ELSE 0 END AS BIGINT) AS ntrain FROM alloc2),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY y ORDER BY {digest('split', 'CAST(hadm_id AS VARCHAR)')}, hadm_id) AS rk FROM mt),
sp AS MATERIALIZED (SELECT r.* EXCLUDE (rk), CASE WHEN r.rk <= f.nc - f.ntrain THEN 'test' ELSE 'train' END AS split FROM ranked r JOIN fin f ON r.y = f.label),
tr AS MATERIALIZED (SELECT *, hadm_id AS rid FROM sp WHERE split = 'train'),
te AS MATERIALIZED (SELECT *, hadm_id AS rid FROM sp WHERE split = 'test')"""


def long_form(src: str) -> str:
    """``src`` (with rid) as one row per numeric and per categorical feature."""
    numeric = " UNION ALL ".join(f"SELECT rid, '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM {src}" for c in NUMERIC)
    categorical = " UNION ALL ".join(f"SELECT rid, '{c}' AS feature, CAST({c} AS VARCHAR) AS v FROM {src}" for c in CATEGORICAL)
    return f""",
{src}_n AS ({numeric}),
{src}_c AS ({categorical})"""


STATS = long_form("tr") + """,
med AS (SELECT feature, quantile_cont(x, 0.5) AS median FROM tr_n GROUP BY feature),
num AS MATERIALIZED (
  SELECT t.feature, MAX(m.median) AS median, AVG(COALESCE(t.x, m.median)) AS mean,
         CASE WHEN STDDEV_POP(COALESCE(t.x, m.median)) = 0 THEN 1.0 ELSE STDDEV_POP(COALESCE(t.x, m.median)) END AS std
  FROM tr_n t JOIN med m ON t.feature = m.feature GROUP BY t.feature
),
freq AS (SELECT feature, v, COUNT(*) AS k FROM tr_c WHERE v IS NOT NULL GROUP BY 1, 2),
mode_ AS MATERIALIZED (SELECT feature, v AS mode FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY feature ORDER BY k DESC, v ASC) AS rk FROM freq) WHERE rk = 1),
cols AS MATERIALIZED (
  SELECT feature, level, ROW_NUMBER() OVER (ORDER BY feature, level NULLS FIRST) AS j
  FROM (SELECT feature, CAST(NULL AS VARCHAR) AS level FROM num UNION ALL SELECT DISTINCT feature, v FROM freq)
)"""


def encoded(src: str) -> str:
    """Non-zero entries (rid, j, v) of the expanded columns; column 0 is the intercept."""
    return f""",
{src}_x AS MATERIALIZED (
  SELECT rid, 0 AS j, CAST(1 AS DOUBLE) AS v FROM {src}
  UNION ALL SELECT n.rid, c.j, (COALESCE(n.x, s.median) - s.mean) / s.std FROM {src}_n n JOIN num s ON n.feature = s.feature JOIN cols c ON c.feature = n.feature
  UNION ALL SELECT q.rid, c.j, 1.0 FROM {src}_c q JOIN mode_ m ON q.feature = m.feature JOIN cols c ON c.feature = q.feature AND c.level = COALESCE(q.v, m.mode)
)"""


def _newton(t: int) -> str:
    return f""",
p{t} AS MATERIALIZED (
  SELECT x.rid, MAX(w.s) * (1 / (1 + exp(-SUM(x.v * b.b)))) * (1 - 1 / (1 + exp(-SUM(x.v * b.b)))) AS u,
         MAX(w.s) * (MAX(w.y) - 1 / (1 + exp(-SUM(x.v * b.b)))) AS r
  FROM tr_x x JOIN b{t} b ON x.j = b.j JOIN yw w ON x.rid = w.rid GROUP BY x.rid
),
h{t} AS (SELECT a.j AS i, c.j AS j, SUM(a.v * c.v * p.u) AS h FROM tr_x a JOIN tr_x c ON a.rid = c.rid JOIN p{t} p ON a.rid = p.rid GROUP BY 1, 2),
g{t} AS (SELECT x.j, SUM(x.v * p.r) AS g FROM tr_x x JOIN p{t} p ON x.rid = p.rid GROUP BY x.j),
rows{t} AS (
  SELECT i.j AS i, list_append(list(COALESCE(h.h, 0) + CASE WHEN i.j = c.j AND i.j > 0 THEN 1 ELSE 0 END ORDER BY c.j),
                               MAX(COALESCE(g.g, 0) - CASE WHEN i.j > 0 THEN i.b ELSE 0 END)) AS r
  FROM b{t} i CROSS JOIN b{t} c LEFT JOIN h{t} h ON h.i = i.j AND h.j = c.j LEFT JOIN g{t} g ON g.j = i.j GROUP BY i.j
),
e{t}(k, m) AS (
  SELECT 1, list(r ORDER BY i) FROM rows{t}
  UNION ALL
  SELECT k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / m[k][k])
                                                   ELSE list_transform(r, lambda v, c: v - r[k] * m[k][c] / m[k][k]) END)
  FROM e{t} WHERE k <= len(m)
),
b{t + 1} AS MATERIALIZED (SELECT b.j, b.b + e.m[b.j + 1][len(e.m) + 1] AS b FROM b{t} b CROSS JOIN e{t} e WHERE e.k = len(e.m) + 1)"""


FIT = encoded("tr") + """,
yw AS MATERIALIZED (SELECT t.rid, t.y, CAST(COUNT(*) OVER () AS DOUBLE) / (2.0 * COUNT(*) OVER (PARTITION BY t.y)) AS s FROM tr t),
b0 AS MATERIALIZED (SELECT 0 AS j, CAST(0 AS DOUBLE) AS b UNION ALL SELECT j, 0 FROM cols)""" + "".join(_newton(t) for t in range(NEWTON_STEPS)) + f""",
beta AS (SELECT * FROM b{NEWTON_STEPS})"""


def scored(src: str) -> str:
    return (long_form(src) if src != "tr" else "") + (encoded(src) if src != "tr" else "") + f""",
{src}_m AS MATERIALIZED (SELECT x.rid, SUM(x.v * b.b) AS m FROM {src}_x x JOIN beta b ON x.j = b.j GROUP BY x.rid)"""


def _level(d: int) -> str:
    return f""",
cell{d} AS (
  SELECT n.node, c.feature, c.x, c.v, SUM(r.g) AS g, SUM(r.h) AS h FROM nd{d} n JOIN brow r ON n.rid = r.rid JOIN bcell c ON n.rid = c.rid GROUP BY ALL
),
sum{d} AS (SELECT n.node, SUM(r.g) AS gt, SUM(r.h) AS ht FROM nd{d} n JOIN brow r ON n.rid = r.rid GROUP BY n.node),
cand{d} AS (
  SELECT node, feature, x AS cut, CAST(NULL AS VARCHAR) AS level, feature AS name,
         SUM(g) OVER w AS gl, SUM(h) OVER w AS hl
  FROM cell{d} WHERE x IS NOT NULL
  WINDOW w AS (PARTITION BY node, feature ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  UNION ALL
  SELECT c.node, c.feature, NULL, c.v, c.feature || '_' || c.v, s.gt - c.g, s.ht - c.h FROM cell{d} c JOIN sum{d} s ON c.node = s.node WHERE c.v IS NOT NULL
),
gain{d} AS (
  SELECT k.*, s.gt, s.ht, gl * gl / (hl + 1) + (gt - gl) * (gt - gl) / (ht - hl + 1) - gt * gt / (ht + 1) AS gain
  FROM cand{d} k JOIN sum{d} s ON k.node = s.node JOIN drawn q ON k.name = q.name WHERE hl >= 1 AND ht - hl >= 1
),
best{d} AS MATERIALIZED (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY node ORDER BY ROUND(gain, 9) DESC, feature, cut NULLS FIRST, level NULLS FIRST) AS rk
                 FROM gain{d} WHERE gain > 1e-6) WHERE rk = 1
),
nd{d + 1} AS MATERIALIZED (
  SELECT n.rid, 2 * n.node + CASE WHEN b.cut IS NOT NULL AND c.x < b.cut OR b.level IS NOT NULL AND c.v <> b.level THEN 0 ELSE 1 END AS node
  FROM nd{d} n JOIN best{d} b ON n.node = b.node JOIN bcell c ON c.rid = n.rid AND c.feature = b.feature
)"""


BOOST = f""",
spw AS (SELECT (1 - AVG(y)) / GREATEST(AVG(y), 1e-6) AS w FROM tr),
brow AS MATERIALIZED (
  SELECT rid, CASE WHEN y = 1 THEN w ELSE 1 END * (CAST(0.5 AS DOUBLE) - y) AS g, CASE WHEN y = 1 THEN w ELSE 1 END * CAST(0.25 AS DOUBLE) AS h
  FROM tr CROSS JOIN spw WHERE {digest('rows:0', 'CAST(hadm_id AS VARCHAR)', 1, 8)} < CAST(FLOOR(0.9::DOUBLE * 4294967296) AS BIGINT)
),
bcell AS MATERIALIZED (
  SELECT n.rid, n.feature, COALESCE(n.x, s.median) AS x, CAST(NULL AS VARCHAR) AS v FROM tr_n n JOIN num s ON n.feature = s.feature
  UNION ALL SELECT q.rid, q.feature, NULL, COALESCE(q.v, m.mode) FROM tr_c q JOIN mode_ m ON q.feature = m.feature
),
named AS (SELECT CASE WHEN level IS NULL THEN feature ELSE feature || '_' || level END AS name FROM cols),
drawn AS MATERIALIZED (
  SELECT name FROM (SELECT name, ROW_NUMBER() OVER (ORDER BY {digest('columns:0', 'name')}, name) AS rk, COUNT(*) OVER () AS n FROM named)
  WHERE rk <= GREATEST(1, FLOOR(0.9::DOUBLE * n))
),
nd0 AS (SELECT rid, 1 AS node FROM brow)""" + _level(0) + _level(1) + """,
last AS (SELECT n.node, SUM(r.g) AS gt, SUM(r.h) AS ht FROM nd2 n JOIN brow r ON n.rid = r.rid GROUP BY n.node),
nodes AS MATERIALIZED (
  SELECT node, feature, cut, level, gain, gt, ht FROM best0
  UNION ALL SELECT node, feature, cut, level, gain, gt, ht FROM best1
  UNION ALL SELECT s.node, NULL, NULL, NULL, NULL, s.gt, s.ht FROM sum1 s WHERE s.node NOT IN (SELECT node FROM best1)
  UNION ALL SELECT node, NULL, NULL, NULL, NULL, gt, ht FROM last
)"""


def model_sql(base: str, featured: str, scored_from_grid: str, rounded, normalized, age: str) -> dict[str, str]:
    """SQL per query.  ``base`` ends with the relations of the adapter and the cohorts,
    ``featured`` is the text of that relation, ``scored_from_grid`` the threshold tuning over
    ``scored2``; the others make rounded columns, cleaned text columns and the age."""
    base = base.rstrip("\n").replace("WITH ", "WITH RECURSIVE ", 1)
    fit = base + SPLIT + STATS + FIT
    sql = {"split_membership": base + SPLIT + "\nSELECT hadm_id, y AS target_long_stay, split FROM sp"}

    p = "1 / (1 + exp(-m))"
    tested = ",\nscored2 AS MATERIALIZED (SELECT t.hadm_id, 'logistic_regression' AS model, t.y AS y_true, CASE WHEN m > 0 THEN 1 ELSE 0 END AS y_pred, " + f"{p} AS y_score FROM te t JOIN te_m s ON t.rid = s.rid)"
    fit_scored = fit + scored("te") + tested
    sql["model_scores"] = fit_scored + f"\nSELECT model, hadm_id, y_true, y_pred, {rounded('y_score', 'y_score')} FROM scored2"
    name = "CASE WHEN c.level IS NULL THEN c.feature ELSE c.feature || '_' || c.level END"
    sql["linear_optimality"] = fit + f"""
SELECT feature, {rounded('b', 'coefficient')}, TRUE AS gradient_is_zero FROM (
  SELECT '(intercept)' AS feature, b FROM beta WHERE j = 0 UNION ALL SELECT {name}, b.b FROM beta b JOIN cols c ON b.j = c.j)"""
    sql["feature_importance"] = fit + f"""
SELECT {name} AS feature, {rounded('b.b', 'coefficient')}, {rounded('ABS(b.b)', 'abs_coefficient')}
FROM beta b JOIN cols c ON b.j = c.j ORDER BY ABS(b.b) DESC, 1 LIMIT 20"""
    features = ", ".join(f"('{c}')" for c in NUMERIC + CATEGORICAL)
    sql["permutation_importance"] = fit + scored("te") + f""",
pos AS MATERIALIZED (SELECT t.rid, t.y, s.m, ROW_NUMBER() OVER (ORDER BY t.hadm_id) AS i FROM te t JOIN te_m s ON t.rid = s.rid),
part AS MATERIALIZED (
  SELECT q.i, q.y, q.m, f.feature, COALESCE(SUM(x.v * b.b), 0) AS part
  FROM pos q CROSS JOIN (VALUES {features}) f(feature)
  LEFT JOIN (te_x x JOIN cols c ON x.j = c.j JOIN beta b ON b.j = x.j) ON x.rid = q.rid AND c.feature = f.feature GROUP BY ALL
),
perm AS (SELECT r.r, q.i AS source, ROW_NUMBER() OVER (PARTITION BY r.r ORDER BY ('0x' || substr(md5('{SEED}:permute:' || r.r || ':' || q.i), 1, 15))::BIGINT, q.i) AS i
         FROM pos q CROSS JOIN range({TREES}) r(r)),
acc AS (
  SELECT o.feature, z.r, AVG(CASE WHEN (o.m > 0) = (o.y = 1) THEN CAST(1 AS DOUBLE) ELSE 0 END) - AVG(CASE WHEN (o.m - o.part + n.part > 0) = (o.y = 1) THEN CAST(1 AS DOUBLE) ELSE 0 END) AS fall
  FROM perm z JOIN part o ON o.i = z.i JOIN part n ON n.i = z.source AND n.feature = o.feature GROUP BY 1, 2
)
SELECT feature, {rounded('AVG(fall)', 'importance_mean')}, {rounded('STDDEV_POP(fall)', 'importance_std')} FROM acc GROUP BY feature"""

    tuned = fit_scored + ",\n" + scored_from_grid
    high, low = "GREATEST(balanced_threshold, recall_priority_threshold)", "LEAST(balanced_threshold, recall_priority_threshold)"
    graded = f"""
SELECT t.hadm_id, {rounded(p, 'risk_probability')}, CASE WHEN {p} >= balanced_threshold THEN 1 ELSE 0 END AS predicted_class,
       CASE WHEN {p} >= {high} THEN 'High' WHEN {p} >= {low} * CAST({C.RISK_MODERATE_FACTOR} AS DOUBLE) THEN 'Moderate' ELSE 'Low' END AS risk_tier,
       'model' AS score_source
FROM {{src}} t JOIN {{src}}_m s ON t.rid = s.rid CROSS JOIN sel"""
    whole = ",\nwhole AS MATERIALIZED (SELECT *, hadm_id AS rid FROM mt)"
    sql["model_risk_scoring"] = tuned + whole + scored("whole") + graded.format(src="whole")
    cleaned = ", ".join(f"{normalized(c)} AS {c}" for c in ("gender", "race", "insurance", "marital_status", "admission_type", "language"))
    raw = f""",
adm_rows AS (
  SELECT * REPLACE ({cleaned}) FROM (
    SELECT a.*, p.gender, p.anchor_age, p.anchor_year FROM admissions a LEFT JOIN pat_first p ON a.subject_id IS NOT DISTINCT FROM p.subject_id
  ), LATERAL (SELECT {age} AS age_at_admit)
),
adm_featured AS ({featured.replace('FROM cohort_clean c', 'FROM adm_rows c')}),
whole AS MATERIALIZED (SELECT *, ROW_NUMBER() OVER () AS rid FROM adm_featured)"""
    sql["artifact_scoring"] = tuned + raw + scored("whole") + graded.format(src="whole")

    boosted = base + SPLIT + STATS + BOOST
    weight = "-gt / (ht + 1) * CAST(0.05 AS DOUBLE)"
    sql["boosted_round"] = boosted + f"""
SELECT 0 AS tree, CAST(node AS INTEGER) AS node, feature, {rounded('cut', 'cut')}, level, {rounded('gain', 'gain')}, {rounded('gt', 'gradient')}, {rounded('ht', 'hessian')},
       {rounded(f'CASE WHEN feature IS NULL THEN {weight} END', 'weight')} FROM nodes"""
    sql["boosted_importance"] = boosted + f""",
means AS (SELECT CASE WHEN level IS NULL THEN feature ELSE feature || '_' || level END AS name, AVG(gain) AS gain FROM nodes WHERE feature IS NOT NULL GROUP BY 1)
SELECT d.name AS feature, {rounded('COALESCE(m.gain, 0) / SUM(COALESCE(m.gain, 0)) OVER ()', 'importance')} FROM named d LEFT JOIN means m ON d.name = m.name"""
    sql["forest_bags"] = base + SPLIT + f""",
lim AS (SELECT k, CAST(FLOOR(4294967296 * list_sum(list_transform(range(0, k + 1), lambda i: exp(-1) / factorial(CAST(i AS INTEGER))))) AS BIGINT) AS below FROM range(12) r(k)),
u AS (SELECT t.tree, q.y, ('0x' || substr(md5('{SEED}:bag:' || (t.tree // 4) || ':' || q.hadm_id), 1 + 8 * (t.tree % 4), 8))::BIGINT AS u, q.hadm_id FROM tr q CROSS JOIN range({TREES}) t(tree)),
drawn_ AS (SELECT u.tree, u.y, u.hadm_id, COUNT(l.k) AS n FROM u LEFT JOIN lim l ON u.u >= l.below GROUP BY ALL)
SELECT CAST(tree AS INTEGER) AS tree, y AS label, COUNT(*) FILTER (n > 0) AS n_rows, CAST(SUM(n) AS BIGINT) AS n_bag,
       {rounded('CAST(SUM(SUM(n)) OVER (PARTITION BY tree) AS DOUBLE) / (COUNT(*) OVER (PARTITION BY tree) * SUM(n))', 'weight')} FROM drawn_ GROUP BY tree, y"""
    sql["tree_importance"] = base + SPLIT + STATS + "\nSELECT CASE WHEN level IS NULL THEN feature ELSE feature || '_' || level END AS feature, TRUE AS equals_fitted FROM cols"
    return sql
