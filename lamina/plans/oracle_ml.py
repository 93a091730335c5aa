"""Oracle SQL (DuckDB dialect) for the modelling-stage queries."""

from __future__ import annotations

from lamina import fixed
from lamina.plans.oracle import AREA_CTE, rf, rounded, with_gold

NUMERIC = ("region_code", "segment_code", "n_total", "n_known", "prev_n_total",
           "prev_mean_measure", "prev_pct_positive", "prev_pct_negative", "delta_mean_measure",
           "delta_pct_positive", "delta_pct_negative", "growth_pct", "group_rate", "group_volume")
CATEGORICAL = ("group_id", "region_name", "segment_label")
INDICATOR_VALUES = ("n_total", "n_known", "mean_measure", "pct_positive", "pct_negative",
                    "prev_n_total", "prev_mean_measure", "prev_pct_positive", "prev_pct_negative",
                    "delta_mean_measure", "delta_pct_positive", "delta_pct_negative", "growth_pct")


def h32(id_expr: str, salt: str) -> str:
    return f"(('0x' || substr(md5(CAST({id_expr} AS VARCHAR) || '{salt}'), 1, 8))::BIGINT)"


GROUP_RATE_CTE = """grp AS (
  SELECT group_id,
         (CAST(SUM(outcome) AS DOUBLE) + 5) / (CAST(COUNT(outcome) AS DOUBLE) + 10) AS group_rate,
         COUNT(outcome) AS group_volume
  FROM gold GROUP BY group_id
)"""

JOINED_CTE = f"""joined AS (
  SELECT g.*, {', '.join('a.' + c for c in INDICATOR_VALUES)}
  FROM gold g
  LEFT JOIN area a ON g.period = a.period AND g.region_code = a.region_code
                  AND g.area_code = a.area_code AND g.segment_code = a.segment_code
)"""

MF_CTE = f"""mf AS (
  SELECT j.*, grp.group_rate, grp.group_volume,
         CASE WHEN {h32('j.entity_id', '|split42')} % 100 < 70 THEN 'train'
              WHEN {h32('j.entity_id', '|split42')} % 100 < 85 THEN 'validation'
              ELSE 'test' END AS split,
         CAST({h32('j.entity_id', '|fold42')} % 5 AS INTEGER) AS fold
  FROM joined j LEFT JOIN grp ON j.group_id IS NOT DISTINCT FROM grp.group_id
),
labeled AS (SELECT * FROM mf WHERE outcome IS NOT NULL),
train AS (SELECT * FROM labeled WHERE split = 'train')"""


def with_mf(*extra: str) -> str:
    return with_gold(AREA_CTE, GROUP_RATE_CTE, JOINED_CTE, MF_CTE, *extra)


JOIN_FACT_INDICATOR = with_gold(AREA_CTE, JOINED_CTE) + "\nSELECT * FROM joined"

GROUP_SMOOTHED_RATE = with_gold(GROUP_RATE_CTE) + """
SELECT g.entity_id, g.group_id, grp.group_rate, grp.group_volume
FROM gold g LEFT JOIN grp ON g.group_id IS NOT DISTINCT FROM grp.group_id"""

GROUP_RATE_EXCLUDE_SELF = with_gold() + """,
stats AS (SELECT group_id, CAST(SUM(outcome) AS DOUBLE) AS s, COUNT(outcome) AS c
          FROM gold GROUP BY group_id),
loo AS (
  SELECT g.entity_id, g.group_id,
         st.s - COALESCE(CAST(g.outcome AS DOUBLE), 0) AS s2,
         st.c - CASE WHEN g.outcome IS NOT NULL THEN 1 ELSE 0 END AS c2
  FROM gold g LEFT JOIN stats st ON g.group_id IS NOT DISTINCT FROM st.group_id
)
SELECT entity_id, group_id,
       (CASE WHEN c2 > 0 THEN s2 END + 5) / (CAST(c2 AS DOUBLE) + 10) AS group_rate,
       c2 AS group_volume
FROM loo"""

SELECT_FEATURES = with_mf() + f"""
SELECT entity_id, {', '.join(NUMERIC)}, {', '.join(CATEGORICAL)}, outcome FROM mf"""

CLASS_BALANCE = with_mf() + """
SELECT COUNT(CASE WHEN outcome = 0 THEN 1 END) AS n_neg,
       COUNT(CASE WHEN outcome = 1 THEN 1 END) AS n_pos,
       CAST(COUNT(CASE WHEN outcome = 0 THEN 1 END) AS DOUBLE)
         / GREATEST(1, COUNT(CASE WHEN outcome = 1 THEN 1 END)) AS imbalance_ratio
FROM mf"""

SPLIT_HASH = with_mf() + "\nSELECT entity_id, outcome, split FROM labeled"

SPLIT_EXACT = with_mf() + f""",
ranked AS (
  SELECT entity_id, outcome,
         ROW_NUMBER() OVER (PARTITION BY outcome ORDER BY {h32('entity_id', '|split42')}, entity_id) - 1 AS r,
         COUNT(*) OVER (PARTITION BY outcome) AS n
  FROM labeled
)
SELECT entity_id, outcome,
       CASE WHEN r < FLOOR(n * 70 / 100) THEN 'train'
            WHEN r < FLOOR(n * 85 / 100) THEN 'validation' ELSE 'test' END AS split
FROM ranked"""


def sample_sql(target_rows: int) -> str:
    return with_mf() + f"""
SELECT entity_id, outcome FROM mf
WHERE outcome IN (0, 1)
  AND {h32('entity_id', '|sample42')} < CAST({target_rows} AS DOUBLE) / (SELECT COUNT(*) FROM mf) * CAST(4294967296 AS DOUBLE)"""


MEDIANS = "med AS (SELECT " + ", ".join(
    f"median(CAST({c} AS DOUBLE)) AS {c}" for c in NUMERIC) + " FROM train)"
IMPUTED = "imputed AS (SELECT l.entity_id, l.outcome, l.split, " + ", ".join(
    f"COALESCE(CAST(l.{c} AS DOUBLE), med.{c}) AS {c}" for c in NUMERIC) + \
    " FROM labeled l CROSS JOIN med)"

IMPUTE_MEDIAN = with_mf(MEDIANS, IMPUTED) + "\nSELECT entity_id, " + ", ".join(
    f"{rf(c)} AS {c}" for c in NUMERIC) + " FROM imputed"

MOMENTS = "mom AS (SELECT " + ", ".join(
    f"AVG({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s_{c}"
    for c in NUMERIC) + " FROM imputed WHERE split = 'train')"

STANDARDIZE = with_mf(MEDIANS, IMPUTED, MOMENTS) + "\nSELECT entity_id, " + ", ".join(
    f"{rf(f'({c} - m_{c}) / s_{c}')} AS {c}" for c in NUMERIC) + " FROM imputed CROSS JOIN mom"


def _mode_cte(c: str, numeric: bool) -> str:
    order = f"TRY_CAST({c} AS DOUBLE) ASC, " if numeric else ""
    return f"""mode_{c} AS (
  SELECT CAST({c} AS VARCHAR) AS v FROM train WHERE {c} IS NOT NULL
  GROUP BY {c} ORDER BY COUNT(*) DESC, {order}CAST({c} AS VARCHAR) ASC LIMIT 1
)"""


MODES = ",\n".join(_mode_cte(c, c == "group_id") for c in CATEGORICAL)
CAT_IMPUTED = "cat_imputed AS (SELECT l.entity_id, l.outcome, l.split, l.fold, " + ", ".join(
    f"COALESCE(CAST(l.{c} AS VARCHAR), (SELECT v FROM mode_{c})) AS {c}" for c in CATEGORICAL) + \
    " FROM labeled l)"

IMPUTE_MODE = with_mf(MODES, CAT_IMPUTED) + "\nSELECT entity_id, " + ", ".join(CATEGORICAL) + \
    " FROM cat_imputed"

LONG_TRAIN = "long_train AS (" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS category, fold, outcome FROM cat_imputed WHERE split = 'train'"
    for c in CATEGORICAL) + ")"


def _encode(n: str, s: str, gm: str) -> str:
    mean_c = f"({s} / {n})"
    var_c = f"({mean_c} * (1.0 - {mean_c}))"
    num = f"({n} * ({gm} * (1.0 - {gm})))"
    lam = f"(CASE WHEN {num} + {var_c} = 0 THEN 0.0 ELSE {num} / ({num} + {var_c}) END)"
    return f"{lam} * {mean_c} + (1.0 - {lam}) * {gm}"


TARGET_ENCODE = with_mf(MODES, CAT_IMPUTED, LONG_TRAIN) + f""",
gm AS (SELECT CAST(SUM(outcome) AS DOUBLE) / COUNT(*) AS gm FROM long_train WHERE feature = 'group_id'),
st AS (SELECT feature, category, CAST(COUNT(*) AS DOUBLE) AS n, CAST(SUM(outcome) AS DOUBLE) AS s
       FROM long_train GROUP BY feature, category)
SELECT feature, category, n, {rf(_encode('n', 's', 'gm'))} AS encoding
FROM st CROSS JOIN gm"""

TARGET_ENCODE_OOF = with_mf(MODES, CAT_IMPUTED, LONG_TRAIN) + f""",
fold_tot AS (SELECT fold, COUNT(*) AS fn, SUM(outcome) AS fs FROM long_train
             WHERE feature = 'group_id' GROUP BY fold),
gm AS (SELECT fold, CAST((SELECT SUM(fs) FROM fold_tot) - fs AS DOUBLE)
                    / ((SELECT SUM(fn) FROM fold_tot) - fn) AS gm FROM fold_tot),
pf AS (SELECT feature, category, fold, CAST(COUNT(*) AS DOUBLE) AS n,
              CAST(SUM(outcome) AS DOUBLE) AS s FROM long_train GROUP BY feature, category, fold),
tot AS (SELECT feature, category, SUM(n) AS tn, SUM(s) AS ts FROM pf GROUP BY feature, category)
SELECT pf.feature, pf.category, pf.fold, tot.tn - pf.n AS n_out,
       {rf(f"CASE WHEN tot.tn - pf.n > 0 THEN {_encode('(tot.tn - pf.n)', '(tot.ts - pf.s)', 'gm.gm')} ELSE gm.gm END")} AS encoding
FROM pf JOIN tot USING (feature, category) JOIN gm USING (fold)"""

CLASS_WEIGHTS = with_mf() + f"""
SELECT COUNT(*) AS n, COUNT(CASE WHEN outcome = 0 THEN 1 END) AS n_neg,
       COUNT(CASE WHEN outcome = 1 THEN 1 END) AS n_pos,
       {rf("CAST(COUNT(*) AS DOUBLE) / (2 * COUNT(CASE WHEN outcome = 0 THEN 1 END))")} AS weight_0,
       {rf("CAST(COUNT(*) AS DOUBLE) / (2 * COUNT(CASE WHEN outcome = 1 THEN 1 END))")} AS weight_1,
       {rf("CAST(COUNT(CASE WHEN outcome = 0 THEN 1 END) AS DOUBLE) / GREATEST(1, COUNT(CASE WHEN outcome = 1 THEN 1 END))")} AS scale_pos_weight
FROM train"""

# -- evaluation frame: order-level scores -----------------------------------------

EVAL_CTE = f"""cust AS (
  SELECT o_custkey, (CAST(SUM(y) AS DOUBLE) + 5) / (CAST(COUNT(y) AS DOUBLE) + 10) AS rate
  FROM (SELECT o_custkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS y FROM orders)
  GROUP BY o_custkey
),
ev_all AS (
  SELECT o.o_orderkey AS entity_id,
         CASE o.o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS outcome,
         o.o_totalprice / 500000 AS score_price,
         1 - o.o_totalprice / 500000 AS score_inverse,
         c.rate AS score_group,
         CASE WHEN {h32('o.o_orderkey', '|split42')} % 100 < 70 THEN 'train'
              WHEN {h32('o.o_orderkey', '|split42')} % 100 < 85 THEN 'validation'
              ELSE 'test' END AS split
  FROM orders o LEFT JOIN cust c ON o.o_custkey = c.o_custkey
),
ev AS (SELECT * FROM ev_all WHERE outcome IS NOT NULL AND split = 'validation'),
ev_test AS (SELECT * FROM ev_all WHERE outcome IS NOT NULL AND split = 'test')"""


def _auc_sql(src: str, score: str, group: str | None = None) -> str:
    g = f"{group}, " if group else ""
    part = f"PARTITION BY {group} " if group else ""
    return f"""(
  SELECT {g}{rf('SUM(n_pos * (COALESCE(neg_below, 0) + 0.5 * n_neg)) / (SUM(n_pos) * SUM(n_neg))')} AS roc_auc
  FROM (
    SELECT {g}n_pos, n_neg,
           SUM(n_neg) OVER ({part}ORDER BY {score} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS neg_below
    FROM (SELECT {g}{score}, CAST(COUNT(CASE WHEN outcome = 1 THEN 1 END) AS DOUBLE) AS n_pos,
                 CAST(COUNT(CASE WHEN outcome = 0 THEN 1 END) AS DOUBLE) AS n_neg
          FROM {src} GROUP BY {g}{score})
  ) {('GROUP BY ' + group) if group else ''}
)"""


def _cells(src: str, score: str, threshold: str, strict: bool, group: str | None = None) -> str:
    op = ">" if strict else ">="
    g = f"{group}, " if group else ""
    return f"""(
  SELECT {g}COUNT(CASE WHEN outcome = 1 AND {score} {op} {threshold} THEN 1 END) AS tp,
         COUNT(CASE WHEN outcome = 0 AND {score} {op} {threshold} THEN 1 END) AS fp,
         COUNT(CASE WHEN outcome = 1 AND NOT ({score} {op} {threshold}) THEN 1 END) AS fn,
         COUNT(CASE WHEN outcome = 0 AND NOT ({score} {op} {threshold}) THEN 1 END) AS tn
  FROM {src} {('GROUP BY ' + group) if group else ''}
)"""


def _sd(num: str, den: str) -> str:
    return f"(CASE WHEN ({den}) = 0 THEN 0.0 ELSE CAST({num} AS DOUBLE) / ({den}) END)"


METRIC_SELECT = ", ".join([
    f"{rf(_sd('tp + tn', 'tp + fp + fn + tn'))} AS accuracy",
    f"{rf(_sd('2 * tp', '2 * tp + fp + fn'))} AS f1",
    f"{rf('(' + _sd('2 * tp', '2 * tp + fp + fn') + ' + ' + _sd('2 * tn', '2 * tn + fn + fp') + ') / 2.0')} AS f1_macro",
    f"{rf(_sd('tn', 'tn + fp'))} AS recall_class0",
])

BINARY_METRICS = "WITH " + EVAL_CTE + f"""
SELECT {METRIC_SELECT}, a.roc_auc
FROM {_cells('ev', 'score_price', '0.5', True)} c CROSS JOIN {_auc_sql('ev', 'score_price')} a"""

MODELS = (("price", "score_price", 0), ("inverse", "score_inverse", 1), ("group", "score_group", 2))

EV_LONG = "ev_long AS (" + "\nUNION ALL ".join(
    f"SELECT '{m}' AS model, {o} AS model_order, outcome, {s} AS score FROM ev"
    for m, s, o in MODELS) + ")"

METRICS_TABLE = "WITH " + EVAL_CTE + ",\n" + EV_LONG + f""",
cells AS {_cells('ev_long', 'score', '0.5', True, 'model')},
auc AS {_auc_sql('ev_long', 'score', 'model')},
metrics AS (
  SELECT c.model, {METRIC_SELECT}, auc.roc_auc FROM cells c JOIN auc USING (model)
)"""

METRICS_TABLE_SELECT = METRICS_TABLE + """
SELECT m.*, o.model_order FROM metrics m
JOIN (SELECT DISTINCT model, model_order FROM ev_long) o USING (model)"""

CHAMPION = METRICS_TABLE + """,
with_order AS (SELECT m.*, o.model_order FROM metrics m
               JOIN (SELECT DISTINCT model, model_order FROM ev_long) o USING (model))
SELECT * FROM with_order ORDER BY roc_auc DESC, model_order ASC LIMIT 1"""

ROC_AUC = "WITH " + EVAL_CTE + "\nSELECT roc_auc FROM " + _auc_sql("ev", "score_price")

ROC_CURVE = "WITH " + EVAL_CTE + f""",
per AS (SELECT score_price AS threshold,
               COUNT(CASE WHEN outcome = 1 THEN 1 END) AS n_pos,
               COUNT(CASE WHEN outcome = 0 THEN 1 END) AS n_neg
        FROM ev GROUP BY score_price),
tot AS (SELECT SUM(n_pos) AS P, SUM(n_neg) AS N FROM per)
SELECT threshold,
       {rf('CAST(SUM(n_neg) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / N')} AS fpr,
       {rf('CAST(SUM(n_pos) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / P')} AS tpr
FROM per CROSS JOIN tot"""

ROC_BENDS = "WITH " + EVAL_CTE + f""",
per AS (SELECT score_price AS threshold,
               COUNT(CASE WHEN outcome = 1 THEN 1 END) AS n_pos,
               COUNT(CASE WHEN outcome = 0 THEN 1 END) AS n_neg
        FROM ev GROUP BY score_price),
seen AS (SELECT *, SUM(n_neg) OVER up AS fp, SUM(n_pos) OVER up AS tp, SUM(n_pos) OVER () AS P, SUM(n_neg) OVER () AS N,
                ROW_NUMBER() OVER (ORDER BY threshold DESC) AS i,
                LEAD(n_pos) OVER (ORDER BY threshold DESC) AS next_pos,
                LEAD(n_neg) OVER (ORDER BY threshold DESC) AS next_neg
         FROM per WINDOW up AS (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT CAST('infinity' AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL
SELECT threshold, {rf('CAST(fp AS DOUBLE) / N')}, {rf('CAST(tp AS DOUBLE) / P')}
FROM seen WHERE i = 1 OR next_pos IS NULL OR next_pos != n_pos OR next_neg != n_neg"""

SWEEP_CTE = f"""sweep AS (
  SELECT CAST(40 + i AS DOUBLE) / 100 AS threshold,
         COUNT(CASE WHEN outcome = 0 AND score_price < CAST(40 + i AS DOUBLE) / 100 THEN 1 END) AS tp,
         COUNT(CASE WHEN outcome = 1 AND score_price < CAST(40 + i AS DOUBLE) / 100 THEN 1 END) AS fp,
         COUNT(CASE WHEN outcome = 0 AND score_price >= CAST(40 + i AS DOUBLE) / 100 THEN 1 END) AS fn
  FROM ev CROSS JOIN (SELECT range AS i FROM range(36)) t
  GROUP BY i
),
sweep_f1 AS (
  SELECT threshold, tp, fp, fn, {rf(_sd('2 * tp', '2 * tp + fp + fn'))} AS f1_class0 FROM sweep
),
best AS (
  SELECT CASE WHEN f1_class0 > 0 THEN threshold ELSE 0.5 END AS threshold, f1_class0
  FROM sweep_f1 ORDER BY f1_class0 DESC, threshold ASC LIMIT 1
)"""

THRESHOLD_SWEEP = "WITH " + EVAL_CTE + ",\n" + SWEEP_CTE + "\nSELECT * FROM sweep_f1"
BEST_THRESHOLD = "WITH " + EVAL_CTE + ",\n" + SWEEP_CTE + "\nSELECT * FROM best"

CONFUSION = "WITH " + EVAL_CTE + ",\n" + SWEEP_CTE + f""",
cells AS {_cells('ev_test', 'score_price', '(SELECT threshold FROM best)', False)}
SELECT 1 AS actual, 1 AS predicted, tp AS n FROM cells
UNION ALL SELECT 0, 1, fp FROM cells
UNION ALL SELECT 1, 0, fn FROM cells
UNION ALL SELECT 0, 0, tn FROM cells"""

REPORT = "WITH " + EVAL_CTE + ",\n" + SWEEP_CTE + f""",
cells AS {_cells('ev_test', 'score_price', '(SELECT threshold FROM best)', False)},
m AS (
  SELECT {_sd('tn', 'tn + fn')} AS p0, {_sd('tn', 'tn + fp')} AS r0,
         {_sd('tp', 'tp + fp')} AS p1, {_sd('tp', 'tp + fn')} AS r1,
         tn + fp AS s0, tp + fn AS s1, tp + fp + fn + tn AS n,
         {_sd('tp + tn', 'tp + fp + fn + tn')} AS acc
  FROM cells
),
f AS (SELECT *, {_sd('2 * p0 * r0', 'p0 + r0')} AS f0, {_sd('2 * p1 * r1', 'p1 + r1')} AS f1,
             {_sd('s0', 'n')} AS w0, {_sd('s1', 'n')} AS w1 FROM m)
SELECT '0' AS label, {rf('p0')} AS precision, {rf('r0')} AS recall, {rf('f0')} AS f1, s0 AS support FROM f
UNION ALL SELECT '1', {rf('p1')}, {rf('r1')}, {rf('f1')}, s1 FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, {rf('acc')}, n FROM f
UNION ALL SELECT 'macro avg', {rf('(p0 + p1) / 2')}, {rf('(r0 + r1) / 2')}, {rf('(f0 + f1) / 2')}, n FROM f
UNION ALL SELECT 'weighted avg', {rf('p0 * w0 + p1 * w1')}, {rf('r0 * w0 + r1 * w1')},
                 {rf('f0 * w0 + f1 * w1')}, n FROM f"""

RISK_TIER = "WITH " + EVAL_CTE + f""",
pct AS (SELECT entity_id, outcome, score_price, {rounded('score_price * 100', 2)} AS score_pct FROM ev_test)
SELECT entity_id, outcome, score_price, score_pct,
       CASE WHEN score_pct < {fixed.RISK_HIGH_BELOW} THEN 'High'
            WHEN score_pct >= {fixed.RISK_HIGH_BELOW} AND score_pct < {fixed.RISK_LOW_FROM} THEN 'Medium'
            WHEN score_pct >= {fixed.RISK_LOW_FROM} THEN 'Low' ELSE 'N/A' END AS risk_tier
FROM pct"""

ATTRIBUTION_WEIGHTS = {"score_price": 2.0, "score_inverse": -1.0, "score_group": 3.0}

ATTRIBUTION_LINEAR = "WITH " + EVAL_CTE + ",\n" + "phi AS (" + "\nUNION ALL ".join(
    f"SELECT '{f}' AS feature, {w} * ({f} - (SELECT AVG({f}) FROM ev_all WHERE outcome IS NOT NULL "
    f"AND split = 'train')) AS v FROM ev_test" for f, w in ATTRIBUTION_WEIGHTS.items()) + f""")
SELECT feature, {rf('AVG(ABS(v))')} AS mean_abs, {rf('AVG(v)')} AS mean_value,
       CAST(RANK() OVER (ORDER BY {rf('AVG(ABS(v))')} DESC) AS INTEGER) AS rank
FROM phi GROUP BY feature"""
