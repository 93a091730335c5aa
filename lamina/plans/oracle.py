"""Independent SQL (DuckDB dialect) for every SQL-expressible query.

These statements are the correctness oracle: they compute each result
directly from the base tables with plain GROUP BY / window SQL, without the
library's operators (e.g. every indicator level is grouped from the fact, not
rolled up from leaves). Shared building blocks are CTE strings.
"""

from __future__ import annotations


def r2(e: str) -> str:
    """The double's shortest decimal form, rounded half-up to 2 places as a decimal
    (this engine's ROUND of a double scales in binary and misses ties)."""
    return rounded(e, 2)


def rounded(e: str, digits: int) -> str:
    return f"CAST(ROUND(CAST(CAST({e} AS VARCHAR) AS DECIMAL(38,17)), {digits}) AS DOUBLE)"


def rf(e: str, digits: int = 8) -> str:
    """Fine rounding, same rule as ``functions.round_fine``."""
    return f"CAST(ROUND(CAST({e} AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


FACT_CTE = """fact AS (
  SELECT o.o_orderkey AS entity_id,
         CASE WHEN o.o_custkey % 50 = 0 THEN NULL ELSE o.o_custkey END AS group_id,
         CAST(year(o.o_orderdate) AS INT) AS period,
         CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE n.n_regionkey + 1 END AS region_code,
         CASE WHEN o.o_orderkey % 89 = 0 THEN NULL ELSE c.c_nationkey + 1 END AS area_code,
         CASE WHEN o.o_orderkey % 83 = 0 THEN NULL
              ELSE CAST(substr(o.o_orderpriority, 1, 1) AS INT) END AS segment_code,
         CASE WHEN o.o_orderkey % 79 = 0 THEN NULL ELSE o.o_totalprice END AS measure,
         CASE o.o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS outcome,
         CASE WHEN o.o_orderkey % 73 = 0 THEN NULL
              WHEN o.o_orderkey % 10 = 0 THEN 0 ELSE 1 END AS present
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

DIMS_CTE = """area_dim AS (
  SELECT DISTINCT n_nationkey + 1 AS area_code,
         CASE WHEN n_nationkey = 7 THEN '' ELSE n_name END AS area_name
  FROM nation
),
region_dim AS (
  SELECT DISTINCT r_regionkey + 1 AS region_code, r_name AS region_name FROM region
)"""

ENRICHED_CTE = """enriched AS (
  SELECT f.entity_id, f.group_id, f.period,
         COALESCE(f.region_code, 0) AS region_code,
         COALESCE(NULLIF(r.region_name, ''), 'Not informed') AS region_name,
         COALESCE(f.area_code, 0) AS area_code,
         COALESCE(NULLIF(a.area_name, ''), 'Not informed') AS area_name,
         COALESCE(f.segment_code, 0) AS segment_code,
         f.measure, f.outcome, f.present
  FROM fact f
  LEFT JOIN area_dim a ON f.area_code = a.area_code
  LEFT JOIN region_dim r ON f.region_code = r.region_code
)"""

GOLD_CTE = """gold AS (
  SELECT *,
         CASE WHEN outcome = 1 THEN 'Positive' WHEN outcome = 0 THEN 'Negative'
              ELSE 'Unknown' END AS outcome_label,
         CASE WHEN present = 1 THEN 'Present' WHEN present = 0 THEN 'Absent'
              ELSE 'Unknown' END AS present_label,
         CASE WHEN segment_code = 1 THEN 'Federal' WHEN segment_code = 2 THEN 'State'
              WHEN segment_code = 3 THEN 'Municipal' WHEN segment_code = 4 THEN 'Private'
              ELSE 'Unknown' END AS segment_label
  FROM enriched
)"""


def with_gold(*extra: str) -> str:
    """WITH clause holding fact, dims, enriched, gold and any extra CTEs."""
    return "WITH " + ",\n".join([FACT_CTE, DIMS_CTE, ENRICHED_CTE, GOLD_CTE, *extra])


GOLD_SELECT = with_gold() + "\nSELECT * FROM gold"

ENRICHED_SELECT = with_gold() + "\nSELECT * FROM enriched"

INDICATOR_NAMES = ("n_total, n_known, mean_measure, pct_positive, pct_negative, "
                   "prev_n_total, prev_mean_measure, prev_pct_positive, prev_pct_negative, "
                   "delta_mean_measure, delta_pct_positive, delta_pct_negative, growth_pct")


def level_cte(name: str, keys: list[str], window_keys: list[str], order_keys: list[str]) -> str:
    """Indicator block of one level grouped straight from ``gold``."""
    k = ", ".join(keys)
    order = ", ".join(["period", *order_keys])
    return f"""{name}_base AS (
  SELECT period, {k},
         COUNT(*) AS n_total,
         COUNT(outcome) AS n_known,
         {r2('CAST(CAST(SUM(CAST(CAST(measure AS VARCHAR) AS DECIMAL(28,12))) AS VARCHAR) AS DOUBLE) / COUNT(measure)')} AS mean_measure,
         {r2('CAST(SUM(CASE WHEN outcome = 1 THEN 1 ELSE 0 END) AS DOUBLE) / NULLIF(COUNT(outcome), 0) * 100')} AS pct_positive,
         {r2('CAST(SUM(CASE WHEN outcome = 0 THEN 1 ELSE 0 END) AS DOUBLE) / NULLIF(COUNT(outcome), 0) * 100')} AS pct_negative
  FROM gold
  GROUP BY period, {k}
),
{name}_lag AS (
  SELECT *,
         LAG(n_total) OVER w AS prev_n_total,
         LAG(mean_measure) OVER w AS prev_mean_measure,
         LAG(pct_positive) OVER w AS prev_pct_positive,
         LAG(pct_negative) OVER w AS prev_pct_negative
  FROM {name}_base
  WINDOW w AS (PARTITION BY {', '.join(window_keys)} ORDER BY {order})
),
{name} AS (
  SELECT period, {k}, n_total, n_known, mean_measure, pct_positive, pct_negative,
         prev_n_total, prev_mean_measure, prev_pct_positive, prev_pct_negative,
         {r2('mean_measure - prev_mean_measure')} AS delta_mean_measure,
         {r2('pct_positive - prev_pct_positive')} AS delta_pct_positive,
         {r2('pct_negative - prev_pct_negative')} AS delta_pct_negative,
         CASE WHEN prev_n_total > 0
              THEN {r2('CAST(n_total - prev_n_total AS DOUBLE) / prev_n_total * 100')} END AS growth_pct
  FROM {name}_lag
)"""


AREA_CTE = level_cte("area", ["region_code", "region_name", "area_code", "area_name", "segment_code"],
                     ["region_code", "area_code", "segment_code"], ["region_name", "area_name"])
REGION_CTE = level_cte("region", ["region_code", "region_name", "segment_code"],
                       ["region_code", "segment_code"], ["region_name"])
COUNTRY_CTE = level_cte("country", ["segment_code"], ["segment_code"], [])

INDICATORS_AREA = with_gold(AREA_CTE) + "\nSELECT * FROM area"
INDICATORS_REGION = with_gold(REGION_CTE) + "\nSELECT * FROM region"
INDICATORS_COUNTRY = with_gold(COUNTRY_CTE) + "\nSELECT * FROM country"

INDICATORS_ALL = with_gold(AREA_CTE, REGION_CTE, COUNTRY_CTE) + f"""
SELECT period, 'area' AS level, region_code, region_name, area_code, area_name, segment_code,
       {INDICATOR_NAMES} FROM area
UNION ALL
SELECT period, 'region' AS level, region_code, region_name, 0 AS area_code,
       'Not applicable' AS area_name, segment_code, {INDICATOR_NAMES} FROM region
UNION ALL
SELECT period, 'country' AS level, 0 AS region_code, 'All' AS region_name, 0 AS area_code,
       'All' AS area_name, segment_code, {INDICATOR_NAMES} FROM country"""

INDICATORS_GROUPING_SETS = with_gold(AREA_CTE, REGION_CTE, COUNTRY_CTE) + """
SELECT period, 'area' AS level, region_code, region_name, area_code, area_name, segment_code,
       n_total, n_known, mean_measure, pct_positive, pct_negative FROM area
UNION ALL
SELECT period, 'region', region_code, region_name, 0, 'Not applicable', segment_code,
       n_total, n_known, mean_measure, pct_positive, pct_negative FROM region
UNION ALL
SELECT period, 'country', 0, 'All', 0, 'All', segment_code,
       n_total, n_known, mean_measure, pct_positive, pct_negative FROM country"""
