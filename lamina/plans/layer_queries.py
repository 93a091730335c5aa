"""Queries of the raw and clean layers and of the profiling reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamina.operators import clean as cl
from lamina.operators import indicators as ind
from lamina.operators import ingest as ing
from lamina.operators import profile as pr
from lamina.plans import oracle as sql
from lamina.plans.gold_queries import gold
from lamina.plans.joins import sized_broadcast
from lamina.plans.registry import register
from lamina.sources.tables import fact_frame, period_slices, read_table

# -- raw layer -----------------------------------------------------------------


@register("ingest_stack", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CASE WHEN year(o_orderdate) >= 1998 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
       CAST(year(o_orderdate) AS INT) AS o_year, 'batch' AS origin
FROM orders""")
def q_ingest_stack(spark, sf_dir):
    stacked = ing.stack_periods(period_slices(spark, sf_dir), origin="batch")
    return stacked.drop(ing.INGESTED_AT)


@register("ingest_lineage_single_ts", """
SELECT COUNT(*) AS n_rows, CAST(1 AS BIGINT) AS n_ingest_times FROM orders""")
def q_ingest_lineage_single_ts(spark, sf_dir):
    """Every stacked row carries the same ingestion time (one per query)."""
    stacked = ing.stack_periods(period_slices(spark, sf_dir), origin="batch")
    return stacked.agg(F.count(F.lit(1)).alias("n_rows"),
                       F.count_distinct(ing.INGESTED_AT).alias("n_ingest_times"))


@register("table_counts", """
SELECT 'orders' AS table_name, COUNT(*) AS n_rows FROM orders
UNION ALL SELECT 'customer', COUNT(*) FROM customer
UNION ALL SELECT 'nation', COUNT(*) FROM nation
UNION ALL SELECT 'region', COUNT(*) FROM region
UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem""")
def q_table_counts(spark, sf_dir):
    return pr.table_counts({t: read_table(spark, sf_dir, t)
                            for t in ("orders", "customer", "nation", "region", "lineitem")})


# -- clean layer ---------------------------------------------------------------

MIXED_CASE = {"c_custkey": "C_CustKey", "c_name": "C_NAME", "c_nationkey": "c_NationKey",
              "c_acctbal": "C_AcctBal", "c_mktsegment": "C_MktSegment"}


@register("clean_names", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q_clean_names(spark, sf_dir):
    src = read_table(spark, sf_dir, "customer").select(
        *[F.col(k).alias(v) for k, v in MIXED_CASE.items()])
    return cl.lower_names(src)


def padded_customers(spark, sf_dir):
    """Customer text padded and lower-cased, as raw text arrives."""
    return read_table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lit("  "), F.lower("c_name"), F.lit(" ")).alias("c_name"),
        F.concat(F.lit(" "), F.lower("c_mktsegment")).alias("c_mktsegment"),
        "c_acctbal")


@register("clean_text", """
SELECT c_custkey, trim(concat('  ', lower(c_name), ' ')) AS c_name,
       upper(trim(concat(' ', lower(c_mktsegment)))) AS c_mktsegment, c_acctbal
FROM customer""")
def q_clean_text(spark, sf_dir):
    return cl.trim_strings(padded_customers(spark, sf_dir), upper=("c_mktsegment",))


def customers_with_copies(spark, sf_dir):
    """Every customer three times: twice as is, once with a trailing space."""
    base = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    padded = base.withColumn("c_name", F.concat("c_name", F.lit(" ")))
    return base.unionAll(base).unionAll(padded)


@register("dedup_rows", """
SELECT c_custkey, trim(c_name) AS c_name, trim(c_mktsegment) AS c_mktsegment
FROM (SELECT DISTINCT * FROM (
        SELECT c_custkey, c_name, c_mktsegment FROM customer
        UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer
        UNION ALL SELECT c_custkey, c_name || ' ', c_mktsegment FROM customer))""")
def q_dedup_rows(spark, sf_dir):
    return cl.clean_table(customers_with_copies(spark, sf_dir))


@register("dedup_rows_trim_first", """
SELECT DISTINCT c_custkey, trim(c_name) AS c_name, trim(c_mktsegment) AS c_mktsegment
FROM customer""")
def q_dedup_rows_trim_first(spark, sf_dir):
    return cl.clean_table(customers_with_copies(spark, sf_dir), trim_first=True)


@register("dimension_distinct", """
SELECT DISTINCT n_regionkey + 1 AS region_code, r_name AS region_name
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def q_dimension_distinct(spark, sf_dir):
    """Distinct projection of a denormalised dimension (one row per nation)."""
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    wide = nation.join(sized_broadcast(region), nation.n_regionkey == region.r_regionkey)
    return wide.select((F.col("n_regionkey") + 1).alias("region_code"),
                       F.col("r_name").alias("region_name")).distinct()


def raw_fact(spark, sf_dir):
    """The fact as a raw table loaded twice (two overlapping deliveries)."""
    f = fact_frame(spark, sf_dir)
    return f.unionAll(f)


@register("clean_fact", sql.with_gold() + """
SELECT DISTINCT * FROM fact WHERE present = 1 AND measure IS NOT NULL""")
def q_clean_fact(spark, sf_dir):
    return cl.clean_fact(raw_fact(spark, sf_dir))


@register("clean_audit", sql.with_gold() + """
SELECT 2 * COUNT(*) AS n_input, COUNT(*) AS n_distinct,
       COUNT(CASE WHEN present = 1 THEN 1 END) AS n_present,
       COUNT(CASE WHEN present = 1 AND measure IS NOT NULL THEN 1 END) AS n_clean
FROM fact""")
def q_clean_audit(spark, sf_dir):
    return cl.clean_audit(raw_fact(spark, sf_dir))


# -- profiles of the published fact ------------------------------------------

GOLD_COLS = ("entity_id", "group_id", "period", "region_code", "region_name", "area_code",
             "area_name", "segment_code", "measure", "outcome", "present", "outcome_label",
             "present_label", "segment_label")


@register("null_profile", sql.with_gold() + "\nSELECT " + ",\n".join(
    f"COUNT(*) - COUNT({c}) AS {c}" for c in GOLD_COLS) + "\nFROM gold")
def q_null_profile(spark, sf_dir):
    return pr.null_profile(gold(spark, sf_dir))


@register("null_profile_long", sql.with_gold() + "\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS n_null FROM gold" for c in GOLD_COLS))
def q_null_profile_long(spark, sf_dir):
    return pr.null_profile_long(gold(spark, sf_dir))


@register("table_shape", sql.with_gold() + f"""
SELECT COUNT(*) AS n_rows, {len(GOLD_COLS)} AS n_columns FROM gold""")
def q_table_shape(spark, sf_dir):
    return pr.table_shape(gold(spark, sf_dir))


@register("value_distribution", sql.with_gold() + f"""
SELECT outcome, COUNT(*) AS n,
       {sql.r2('CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER () * 100')} AS pct
FROM gold GROUP BY outcome""")
def q_value_distribution(spark, sf_dir):
    return pr.value_distribution(gold(spark, sf_dir), "outcome")


@register("pair_distribution", sql.with_gold() + """
SELECT present, present_label, COUNT(*) AS n FROM gold GROUP BY present, present_label""")
def q_pair_distribution(spark, sf_dir):
    return pr.pair_distribution(gold(spark, sf_dir), ["present", "present_label"])


@register("duplicate_key_report", """
SELECT l_linenumber, l_orderkey, l_returnflag, l_linestatus, COUNT(*) AS n_rows
FROM lineitem
WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem
                     GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)
GROUP BY l_linenumber, l_orderkey, l_returnflag, l_linestatus""")
def q_duplicate_key_report(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return pr.duplicate_key_report(li, "l_orderkey", "l_linenumber",
                                   ["l_returnflag", "l_linestatus"])


@register("preview_topn", sql.with_gold() + "\nSELECT * FROM gold ORDER BY entity_id LIMIT 20")
def q_preview_topn(spark, sf_dir):
    return gold(spark, sf_dir).orderBy("entity_id").limit(20)


@register("dimension_first", sql.with_gold(sql.AREA_CTE) + """
SELECT DISTINCT period, region_code, region_name, area_code, area_name, segment_code
FROM area ORDER BY period, region_code, region_name, area_code, area_name, segment_code LIMIT 1""")
def q_dimension_first(spark, sf_dir):
    keys = ["period", *ind.AREA.keys]
    area = ind.indicators_for(gold(spark, sf_dir), ind.AREA)
    return area.select(*keys).distinct().orderBy(*keys).limit(1)
