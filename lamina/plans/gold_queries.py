"""Queries of the published layer: enrichment, defaults, decoding, indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.operators import enrich as en
from lamina.operators import indicators as ind
from lamina.plans import oracle as sql
from lamina.plans.registry import register
from lamina.sources.tables import area_dim, fact_frame, read_table, region_dim


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return en.gold_fact(fact_frame(spark, sf_dir), region_dim(spark, sf_dir),
                        area_dim(spark, sf_dir))


def region_name_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A (region_code, name) dimension with several names per key: every
    nation name of the region. Used to show and guard the join fan-out."""
    return read_table(spark, sf_dir, "nation").select(
        (F.col("n_regionkey") + 1).alias("region_code"), F.col("n_name").alias("region_name"))


@register("fact_view", sql.with_gold() + "\nSELECT * FROM fact")
def q_fact_view(spark, sf_dir):
    return fact_frame(spark, sf_dir)


@register("enrich_dimensions", sql.with_gold() + """
SELECT f.*, a.area_name, r.region_name
FROM fact f
LEFT JOIN area_dim a ON f.area_code = a.area_code
LEFT JOIN region_dim r ON f.region_code = r.region_code""")
def q_enrich_dimensions(spark, sf_dir):
    fact = fact_frame(spark, sf_dir)
    out = en.enrich(fact, en.distinct_dim(area_dim(spark, sf_dir), ["area_code", "area_name"]),
                    "area_code")
    return en.enrich(out, en.distinct_dim(region_dim(spark, sf_dir),
                                          ["region_code", "region_name"]), "region_code")


@register("enrich_fanout_check", """
SELECT n_regionkey + 1 AS region_code, COUNT(DISTINCT n_name) AS n_names,
       MIN(n_name) AS first_name, MAX(n_name) AS last_name
FROM nation GROUP BY n_regionkey + 1 HAVING COUNT(DISTINCT n_name) > 1""")
def q_enrich_fanout_check(spark, sf_dir):
    return en.duplicate_keys(region_name_variants(spark, sf_dir), "region_code", "region_name")


@register("enrich_first", sql.with_gold() + """
SELECT f.*, d.region_name
FROM fact f
LEFT JOIN (SELECT n_regionkey + 1 AS region_code, MIN(n_name) AS region_name
           FROM nation GROUP BY n_regionkey + 1) d
  ON f.region_code = d.region_code""")
def q_enrich_first(spark, sf_dir):
    return en.enrich(fact_frame(spark, sf_dir), region_name_variants(spark, sf_dir),
                     "region_code", on_duplicate="first")


@register("fill_defaults", sql.ENRICHED_SELECT)
def q_fill_defaults(spark, sf_dir):
    return en.enrich_fact(fact_frame(spark, sf_dir), region_dim(spark, sf_dir),
                          area_dim(spark, sf_dir))


@register("decode_labels", sql.GOLD_SELECT)
def q_decode_labels(spark, sf_dir):
    return gold(spark, sf_dir)


@register("indicators_area", sql.INDICATORS_AREA)
def q_indicators_area(spark, sf_dir):
    return ind.indicators_for(gold(spark, sf_dir), ind.AREA)


@register("indicators_region", sql.INDICATORS_REGION)
def q_indicators_region(spark, sf_dir):
    return ind.indicators_for(gold(spark, sf_dir), ind.REGION)


@register("indicators_country", sql.INDICATORS_COUNTRY)
def q_indicators_country(spark, sf_dir):
    return ind.indicators_for(gold(spark, sf_dir), ind.COUNTRY)


@register("indicators_all_levels", sql.INDICATORS_ALL)
def q_indicators_all_levels(spark, sf_dir):
    return ind.all_levels(gold(spark, sf_dir))


@register("indicators_grouping_sets", sql.INDICATORS_GROUPING_SETS)
def q_indicators_grouping_sets(spark, sf_dir):
    return ind.grouping_sets_base(gold(spark, sf_dir))
