"""Properties on the driver's tables (sf0.01)."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lamina.operators import indicators as ind
from lamina.plans.gold_queries import gold
from tests.conftest import SF_ORACLE

Q = entry.queries()


@pytest.fixture(scope="module")
def levels(spark):
    return Q["indicators_all_levels"](spark, SF_ORACLE).persist()


def test_rollup_totals_agree_across_levels(spark, levels):
    per = (levels.groupBy("period", "level").agg(F.sum("n_total").alias("n"),
                                                 F.sum("n_known").alias("k"))
           .groupBy("period").agg(F.collect_set("n").alias("ns"), F.collect_set("k").alias("ks"))
           .collect())
    fact = {r.period: r["count"] for r in gold(spark, SF_ORACLE).groupBy("period").count().collect()}
    for r in per:
        assert len(r.ns) == 1 and len(r.ks) == 1
        assert r.ns[0] == fact[r.period]


def test_percentages_sum_to_100(spark, levels):
    bad = levels.where((F.col("n_known") > 0) &
                       (F.abs(F.col("pct_positive") + F.col("pct_negative") - 100) > 0.011))
    assert bad.count() == 0
    assert levels.where((F.col("n_known") == 0) & F.col("pct_positive").isNotNull()).count() == 0


def test_first_period_has_no_lag(spark, levels):
    keys = {"area": ind.AREA.window_keys, "region": ind.REGION.window_keys,
            "country": ind.COUNTRY.window_keys}
    for level, wk in keys.items():
        part = levels.where(F.col("level") == level)
        w = Window.partitionBy(*wk).orderBy("period", "region_name", "area_name")
        first = part.withColumn("rn", F.row_number().over(w)).where(F.col("rn") == 1)
        assert first.where(F.col("prev_n_total").isNotNull()).count() == 0
        later = part.withColumn("rn", F.row_number().over(w)).where(F.col("rn") > 1)
        assert later.where(F.col("prev_n_total").isNull()).count() == 0


def test_leaf_rollup_equals_grouping_sets(spark, levels):
    gs = Q["indicators_grouping_sets"](spark, SF_ORACLE)
    cols = ["period", "level", *ind.ALL_LEVEL_KEYS, *ind.MEASURE_COLUMNS]
    a = levels.select(*cols)
    assert a.exceptAll(gs.select(*cols)).count() == 0
    assert gs.select(*cols).exceptAll(a).count() == 0


def test_each_row_in_exactly_one_split(spark):
    hashed = Q["split_hash"](spark, SF_ORACLE)
    exact = Q["split_exact"](spark, SF_ORACLE)
    for df in (hashed, exact):
        assert df.groupBy("entity_id").count().where(F.col("count") != 1).count() == 0
        assert set(r.split for r in df.select("split").distinct().collect()) == \
            {"train", "validation", "test"}
    assert hashed.count() == exact.count()


def test_sample_drops_null_outcomes_and_keeps_ratio(spark):
    from lamina.plans.ml_queries import model_base

    s = Q["sample_stratified_hash"](spark, SF_ORACLE)
    assert s.where(F.col("outcome").isNull()).count() == 0
    mf = model_base(spark, SF_ORACLE)
    total, labeled = mf.count(), mf.where(F.col("outcome").isNotNull()).count()
    expected = 5000 * labeled / total  # fraction of all rows; null outcomes drop out
    assert abs(s.count() - expected) < 0.1 * expected


def test_group_rate_null_group_is_one_group(spark):
    g = Q["group_smoothed_rate"](spark, SF_ORACLE)
    rates = g.where(F.col("group_id").isNull()).select("group_rate", "group_volume").distinct()
    assert rates.count() == 1
