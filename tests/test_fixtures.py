"""Hand-computed micro-fixtures (FIXTURES.md section 3)."""

import math

import pytest
from pyspark.sql import functions as F

from lamina.functions.exprs import SEGMENT_LABELS, decode, risk_tier
from lamina.model import evaluate as ev
from lamina.model import prep
from lamina.operators import clean as cl
from lamina.operators import enrich as en
from lamina.operators import features as fe
from lamina.operators import indicators as ind
from lamina.operators import ingest as ing

GOLD_SCHEMA = ("period int, region_code int, region_name string, area_code int, "
               "area_name string, segment_code int, measure double, outcome int")


def gold_rows(spark, rows):
    return spark.createDataFrame([(p, 1, "R", 1, "A", 1, m, y) for p, m, y in rows], GOLD_SCHEMA)


def test_indicator_block_with_deltas(spark):
    g = gold_rows(spark, [(2024, 700.0, 1), (2024, 720.0, 0), (2024, 750.0, None),
                          (2025, 740.0, 1), (2025, 760.0, 1), (2025, 720.0, 0)])
    r = {x["period"]: x for x in ind.indicators_for(g, ind.AREA).collect()}
    a, b = r[2024], r[2025]
    assert (a.n_total, a.n_known, a.mean_measure, a.pct_positive, a.pct_negative) == \
        (3, 2, 723.33, 50.0, 50.0)
    assert a.prev_n_total is None and a.delta_mean_measure is None and a.growth_pct is None
    assert (b.n_total, b.n_known, b.mean_measure, b.pct_positive, b.pct_negative) == \
        (3, 3, 740.0, 66.67, 33.33)
    assert (b.prev_n_total, b.prev_mean_measure) == (3, 723.33)
    assert (b.delta_mean_measure, b.delta_pct_positive, b.growth_pct) == (16.67, 16.67, 0.0)


def test_all_outcomes_null(spark):
    g = gold_rows(spark, [(2024, 1.0, None), (2024, 2.0, None)])
    r = ind.indicators_for(g, ind.AREA).first()
    assert (r.n_total, r.n_known) == (2, 0)
    assert r.pct_positive is None and r.pct_negative is None


def test_gap_year_lag_is_previous_available(spark):
    g = gold_rows(spark, [(2020, 1.0, 1), (2023, 3.0, 0)])
    r = {x["period"]: x for x in ind.indicators_for(g, ind.AREA).collect()}
    assert r[2023].prev_mean_measure == 1.0 and r[2023].prev_n_total == 1


def test_rollup_equals_direct_grouping(spark):
    g = spark.createDataFrame(
        [(2024, 1, "R1", 1, "A", 1, 10.0, 1), (2024, 1, "R1", 2, "B", 1, 20.0, 0),
         (2024, 2, "R2", 3, "C", 1, None, 1), (2025, 1, "R1", 1, "A", 1, 30.0, None)],
        GOLD_SCHEMA)
    rolled = {(r.period, r.level, r.region_code): r for r in ind.all_levels(g).collect()}
    assert rolled[(2024, "region", 1)].n_total == 2
    assert rolled[(2024, "region", 1)].mean_measure == 15.0
    assert rolled[(2024, "country", 0)].n_total == 3
    assert rolled[(2024, "country", 0)].n_known == 3
    assert rolled[(2024, "country", 0)].pct_positive == 66.67


def test_fanout_modes(spark):
    dim = spark.createDataFrame([(1, "A"), (1, "a")], "area_code int, area_name string")
    fact = spark.createDataFrame([(1, 10), (1, 11)], "area_code int, entity_id int")
    assert en.enrich(fact, dim, "area_code").count() == 4
    with pytest.raises(ValueError):
        en.enrich(fact, dim, "area_code", on_duplicate="error")
    first = en.enrich(fact, dim, "area_code", on_duplicate="first").collect()
    assert len(first) == 2 and {r.area_name for r in first} == {"A"}


def test_null_key_never_matches_then_filled(spark):
    dim = spark.createDataFrame([(1, "A"), (2, "")], "area_code int, area_name string")
    fact = spark.createDataFrame([(1,), (None,), (2,)], "area_code int")
    out = en.fill_defaults(en.enrich(fact, dim, "area_code"), codes=["area_code"],
                           texts=["area_name"])
    got = sorted((r.area_code, r.area_name) for r in out.collect())
    assert got == [(0, "Not informed"), (1, "A"), (2, "Not informed")]


def test_fill_defaults_rejects_text_codes(spark):
    df = spark.createDataFrame([("1",)], "code string")
    with pytest.raises(TypeError):
        en.fill_defaults(df, codes=["code"])


def test_dedup_before_trim(spark):
    df = spark.createDataFrame([("x",), ("x ",)], "v string")
    assert sorted(r.v for r in cl.clean_table(df).collect()) == ["x", "x"]
    assert [r.v for r in cl.clean_table(df, trim_first=True).collect()] == ["x"]


def test_lower_names_collision_raises(spark):
    df = spark.createDataFrame([(1, 2)], "A int, b int").toDF("A", "a")
    with pytest.raises(ValueError):
        cl.lower_names(df)


def test_smoothed_group_rate(spark):
    df = spark.createDataFrame([(1, 1, 1), (2, 1, 1), (3, 1, 0), (4, 1, None),
                                (5, None, None), (6, None, None)],
                               "id int, g int, y int")
    r = {x.id: x for x in fe.group_rate(df, "g", "y").collect()}
    assert math.isclose(r[1].group_rate, 7 / 13) and r[1].group_volume == 3
    assert r[5].group_rate is None and r[5].group_volume == 0
    loo = {x.id: x for x in fe.group_rate(df, "g", "y", exclude_self=True).collect()}
    assert math.isclose(loo[1].group_rate, (1 + 5) / (2 + 10))
    assert math.isclose(loo[4].group_rate, 7 / 13)


def test_decode(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (5,), (None,)], "c int")
    got = [r.l for r in df.select(decode("c", SEGMENT_LABELS).alias("l")).collect()]
    assert got == ["Federal", "State", "Municipal", "Private", "Unknown", "Unknown"]


def test_union_with_missing_column(spark):
    a = spark.createDataFrame([(1, 2)], "a int, b int")
    b = spark.createDataFrame([(3, 4)], "c int, a int")
    out = ing.union_by_name([a, b])
    assert out.columns == ["a", "b", "c"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, 2, None), (4, None, 3)]


def test_threshold_sweep(spark):
    df = spark.createDataFrame([(0.42, 0), (0.50, 1), (0.60, 0), (0.80, 1)], "p double, y int")
    sweep = {round(r.threshold, 2): r.f1_class0 for r in ev.threshold_sweep(df, "y", "p").collect()}
    assert len(sweep) == 36
    assert sweep[0.40] == 0.0
    assert math.isclose(sweep[0.43], 2 / 3, rel_tol=1e-7)
    assert math.isclose(sweep[0.51], 0.5)
    assert math.isclose(sweep[0.61], 0.8)
    assert ev.best_threshold_value(ev.threshold_sweep(df, "y", "p")) == 0.61


def test_best_threshold_default_when_all_zero(spark):
    df = spark.createDataFrame([(0.9, 1), (0.95, 1)], "p double, y int")
    assert ev.best_threshold_value(ev.threshold_sweep(df, "y", "p")) == 0.5


def test_roc_auc_with_ties(spark):
    df = spark.createDataFrame([(0.2, 0), (0.5, 0), (0.5, 1), (0.9, 1)], "p double, y int")
    assert ev.roc_auc(df, "y", "p").first().roc_auc == 0.875


def test_risk_tier(spark):
    df = spark.createDataFrame([(44.99,), (45.0,), (69.99,), (70.0,), (None,)], "s double")
    got = [r.t for r in df.select(risk_tier("s").alias("t")).collect()]
    assert got == ["High", "Medium", "Medium", "Low", "N/A"]


def test_target_encoding(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 0), ("b", 0)], "c string, y int")
    enc = {r.category: r.encoding for r in prep.target_encoding(df, ["c"], "y").collect()}
    assert math.isclose(enc["a"], 0.628571, abs_tol=1e-6)
    assert enc["b"] == 0.0
    applied = prep.apply_encoding(spark.createDataFrame([("c",)], "c string"), ["c"],
                                  prep.target_encoding(df, ["c"], "y"), 0.5)
    assert applied.first().c == 0.5


def test_standardize(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    stats = prep.mean_std(df, ["x"])
    assert stats["x"][0] == 4.0 and math.isclose(stats["x"][1], 3.535534, rel_tol=1e-6)
    first = prep.standardize(df, stats).first().x
    assert math.isclose(first, -0.848528, rel_tol=1e-5)


def test_constant_column_std_is_one(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert prep.mean_std(df, ["x"])["x"] == (2.0, 1.0)


def test_mode_tie_smallest(spark):
    df = spark.createDataFrame([("b", 10), ("a", 9), ("b", 9), ("a", 10), (None, None)],
                               "s string, n bigint")
    modes = {r.feature: r.category for r in prep.most_frequent(df, ["s", "n"]).collect()}
    assert modes == {"s": "a", "n": "9"}


def test_require_non_empty(spark):
    from lamina.operators.profile import require_non_empty

    with pytest.raises(ValueError):
        require_non_empty(spark.createDataFrame([], "a int"), "empty")
    require_non_empty(spark.createDataFrame([(1,)], "a int"), "one")


def test_value_distribution_counts_null(spark):
    from lamina.operators.profile import value_distribution

    df = spark.createDataFrame([(1,), (1,), (None,), (0,)], "y int")
    got = [(r.y, r.n, r.pct) for r in value_distribution(df, "y").collect()]
    assert got == [(None, 1, 25.0), (0, 1, 25.0), (1, 2, 50.0)]


def test_json_flatten_object_or_text(spark):
    from lamina.sources.json_dim import flatten_nested_record

    df = spark.createDataFrame([('{"id": 1, "name": "n1", "region": {"name": "North"}}',),
                                ('{"id": 2, "name": "n2", "region": "South"}',)], "j string")
    out = flatten_nested_record(df, "j", {"code": ("id", "int"), "nm": ("name", "string")},
                                "region", "name", "region_name")
    assert sorted(tuple(r) for r in out.collect()) == [(1, "n1", "North"), (2, "n2", "South")]


def test_json_flatten_null_and_absent_fields(spark):
    from lamina.sources.json_dim import flatten_nested_record

    df = spark.createDataFrame([('{"id": 1, "region": {"id": 9}}',), ('{"id": 2, "region": {"name": null}}',),
                                ('{"id": 3, "region": null}',), ('{"id": 4, "region": "{x"}',)], "j string")
    out = flatten_nested_record(df, "j", {"code": ("id", "int")}, "region", "name", "region_name")
    assert sorted((r.code, r.region_name) for r in out.collect()) == [(1, None), (2, None), (3, None), (4, "{x")]


def test_rounding_once(spark):
    from lamina.functions.exprs import round_half_up

    df = spark.createDataFrame([(71.0049999999,), (62.3449999951,), (1.005,), (-1.005,), (None,)], "x double")
    assert [r[0] for r in df.select(round_half_up("x")).collect()] == [71.0, 62.34, 1.01, -1.01, None]
    g = gold_rows(spark, [(2024, 71.0049999999, 1)])
    assert ind.indicators_for(g, ind.AREA).first().mean_measure == 71.0


def test_duplicate_report_is_ordered(spark):
    from lamina.operators.profile import duplicate_key_report

    df = spark.createDataFrame([(2, 1, "a"), (1, 1, "b"), (1, 1, "a"), (1, 2, "c"), (3, 1, "a"), (3, 2, "a")],
                               "id int, period int, k string")
    got = [tuple(r) for r in duplicate_key_report(df, "id", "period", ["k"]).collect()]
    assert got == [(1, 1, "a", 1), (1, 1, "b", 1), (2, 1, "c", 1)]


def test_rate_change(spark):
    df = spark.createDataFrame([(3.0, 1.0), (None, 1.0)], "rate_current double, rate_previous double")
    assert [r.rate_change for r in fe.derived_features(df).collect()] == [2.0, None]


def test_threshold_label_null_is_zero(spark):
    from lamina.functions.exprs import threshold_flag

    df = spark.createDataFrame([(742.0,), (743.0,), (None,)], "m double")
    assert [r.f for r in df.select(threshold_flag("m", 743).alias("f")).collect()] == [0, 1, 0]


def test_derived_features_null_guard(spark):
    df = spark.createDataFrame([(None, 1.0), (-5.0, 1.0), (9.0, 2.0)],
                               "income_current double, vulnerability_current double")
    got = [r.log_income for r in fe.derived_features(df).collect()]
    assert got[0] is None and got[1] == 0.0 and math.isclose(got[2], math.log(10.0))
    assert "index_change" not in fe.derived_features(df).columns


def test_zero_denominators_give_null(spark):
    df = spark.createDataFrame([(5.0, -1.0)], "income_current double, vulnerability_current double")
    assert fe.derived_features(df).first().income_vulnerability_ratio is None
    one_class = spark.createDataFrame([(0.3, 1), (0.7, 1)], "p double, y int")
    assert ev.roc_auc(one_class, "y", "p").first().roc_auc is None


def test_json_records_of_arrays_and_objects(spark):
    from lamina.sources.json_dim import flatten_nested_record, json_records

    df = spark.createDataFrame([
        (1, ' [{"id": 1, "region": {"name": "N"}}, {"id": "x", "region": "S"}, null, 7]'), (2, '{"id": 2, "region": "S"}'),
        (3, "[]"), (4, None), (5, '[{"id": 5'), (6, "{}"), (7, '[{"id": 8, "region": null}]')], "k int, j string")
    out = flatten_nested_record(json_records(df, "j", keep=("k",)), "record", {"code": ("id", "int")}, "region", "name",
                                "region_name", keep=("k",), bad_alias="bad")
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert [r for r in got if r[3] is None] == [(1, 1, "N", None), (2, 2, "S", None), (6, None, None, None), (7, 8, None, None)]
    bad = [r for r in got if r[3] is not None]
    assert [(r[0], r[1], r[2]) for r in bad] == [(1, None, None), (1, None, None), (5, None, None)]
    assert {r[3] for r in bad} >= {"7", '[{"id": 5'}


def test_value_distribution_reads_its_input_once(spark, tmp_path):
    from lamina.operators.profile import value_distribution

    spark.range(100).select((F.col("id") % 3).alias("y")).write.parquet(str(tmp_path / "t"))
    out = value_distribution(spark.read.parquet(str(tmp_path / "t")), "y")
    assert [(r.y, r.n) for r in out.collect()] == [(0, 34), (1, 33), (2, 33)]
    assert out.agg(F.sum("pct")).first()[0] == 100
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan or plan.count("FileScan") <= 2
