"""Every SQL-expressible query equals its independent DuckDB oracle (sf0.01);
rows-only queries run and return rows."""

import pytest

import __spark_entry__ as entry
from lamina.plans import registry
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.oracle_compare import compare, duck

registry.load_all()
ORACLE, QUERIES = registry.ORACLE, registry.QUERIES
TRAINING = {"train_logistic", "train_forest", "train_boosted", "model_benchmark",
            "tune_random_search", "score_batch", "model_roundtrip", "attribution_sampled"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


#: these fit the trees
CHECKS = {"train_check", "forest_check", "score_batch_check", "model_roundtrip_check", "attribution_check", "metrics_published"}


@pytest.mark.parametrize("name", [pytest.param(n, marks=pytest.mark.slow) if n in CHECKS else n for n in sorted(ORACLE)])
def test_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_ORACLE)
    assert r["cols_match"], r
    assert r["types_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["match"], r


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - TRAINING))
def test_rows_only(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "level" in df.columns and "growth_pct" in df.columns


def test_every_query_registered_with_oracle_or_training():
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only <= TRAINING | {"sample_stratified_bernoulli"}
