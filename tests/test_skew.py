"""A third of all rows on one key: results stay exact and whole, and the hot
key is combined map-side (partial aggregation) instead of one task holding
its rows."""

import random

import pytest
from pyspark.sql import functions as F

from lamina.model import prep
from lamina.model import split as sp
from lamina.operators import features as fe
from lamina.operators import indicators as ind

N = 6000


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(1)
    rows = []
    for i in range(N):
        hot = i % 3 == 0
        rows.append((i, 1 if hot else rng.randint(2, 400), 2024 + i % 2,
                     1 if hot else rng.randint(1, 5), rng.random() * 100,
                     None if i % 11 == 0 else rng.randint(0, 1)))
    df = spark.createDataFrame(rows, "id int, g int, period int, area int, x double, y int")
    return df.repartition(8), rows


def test_group_rate_hot_group(spark, skewed):
    df, rows = skewed
    out = {r.id: r for r in fe.group_rate(df, "g", "y").collect()}
    assert len(out) == N
    hot = [r for r in rows if r[1] == 1 and r[5] is not None]
    want = (sum(r[5] for r in hot) + 5) / (len(hot) + 10)
    assert out[0].group_rate == pytest.approx(want)
    assert out[0].group_volume == len(hot)


def test_group_rate_does_not_shuffle_the_rows(spark, skewed):
    """The group statistics are aggregated and written once; the rows meet them in a
    broadcast join, so the hot group's rows stay where they are."""
    df, _ = skewed
    plan = fe.group_rate(df, "g", "y")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize("exclude_self", [False, True])
def test_group_rate_of_many_groups_splits_heavy_ones(spark, skewed, exclude_self):
    """Beyond the broadcast bound: same rows and rates, the null group among them, and the
    hot group's rows don't meet in one partition."""
    df, _ = skewed
    df = df.withColumn("g", F.when(F.col("id") % 17 != 0, F.col("g")))
    want = fe.group_rate(df, "g", "y", exclude_self=exclude_self)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = fe.group_rate(df, "g", "y", exclude_self=exclude_self, max_broadcast_bytes=0)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        hot = [r["count"] for r in got.filter("g = 1").groupBy(F.spark_partition_id()).count().collect()]
        assert len(hot) >= 8 and max(hot) <= 2 * sorted(hot)[len(hot) // 2]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_indicator_join_beyond_the_broadcast_bound(spark, skewed):
    df, _ = skewed
    fact = df.withColumn("g", F.when(F.col("id") % 17 != 0, F.col("g")))
    side = (fact.filter("g != 3").groupBy("g", "period").agg(F.count("*").alias("n_total"), F.sum("x").cast("int").alias("total"))
            .withColumn("id", F.lit(-1)))
    want = fact.join(side.drop("id"), ["g", "period"], "left").select("id", "g", "period", "n_total", "total")
    got = fe.join_indicators(fact, side, ("g", "period"), max_broadcast_bytes=0)
    assert got.columns.count("id") == 1
    assert (sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect())))


def test_indicators_hot_area(spark, skewed):
    df, rows = skewed
    gold = df.select("period", F.lit(1).alias("region_code"), F.lit("R").alias("region_name"),
                     F.col("area").alias("area_code"), F.lit("A").alias("area_name"),
                     F.lit(1).alias("segment_code"), F.col("x").alias("measure"),
                     F.col("y").alias("outcome"))
    got = {(r.period, r.area_code): r.n_total for r in ind.indicators_for(gold, ind.AREA).collect()}
    for (p, a), n in got.items():
        assert n == sum(1 for r in rows if r[2] == p and r[3] == a)
    assert sum(got.values()) == N


def test_target_stats_hot_category(spark, skewed):
    df, rows = skewed
    st = {r.category: r for r in prep.target_stats(df, ["g"], "y").collect()}
    hot = [r for r in rows if r[1] == 1 and r[5] is not None]
    assert st["1"].n == len(hot) and st["1"].s == sum(r[5] for r in hot)


def test_exact_split_with_hot_class(spark, skewed):
    df, _ = skewed
    lab = df.where(F.col("y").isNotNull()).withColumn("cls", (F.col("g") == 1).cast("int"))
    out = sp.split_exact(lab, "cls", "id").groupBy("cls", "split").count().collect()
    sizes = {(r.cls, r.split): r["count"] for r in out}
    for c in (0, 1):
        n = sum(v for (cc, _), v in sizes.items() if cc == c)
        assert sizes[(c, "train")] == n * 70 // 100
