"""The distributed algorithms against brute force on small inputs, with
parameters forcing their multi-step paths (tiny buckets, tiny exact limits)."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lamina.model import evaluate as ev
from lamina.model import prep
from lamina.model import split as sp


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(7)
    rows = [(i, float(rng.choice([1, 2, 2, 3, 5, 8, 13]) if i % 3 else rng.random() * 100),
             None if i % 17 == 0 else rng.randint(0, 40))
            for i in range(2000)]
    return spark.createDataFrame(rows, "id int, x double, k int"), rows


def test_exact_median_bracketing_matches_numpy(spark, values):
    df, rows = values
    xs = [r[1] for r in rows]
    ks = [r[2] for r in rows if r[2] is not None]
    got = prep.exact_medians(df, ["x", "k"], max_exact_rows=50, rel_err=0.01)
    assert got["x"] == float(np.median(xs))
    assert got["k"] == float(np.median(ks))


def test_exact_median_even_count_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert prep.exact_medians(df, ["x"])["x"] == 2.5
    assert prep.exact_medians(df, ["x"], max_exact_rows=1, rel_err=0.1)["x"] == 2.5


def test_exact_rank_split_matches_row_number(spark, values):
    df, _ = values
    lab = df.withColumn("y", (F.col("id") % 3 == 0).cast("int"))
    got = sp.exact_rank(lab, "y", "id", bucket_bits=3).select("id", "rank")
    w = Window.partitionBy("y").orderBy(sp.hash_u32("id", sp.SPLIT_SALT), "id")
    want = lab.select("id", (F.row_number().over(w) - 1).alias("rank"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    split = sp.split_exact(lab, "y", "id").groupBy("y", "split").count().collect()
    sizes = {(r.y, r.split): r["count"] for r in split}
    for y in (0, 1):
        n = sum(v for (yy, _), v in sizes.items() if yy == y)
        assert sizes[(y, "train")] == n * 70 // 100
        assert sizes[(y, "validation")] == n * 85 // 100 - n * 70 // 100


def _brute_auc(pairs):
    pos = [p for p, y in pairs if y == 1]
    neg = [p for p, y in pairs if y == 0]
    wins = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return wins / (len(pos) * len(neg))


def test_bucketed_auc_matches_brute_force(spark):
    rng = random.Random(3)
    pairs = [(round(rng.random(), 2), rng.randint(0, 1)) for _ in range(600)]
    df = spark.createDataFrame(pairs, "p double, y int")
    for buckets in (1, 3, 16):
        got = ev.roc_auc(df, "y", "p", buckets=buckets).first().roc_auc
        assert got == pytest.approx(_brute_auc(pairs), abs=1e-8)


def test_grouped_auc(spark):
    rows = [("a", 0.1, 0), ("a", 0.9, 1), ("b", 0.9, 0), ("b", 0.1, 1), ("b", 0.5, 1)]
    df = spark.createDataFrame(rows, "g string, p double, y int")
    got = {r.g: r.roc_auc for r in ev.roc_auc(df, "y", "p", group=["g"]).collect()}
    assert got == {"a": 1.0, "b": 0.0}


def test_roc_curve_points_brute_force(spark):
    rng = random.Random(5)
    pairs = [(round(rng.random(), 1), rng.randint(0, 1)) for _ in range(200)]
    df = spark.createDataFrame(pairs, "p double, y int")
    P = sum(y for _, y in pairs)
    N = len(pairs) - P
    got = {r.threshold: (r.fpr, r.tpr) for r in ev.roc_curve_points(df, "y", "p", buckets=2).collect()}
    for t, (fpr, tpr) in got.items():
        assert fpr == pytest.approx(sum(1 for p, y in pairs if p >= t and y == 0) / N)
        assert tpr == pytest.approx(sum(1 for p, y in pairs if p >= t and y == 1) / P)


@pytest.mark.parametrize("buckets", [1, 3, 40])
def test_roc_curve_bends(spark, buckets):
    """Points of the curve whose second difference isn't zero, the first and the last."""
    rng = random.Random(6)
    pairs = [(round(rng.random(), 2), rng.randint(0, 1)) for _ in range(150)]
    pairs += [(2 + i / 8, 1) for i in range(20)] + [(-1 - i / 8, 0) for i in range(20)]
    P = sum(y for _, y in pairs)
    N = len(pairs) - P
    scores = sorted({p for p, _ in pairs}, reverse=True)
    all_points = [(t, sum(1 for p, y in pairs if p >= t and y == 0), sum(1 for p, y in pairs if p >= t and y == 1)) for t in scores]
    want = [(float("inf"), 0.0, 0.0)]
    for i, (t, fp, tp) in enumerate(all_points):
        inner = 0 < i < len(all_points) - 1
        if not inner or any(all_points[i + 1][k] - 2 * all_points[i][k] + all_points[i - 1][k] for k in (1, 2)):
            want.append((t, fp / N, tp / P))
    assert len(want) < len(all_points) - 30
    df = spark.createDataFrame(pairs, "p double, y int")
    got = sorted(((r.threshold, r.fpr, r.tpr) for r in ev.roc_curve(df, "y", "p", buckets=buckets).collect()), reverse=True)
    assert [t for t, *_ in got] == [t for t, *_ in want]
    for (_, a, b), (_, c, d) in zip(got, want):
        assert a == pytest.approx(c) and b == pytest.approx(d)


def test_sweep_matches_brute_force(spark):
    rng = random.Random(11)
    pairs = [(round(rng.random(), 3), rng.randint(0, 1)) for _ in range(500)]
    df = spark.createDataFrame(pairs, "p double, y int")
    got = {r.threshold: r for r in ev.threshold_sweep(df, "y", "p").collect()}
    for i in range(36):
        t = (40 + i) / 100
        tp = sum(1 for p, y in pairs if y == 0 and p < t)
        fp = sum(1 for p, y in pairs if y == 1 and p < t)
        fn = sum(1 for p, y in pairs if y == 0 and p >= t)
        assert (got[t].tp, got[t].fp, got[t].fn) == (tp, fp, fn)


def test_oof_encoding_matches_direct_refit(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice("abcd"), rng.randint(0, 1), i % 5) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, c string, y int, fold int")
    oof = {(r.category, r.fold): r.encoding
           for r in prep.target_encoding_oof(df, ["c"], "y", "fold").collect()}
    for f in range(5):
        others = df.where(F.col("fold") != f)
        direct = {r.category: r.encoding
                  for r in prep.target_encoding(others, ["c"], "y").collect()}
        for cat in "abcd":
            if (cat, f) in oof:
                assert oof[(cat, f)] == pytest.approx(direct[cat], abs=1e-12)


def test_median_among_ties(spark):
    """40 % negatives, 30 % zeros, 30 % positives: the zeros are one row."""
    rng = random.Random(9)
    xs = [-rng.random() for _ in range(800)] + [0.0] * 600 + [rng.random() for _ in range(600)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    assert prep.exact_medians(df, ["x"], max_exact_rows=100)["x"] == 0.0
    inside = prep._brackets(df, {"x": [999, 1000]}, {"x": 2000}, 1e-3)
    assert df.where(F.col("x").between(*inside["x"][:2])).distinct().count() < 100


@pytest.mark.parametrize("scale,shift", [(1.0, 5.0), (4e-7, 0.0)])
def test_score_buckets_are_even(spark, scale, shift):
    rng = random.Random(4)
    df = spark.createDataFrame([(shift + scale * rng.random(), rng.randint(0, 1)) for _ in range(4000)], "p double, y int")
    n = df.groupBy("p").count().repartitionByRange(16, "p").groupBy(F.spark_partition_id()).count()
    assert n.agg(F.max("count")).first()[0] < 4000 / 4
    pairs = [(r.p, r.y) for r in df.collect()]
    ranks = {p: i for i, (p, _) in enumerate(sorted(pairs))}
    pos = [ranks[p] for p, y in pairs if y]
    want = (sum(pos) - len(pos) * (len(pos) - 1) / 2) / (len(pos) * (4000 - len(pos)))
    assert ev.roc_auc(df, "y", "p").first().roc_auc == pytest.approx(want, abs=1e-12)


def test_decisions_on_raw_metrics(spark):
    metrics = spark.createDataFrame([("a", 0, 0.7), ("b", 1, 0.7 + 1e-10)], "model string, model_order int, roc_auc double")
    assert ev.champion(metrics).first().model == "b"
    sweep = spark.createDataFrame([(0.4, 0.5), (0.5, 0.5 + 1e-10)], "threshold double, f1_class0 double")
    assert ev.best_threshold_value(sweep) == 0.5


def test_rewritten_input_is_read_anew(spark):
    from lamina.plans.joins import materialize
    from lamina.session import work_path

    path = work_path(spark, "t-rewritten")
    for n in (10, 25):
        spark.range(n).write.mode("overwrite").parquet(path)
        assert materialize(spark.read.parquet(path).select("id"), "t").count() == n


def test_hash_split_is_stable_and_complete(spark, values):
    df, _ = values
    a = sp.split_hash(df, "id").select("id", "split")
    b = sp.split_hash(df.repartition(7), "id").select("id", "split")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    counts = {r.split: r["count"] for r in a.groupBy("split").count().collect()}
    assert sum(counts.values()) == 2000
    assert 0.65 < counts["train"] / 2000 < 0.75
