"""Language ID and quality classifier: held-out accuracy and odd inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamina.llm import langid, quality
from lamina.llm.common import fold
from lamina.llm.queries import QUERIES
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm.helpers import MESSY, frame


def test_language_accuracy(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op7_language_id"](spark, SF_ORACLE).join(docs, "doc_id").filter("held_out")
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right > 0.98


def test_language_messy(spark):
    rows = [(i, "the and of it with words " * 3) for i in range(20)]
    other = [(i, "der und die nicht einer ganz " * 3) for i in range(20, 40)]
    train = frame(spark, rows).union(frame(spark, other, "de")).union(frame(spark, [(99, "no label")], None))
    model = langid.train(train, F.lit(True))
    assert model.languages == ["de", "en"]
    docs = frame(spark, MESSY)
    got = langid.predict(docs, model, docs.columns, pred_col="p", score_col="q").collect()
    assert len(got) == len(MESSY) and got[0].text == MESSY[0][1]
    for r in got:
        has_letter = any(c.isalpha() for c in r.text or "")
        assert (r.p == "und") == (not has_letter) and 0 <= r.q <= 1
    assert {r.p for r in got if r.doc_id == 9} == {"en"}
    # a tie: an empty model's classes; no training rows at all
    none = langid.train(train, F.lit(False))
    assert none.languages == []
    assert {r.lang_pred for r in langid.predict(docs, none).collect()} == {"und"}
    assert langid.predict(docs.limit(0), model).count() == 0


def test_language_counts_are_those_of_all_rows(spark):
    """Brute force: hashed n-grams of the letters, one document at a time."""
    texts = ["Ab c", "ÉÀ é", "", "a1b"]
    model = langid.train(frame(spark, list(enumerate(texts))), buckets=64)
    assert np.isclose(np.exp(model.log_prob).sum(), 1.0)
    sizes = []
    for t in texts:
        words = "".join(c.lower() if c.isalpha() else " " for c in t).split()
        sizes += [len(w) for w in words]
        # a blank stands before and behind each word
    grams = sum(n + (n + 1) + max(0, n) - (n == 1) for n in sizes)
    weights = np.exp(model.log_prob[:, 0])
    total = 64 * langid.SMOOTHING + grams
    assert np.isclose(weights.min(), langid.SMOOTHING / total)


def test_quality_accuracy(spark):
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet")
    got = QUERIES["op10_quality"](spark, SF_ORACLE).join(labels, "doc_id").filter("held_out")
    right, n = got.agg(F.avg((F.col("quality") == F.col("predicted")).cast("int")), F.count("*")).first()
    assert n > 80 and right > 0.9


def test_quality_messy(spark):
    docs = frame(spark, MESSY)
    stats = quality.statistics(docs)
    rows = stats.collect()
    assert len(rows) == len(MESSY)
    assert all(len(r.stats) == len(quality.STATISTICS) and np.isfinite(r.stats).all() for r in rows)
    assert [r.stats for r in rows if r.doc_id == 2][0] == [0.0] * len(quality.STATISTICS)
    # no labels, no rows, one class
    none = quality.fit(stats.withColumn("label", F.lit(None).cast("int")), F.lit(False))
    assert {r.score for r in quality.score(stats, none).collect()} == {0.5}
    one = quality.fit(stats.withColumn("label", F.lit(1)), fold() == 3)
    assert all(0.9 < r.score <= 1 for r in quality.score(stats, one).collect())
    assert quality.score(stats.limit(0), one).count() == 0


def test_isotonic_is_the_best_monotone_fit():
    rng = np.random.default_rng(3)
    x, y, w = rng.random(40), rng.random(40), rng.integers(1, 5, 40).astype(float)
    got = quality.isotonic(x, y, w)
    ys, ws = y[np.argsort(x)], w[np.argsort(x)]
    # max-min formula
    avg = lambda a, b: (ys[a:b] * ws[a:b]).sum() / ws[a:b].sum()
    want = [max(min(avg(a, b) for b in range(i + 1, 41)) for a in range(i + 1)) for i in range(40)]
    assert np.allclose(got, want)


def test_normal_equations_are_those_of_all_rows(spark):
    stats = quality.statistics(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    rows = stats.withColumn("label", (F.col("doc_id") % 3 == 0).cast("int")).repartition(7)
    model = quality.fit(rows, F.lit(False), dimension=16)
    data = rows.collect()
    f, y = model.features(np.array([r.stats for r in data])), np.array([r.label for r in data], float)
    penalty = np.diag([quality.RIDGE * len(y)] * 16 + [0.0]) + 1e-9 * np.eye(17)
    assert np.allclose(model.weights, np.linalg.solve(f.T @ f + penalty, f.T @ y), atol=1e-6)
    assert pytest.approx(np.array([r.stats for r in data]).mean(axis=0)) == model.mean
