"""Streaming restart semantics and the model-training chain."""

import pytest
from pyspark.sql import functions as F

from lamina.session import work_path
from lamina.sources import sinks
from lamina.sources.tables import read_table
from lamina.streaming.incremental import run_incremental, stream_source
from tests.conftest import SF_SMALL


def test_stream_restart_is_exactly_once(spark):
    events = read_table(spark, SF_SMALL, "events")
    first = events.orderBy("event_id").limit(30)
    second = events.orderBy("event_id").offset(30).limit(30)
    stage, sink, ckpt = (work_path(spark, n) for n in ("t-stage", "t-sink", "t-ckpt"))
    sinks.write_table(first, stage, mode="append")
    counts = []
    for new in (None, None, second):
        if new is not None:
            sinks.write_table(new, stage, mode="append")
        run_incremental(stream_source(spark, stage, events.schema), sink, ckpt, "t_restart")
        counts.append(spark.read.parquet(sink).count())
    assert counts == [30, 30, 60]
    out = spark.read.parquet(sink)
    assert set(out.columns) >= {"ingested_at", "origin"}
    assert out.select("event_id").distinct().count() == 60


def test_stream_between_catalog_tables(spark):
    from lamina.streaming.incremental import stream_table

    events = read_table(spark, SF_SMALL, "events").orderBy("event_id")
    src_path, sink_path, ckpt = (work_path(spark, n) for n in ("t-src", "t-sinkt", "t-ckptt"))
    events.limit(30).write.mode("append").option("path", src_path).saveAsTable("t_events_src")
    counts = []
    for new in (None, None, events.offset(30).limit(30)):
        if new is not None:
            new.write.mode("append").saveAsTable("t_events_src")
        run_incremental(stream_table(spark, "t_events_src"), sink_path, ckpt, "t_tables",
                        sink_table="t_events_sink")
        counts.append(spark.table("t_events_sink").count())
    assert counts == [30, 30, 60]


def test_model_frame_with_a_repeated_column_raises(spark):
    from lamina.model import workflow as wf

    df = spark.createDataFrame([(1, 1.0, 2.0, "train", 0)], "id long, x double, y double, split string, fold int")
    with pytest.raises(ValueError):
        wf.prepare(df.select("*", "x"), ["x"], [], "y", "id")


def test_stream_of_more_batches_than_spark_remembers(spark):
    events = read_table(spark, SF_SMALL, "events").limit(120).repartition(120)
    stage, sink, ckpt = (work_path(spark, n) for n in ("t-many", "t-many-sink", "t-many-ckpt"))
    sinks.write_table(events, stage, mode="append")
    files = len(spark.read.parquet(stage).inputFiles())
    run = run_incremental(stream_source(spark, stage, events.schema, max_files_per_trigger=1), sink, ckpt, "t_many")
    assert run.batches == files and spark.read.parquet(sink).count() == 120


def test_logistic_fit_save_load(spark):
    from pyspark.ml import PipelineModel

    from lamina.model import workflow as wf
    from lamina.plans import ml_train_queries as tq

    model = tq.fitted(spark, SF_SMALL, "logreg")
    m = tq.validation_metrics(spark, SF_SMALL, "logreg").first()
    assert 0.5 < m.roc_auc <= 1.0
    path = work_path(spark, "t-model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    test = tq.model_data(spark, SF_SMALL).test
    a = wf.score(model, test).select("entity_id", F.col("p1").alias("a"))
    b = wf.score(loaded, test).select("entity_id", F.col("p1").alias("b"))
    diff = a.join(b, "entity_id").agg(F.max(F.abs(F.col("a") - F.col("b")))).first()[0]
    assert diff == 0.0


def test_logistic_scores_in_a_session_that_observed_a_metric(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.sql import Observation

    from lamina.model import workflow as wf
    from lamina.model.train import REFERENCE_CANDIDATES

    seen = Observation()
    spark.range(10).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 10}
    rows = spark.range(200).select("id", (F.col("id") % 7).cast("double").alias("x"),
                                   (F.col("id") % 3 == 0).cast("double").alias(wf.LABEL))
    rows = VectorAssembler(inputCols=["x"], outputCol=wf.FEATURES).transform(rows)
    model = wf.fit_classifier(wf.Matrix(None, rows, 133, 67), REFERENCE_CANDIDATES[0], 1.0, "id")
    assert model.transform(rows).agg(F.count("prediction")).first()[0] == 200


def test_sampled_shapley_additivity(spark):
    from lamina.model import workflow as wf
    from lamina.model.explain import sampled_shapley
    from lamina.plans import ml_queries as mq
    from lamina.plans import ml_train_queries as tq

    model = tq.fitted(spark, SF_SMALL, "logreg")
    rows = tq.explain_rows(spark, SF_SMALL, 250)
    bg = tq.background_point(spark, SF_SMALL)
    per_row = sampled_shapley(model, rows, bg, mq.NUMERIC, mq.CATEGORICAL, "entity_id",
                              n_perm=3, keep_rows=True)
    sums = per_row.groupBy("entity_id").agg(F.sum("v").alias("phi"))
    fx = wf.score(model, rows).select("entity_id", F.col("p1").alias("fx"))
    bg_df = spark.createDataFrame([bg]).select(*mq.NUMERIC, *mq.CATEGORICAL)
    fb = wf.score(model, bg_df).first()["p1"]
    err = (sums.join(fx, "entity_id")
           .agg(F.max(F.abs(F.col("phi") - (F.col("fx") - F.lit(fb))))).first()[0])
    assert err < 1e-9


@pytest.mark.slow
@pytest.mark.parametrize("name", ["train_forest", "train_boosted", "model_benchmark",
                                  "tune_random_search", "score_batch", "model_roundtrip",
                                  "attribution_sampled"])
def test_training_chain(spark, name):
    import __spark_entry__ as entry

    assert entry.queries()[name](spark, SF_SMALL).count() > 0
