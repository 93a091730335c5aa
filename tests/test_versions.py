"""Atomic replacement of whole tables."""

import pytest
from pyspark.sql import functions as F

from lamina.session import work_path
from lamina.sources import sinks, versions


def test_replace_changes_data_and_schema(spark):
    path = work_path(spark, "t-versions")
    assert not versions.exists(spark, path)
    versions.replace(spark.range(5).withColumn("part", F.col("id") % 2), path, partition_by=["part"])
    first = versions.read(spark, path)
    versions.replace(spark.createDataFrame([("a",)], "name string"), path)
    assert [tuple(r) for r in versions.read(spark, path).collect()] == [("a",)]
    assert first.count() == 5, "a frame goes on reading its version"
    assert versions.read(spark, path, version=1).count() == 5
    assert [r.version for r in versions.history(spark, path).orderBy("version").collect()] == [1, 2]


def test_a_run_killed_before_its_commit_leaves_the_old_table(spark, monkeypatch):
    path = work_path(spark, "t-killed")
    versions.replace(spark.range(3), path)

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(versions, "commit", killed)
    with pytest.raises(KeyboardInterrupt):
        versions.replace(spark.range(99), path)
    monkeypatch.undo()
    assert versions.read(spark, path).count() == 3
    # and one that fails while it writes
    broken = spark.range(10).select(F.raise_error(F.lit("broken")).alias("x"))
    with pytest.raises(Exception, match="broken"):
        versions.replace(broken, path)
    assert versions.read(spark, path).count() == 3
    versions.replace(spark.range(4), path)
    assert versions.read(spark, path).count() == 4
    assert len(versions.remove_old(spark, path)) == 3, "the old version and two that were never committed"
    assert versions.read(spark, path).count() == 4
    with pytest.raises(Exception):
        versions.read(spark, path, version=1).count()


def test_a_table_replaced_by_its_own_rows(spark):
    path = work_path(spark, "t-own")
    versions.replace(spark.range(10), path)
    versions.replace(versions.read(spark, path).filter("id < 4"), path)
    assert versions.read(spark, path).count() == 4


def test_publish_by_name(spark):
    path, name = work_path(spark, "t-named"), "t_published_view"
    versions.publish(spark.range(5), name, path)
    versions.publish(spark.range(7).withColumn("more", F.lit("x")), name, path, partition_by=["more"])
    assert spark.table(name).count() == 7 and set(spark.table(name).columns) == {"id", "more"}
    with pytest.raises(FileNotFoundError):
        versions.read(spark, work_path(spark, "t-none"))
    assert versions.remove_old(spark, work_path(spark, "t-none")) == []
    sinks.write_table(spark.range(2), work_path(spark, "t-plain"))


def test_calls_run_together(spark):
    from lamina.plans.parallel import run_together

    got = run_together(spark, [lambda n=n: spark.range(n).count() for n in range(9)], 4)
    assert got == list(range(9))

    def fails():
        raise ValueError("one of them")

    with pytest.raises(ValueError, match="one of them"):
        run_together(spark, [fails, lambda: spark.range(10).count()])
    assert run_together(spark, []) == []


def test_rows_stay_in_their_tasks_where_they_are_not_dealt_out(spark):
    df = spark.range(0, 4000, 1, 4).withColumn("year", (F.col("id") % 3).cast("int"))
    kept, dealt = work_path(spark, "kept"), work_path(spark, "dealt")
    versions.replace(df, kept, partition_by=["year"], deal=False)
    versions.replace(df, dealt, partition_by=["year"])
    rows = [sorted(map(tuple, versions.read(spark, p).select("id", "year").collect())) for p in (kept, dealt)]
    assert rows[0] == rows[1] and len(rows[0]) == 4000
    assert len(versions.read(spark, kept).inputFiles()) == 4 * 3     # a task's file for each year
