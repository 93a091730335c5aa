"""Tables that are replaced as a whole, atomically.

A table is a folder with one folder of data per version, ``v-<number>-<token>``, and
``_log``, one small file per commit. A replacement writes the new version's folder
first and appends its row to the log last; appending one file is atomic on every store
that Spark's committers serve. Readers take the newest version in the log. A run that
stops in between leaves a folder that no one reads, and the old table as it was.

One writer at a time: of two that commit the same number, the greater token is read.
Frames made before a replacement go on reading their version until it is removed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.sources import sinks

LOG = "_log"
_COMMIT = "version long, folder string, format string, committed_at timestamp"


def _path(spark: SparkSession, path: str):
    """A Hadoop path and its file system: the one that Spark reads it with."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, f"{path}/{LOG}")
    return fs.exists(p)


def history(spark: SparkSession, path: str) -> DataFrame:
    """Commits: version, folder, format, committed_at. A table that was never written has none."""
    if not exists(spark, path):
        return spark.createDataFrame([], _COMMIT)
    return spark.read.schema(_COMMIT).json(f"{path}/{LOG}")


def _newest(spark: SparkSession, path: str):
    return history(spark, path).orderBy(F.desc("version"), F.desc("folder")).first()


def stage(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
          options: dict | None = None, deal: bool = True) -> tuple[int, str, str]:
    """Write the next version without committing it; the argument of ``commit``."""
    last = _newest(df.sparkSession, path)
    version = last["version"] + 1 if last else 1
    folder = f"v-{version:08d}-{uuid.uuid4().hex[:12]}"
    sinks.write_table(df, f"{path}/{folder}", "errorifexists", fmt, partition_by, options, deal)
    return version, folder, fmt


def commit(spark: SparkSession, path: str, staged: tuple[int, str, str]) -> None:
    row = spark.createDataFrame([staged], "version long, folder string, format string")
    row.withColumn("committed_at", F.current_timestamp()).coalesce(1).write.mode("append").json(f"{path}/{LOG}")


def replace(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
            options: dict | None = None, deal: bool = True) -> str:
    """Replace data and schema of the table at ``path``, or make it. ``df`` may read the
    version that it replaces."""
    commit(df.sparkSession, path, stage(df, path, fmt, partition_by, options, deal))
    return path


def read(spark: SparkSession, path: str, version: int | None = None, **how) -> DataFrame:
    """The newest version, or an older one that is still there."""
    if version is None:
        row = _newest(spark, path)
    else:
        row = history(spark, path).filter(F.col("version") == version).orderBy(F.desc("folder")).first()
    if row is None:
        raise FileNotFoundError(f"no version {'' if version is None else f'{version} '}of a table at {path}")
    return sinks.read_back(spark, f"{path}/{row['folder']}", fmt=row["format"], **how)


def remove_old(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete the folders of all but the ``keep`` newest versions, and folders that were
    never committed. Not while another run writes the table."""
    kept = {r["folder"] for r in history(spark, path).orderBy(F.desc("version"), F.desc("folder")).limit(max(1, keep)).collect()}
    if not kept:
        return []
    p, fs = _path(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    gone = sorted(n for n in names if n.startswith("v-") and n not in kept)
    for n in gone:
        fs.delete(_path(spark, f"{path}/{n}")[0], True)
    return gone


def publish(df: DataFrame, name: str, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> str:
    """Replace the table at ``path`` and point the catalog's ``name`` at the new version: a
    view, which the catalog replaces with its schema in one step. Readers by name see
    the old version or the new one."""
    spark = df.sparkSession
    staged = stage(df, path, fmt, partition_by)
    commit(spark, path, staged)
    folder = f"{path}/{staged[1]}".replace("`", "``")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {fmt}.`{folder}`")
    return name
