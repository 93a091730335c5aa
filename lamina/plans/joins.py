"""Join strategy helpers: broadcast only behind a size bound."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes (as stored) of a side that is broadcast. Beyond it the join is left to Spark.
DEFAULT_BROADCAST_BYTES = 32 << 20


def stored_bytes(df: DataFrame) -> int:
    """Size by the plan's statistics: of a plain scan, its files' bytes. No job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def sized_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES,
                    derived: bool = False) -> DataFrame:
    """Broadcast hint if the frame is known to be small, else leave it to a shuffle
    join (adaptive execution can still convert it, or split hot partitions).

    ``derived=True`` is for frames computed from big inputs (aggregates), whose
    statistics say nothing: the frame is written to the shared folder first, so that
    its files' size decides, and the join reads those.
    """
    if derived:
        df = materialize(df, "side")
    return F.broadcast(df) if stored_bytes(df) <= max_bytes else df


#: A key with more than 1 / HEAVY_PARTS of all rows is heavy; there are fewer such keys.
HEAVY_PARTS = 256


def join_aggregate(left: DataFrame, right: DataFrame, keys: Sequence[str], weight: str,
                   null_safe: bool = False, max_bytes: int = DEFAULT_BROADCAST_BYTES,
                   parts: int = HEAVY_PARTS) -> DataFrame:
    """Left join of rows to ``right``, one row a key, aggregated from them; ``weight`` is
    its count of the key's rows. One copy of the keys stays. With ``null_safe`` a null key
    equals a null, else rows with a null key find nothing.

    A small ``right`` is broadcast. Beyond ``max_bytes`` the rows of the heavy keys, of
    which there are fewer than ``parts``, meet these alone in a broadcast join and stay
    where they are; only the other rows are shuffled, so that no key fills a task. Rows that
    can find nothing aren't joined.
    """
    names = [f"__r_{k}" for k in keys]
    r = materialize(right.select(*[F.col(k).alias(n) for k, n in zip(keys, names)],
                                 *[c for c in right.columns if c not in keys]), "side")
    same = [F.col(k).eqNullSafe(F.col(n)) if null_safe else F.col(k) == F.col(n) for k, n in zip(keys, names)]
    cond = reduce(Column.__and__, same)
    if stored_bytes(r) <= max_bytes:
        return left.join(F.broadcast(r), cond, "left").drop(*names)
    share = F.coalesce(F.col(weight), F.lit(0)) * F.lit(parts)
    total = r.agg(F.sum(weight)).first()[0] or 0
    heavy, light = r.filter(share > total), r.filter(share <= total)
    lacking = None
    if not null_safe:
        known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
        left, lacking = left.filter(known), left.filter(~known)
    out = (left.join(F.broadcast(heavy), cond, "inner").drop(*names)
           .unionByName(left.join(F.broadcast(heavy.select(*names)), cond, "left_anti")
                        .join(light, cond, "left").drop(*names)))
    if lacking is not None:
        out = out.unionByName(lacking.withColumns(
            {f.name: F.lit(None).cast(f.dataType) for f in r.schema.fields if f.name not in names}))
    return out


_MATERIALIZED: dict[tuple, list] = {}


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet under the shared checkpoint
    folder and read it back. Later jobs start from these files instead of
    recomputing the plan, and a lost executor only costs re-reading them.
    The same plan over the same input files, materialized again in the same
    session, reuses the files; an input that was rewritten has other files."""
    from lamina.session import work_path

    spark = df.sparkSession
    key = (spark.sparkContext.applicationId, df.semanticHash(), name, tuple(sorted(df.inputFiles())))
    for seen, path in _MATERIALIZED.get(key, []):
        if df.sameSemantics(seen):  # the hash is only a bucket; confirm the plan
            return spark.read.parquet(path)
    path = work_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    _MATERIALIZED.setdefault(key, []).append((df, path))
    return spark.read.parquet(path)
