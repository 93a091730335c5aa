"""Raw layer: stack per-period sources into one table with lineage columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INGESTED_AT = "ingested_at"
ORIGIN = "origin"


def add_lineage(df: DataFrame, origin: str = "batch", ts_col: str = INGESTED_AT,
                origin_col: str = ORIGIN) -> DataFrame:
    """Ingestion time (one value per query) and a literal origin tag."""
    return df.withColumns({ts_col: F.current_timestamp(), origin_col: F.lit(origin)})


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column missing in some frame is null there.
    Column order: the first frame's, then new columns in order of appearance."""
    if not frames:
        raise ValueError("nothing to stack")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stack_periods(frames: Sequence[DataFrame], origin: str = "batch") -> DataFrame:
    """One raw table from per-period sources, each tagged with lineage."""
    return union_by_name([add_lineage(f, origin) for f in frames])
