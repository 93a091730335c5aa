"""Clean layer: names, whole-row dedup, fact filters, text trimming, audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-case every column name; two names that collide raise."""
    names = [c.lower() for c in df.columns]
    seen: set[str] = set()
    dups = sorted({n for n in names if n in seen or seen.add(n)})
    if dups:
        raise ValueError(f"column names collide after lower-casing: {dups}")
    return df.toDF(*names)


def trim_strings(df: DataFrame, upper: Sequence[str] = ()) -> DataFrame:
    """Trim every string column (spaces only); also upper-case ``upper`` columns
    that exist. One projection, whatever the number of columns."""
    exprs = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, StringType):
            c = F.trim(c)
            if f.name in upper:
                c = F.upper(c)
        exprs.append(c.alias(f.name))
    return df.select(*exprs)


def dedup(df: DataFrame, trim_first: bool = False) -> DataFrame:
    """Whole-row dedup, nulls equal. ``trim_first`` trims text before comparing,
    so rows that differ only in padding collapse too."""
    return (trim_strings(df) if trim_first else df).dropDuplicates()


def clean_table(df: DataFrame, upper: Sequence[str] = (), trim_first: bool = False) -> DataFrame:
    """Generic clean step: lower names -> dedup -> trim (and upper codes)."""
    return trim_strings(dedup(lower_names(df), trim_first), upper)


def clean_fact(df: DataFrame, present: str = "present", measure: str = "measure",
               upper: Sequence[str] = (), trim_first: bool = False) -> DataFrame:
    """Fact clean step: lower names -> dedup -> present == 1 -> measure known -> trim.

    The order is the reference's: dedup runs before trimming, so two rows that
    differ only in padding both survive and are equal afterwards
    (``trim_first=True`` gives the stricter result).
    """
    out = dedup(lower_names(df), trim_first)
    out = out.filter(F.col(present) == 1).filter(F.col(measure).isNotNull())
    return trim_strings(out, upper)


class StepCounts:
    """Rows after each clean step, observed while the cleaned rows are written."""

    NAMES = ("n_input", "n_distinct", "n_present", "n_clean")

    def __init__(self) -> None:
        self._seen = [Observation() for _ in self.NAMES]

    def watch(self, df: DataFrame, step: int) -> DataFrame:
        return df.observe(self._seen[step], F.count(F.lit(1)).alias("n"))

    def get(self) -> dict[str, int]:
        """After an action on the whole cleaned frame; it waits for one."""
        return {name: int(o.get["n"]) for name, o in zip(self.NAMES, self._seen)}


def clean_fact_counted(df: DataFrame, present: str = "present", measure: str = "measure",
                       upper: Sequence[str] = ()) -> tuple[DataFrame, StepCounts]:
    """``clean_fact`` and the counts of its steps, which come with the first action that
    runs all of the frame (a write): the input isn't read again for them."""
    counts = StepCounts()
    out = counts.watch(dedup(counts.watch(lower_names(df), 0)), 1)
    out = counts.watch(out.filter(F.col(present) == 1), 2)
    out = counts.watch(out.filter(F.col(measure).isNotNull()), 3)
    return trim_strings(out, upper), counts


def clean_audit(df: DataFrame, present: str = "present", measure: str = "measure") -> DataFrame:
    """Row counts after each clean step, in one job: input, distinct,
    present, clean. Dedup is a group-by on every column (nulls equal) with a
    count, so the input count comes from the same aggregation."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
    is_present = F.col(present) == 1
    return groups.agg(
        F.sum("__n").cast("bigint").alias("n_input"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.count(F.when(is_present, 1)).alias("n_present"),
        F.count(F.when(is_present & F.col(measure).isNotNull(), 1)).alias("n_clean"),
    )
