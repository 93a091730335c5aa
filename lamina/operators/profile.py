"""Data-quality and exploratory profiles: counts, nulls, distributions,
duplicate keys. Each profile is one aggregation job (no per-column actions)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions.exprs import percent


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) for several tables, as one union of counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)))


def null_profile(df: DataFrame) -> DataFrame:
    """Wide: one column per input column holding its null count."""
    return df.agg(*[F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(c) for c in df.columns])


def null_profile_long(df: DataFrame) -> DataFrame:
    """Long: (column_name, n_null), from the same single aggregation."""
    wide = null_profile(df)
    return wide.unpivot([], [F.col(f"`{c}`") for c in df.columns], "column_name", "n_null")


def value_distribution(df: DataFrame, column: str, count_col: str = "n",
                       pct_col: str = "pct") -> DataFrame:
    """Frequency of each value (null is a value) with percent of all rows.

    The total is a scalar subquery over the same aggregate, whose exchange Spark reuses:
    one scan, no job before the result's, no window over every distinct value.
    """
    grouped = df.groupBy(column).agg(F.count(F.lit(1)).alias(count_col))
    total = grouped.agg(F.sum(count_col)).scalar()
    return (grouped.withColumn(pct_col, percent(F.col(count_col), total))
            .orderBy(F.col(column).asc_nulls_first()))


def pair_distribution(df: DataFrame, columns: Sequence[str], count_col: str = "n") -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(count_col))


def duplicate_key_report(df: DataFrame, id_col: str, period_col: str,
                         keys: Sequence[str], count_col: str = "n_rows") -> DataFrame:
    """Rows whose id has some (id, period) pair occurring more than once, counted by
    (period, id, *keys), in that order.

    The input is read and aggregated once; the aggregate is dealt out by id, and a pair's
    rows are summed by windows within one id that need no exchange of their own.
    """
    counts = df.filter(F.col(id_col).isNotNull()).groupBy(period_col, id_col, *keys).agg(F.count(F.lit(1)).alias(count_col)).repartition(id_col)
    pair = Window.partitionBy(id_col, period_col)
    marked = counts.withColumn("__pair", F.sum(count_col).over(pair))
    most = marked.withColumn("__most", F.max("__pair").over(Window.partitionBy(id_col)))
    return (most.filter(F.col("__most") > 1)
            .drop("__pair", "__most").orderBy(period_col, id_col, *keys))


def require_non_empty(df: DataFrame, what: str = "input") -> DataFrame:
    """Guard: raise when ``df`` has no rows (reads at most one row)."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df
