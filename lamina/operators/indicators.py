"""Indicator block at every level of a nested hierarchy, with period changes.

One aggregation of the fact produces additive leaf statistics at the finest
level; coarser levels are re-aggregations of that small leaf frame (no new
scan of the fact). Ratios, lags and deltas are computed per level on the
aggregated rows, so every window runs over a few rows per key, never over
the raw fact.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions.exprs import ALL_LABEL, NOT_APPLICABLE, percent, ratio, round_half_up

STAT_COLUMNS = ("n_total", "n_known", "n_pos", "n_neg", "sum_measure", "n_measure")

MEASURE_COLUMNS = ("n_total", "n_known", "mean_measure", "pct_positive", "pct_negative")
LAG_COLUMNS = ("prev_n_total", "prev_mean_measure", "prev_pct_positive", "prev_pct_negative")
DELTA_COLUMNS = ("delta_mean_measure", "delta_pct_positive", "delta_pct_negative", "growth_pct")
INDICATOR_COLUMNS = MEASURE_COLUMNS + LAG_COLUMNS + DELTA_COLUMNS


@dataclass(frozen=True)
class Level:
    """One level of the hierarchy.

    ``keys``: grouping columns (codes and names); ``window_keys``: the codes
    that identify the series over periods; ``order_keys``: names used only to
    make the lag deterministic when a code carries several names;
    ``placeholders``: literal values for key columns this level does not have.
    """

    name: str
    keys: tuple[str, ...]
    window_keys: tuple[str, ...]
    order_keys: tuple[str, ...] = ()
    placeholders: dict = field(default_factory=dict)


AREA = Level("area",
             keys=("region_code", "region_name", "area_code", "area_name", "segment_code"),
             window_keys=("region_code", "area_code", "segment_code"),
             order_keys=("region_name", "area_name"))
REGION = Level("region",
               keys=("region_code", "region_name", "segment_code"),
               window_keys=("region_code", "segment_code"),
               order_keys=("region_name",),
               placeholders={"area_code": 0, "area_name": NOT_APPLICABLE})
COUNTRY = Level("country",
                keys=("segment_code",),
                window_keys=("segment_code",),
                placeholders={"region_code": 0, "region_name": ALL_LABEL,
                              "area_code": 0, "area_name": ALL_LABEL})
LEVELS = (AREA, REGION, COUNTRY)

ALL_LEVEL_KEYS = ("region_code", "region_name", "area_code", "area_name", "segment_code")


def leaf_stats(df: DataFrame, keys: Sequence[str], period: str = "period",
               outcome: str = "outcome", measure: str = "measure") -> DataFrame:
    """Additive statistics per (period, keys): one shuffle, map-side combined."""
    y = F.col(outcome)
    return df.groupBy(period, *keys).agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count(y).alias("n_known"),
        F.sum(F.when(y == 1, 1).otherwise(0)).cast("bigint").alias("n_pos"),
        F.sum(F.when(y == 0, 1).otherwise(0)).cast("bigint").alias("n_neg"),
        exact_sum(measure).alias("sum_measure"),
        F.count(measure).alias("n_measure"),
    )


def exact_sum(measure: str) -> Column:
    """Sum as a decimal (12 places): the mean, and so its rounding at a tie, does
    not depend on the order in which tasks add their rows."""
    return F.sum(F.col(measure).cast("decimal(28,12)"))


def roll_up(stats: DataFrame, keys: Sequence[str], period: str = "period") -> DataFrame:
    """Re-aggregate leaf statistics to a coarser key set (sums of sums)."""
    return stats.groupBy(period, *keys).agg(
        *[F.sum(c).alias(c) for c in STAT_COLUMNS])


def _measures(stats: DataFrame) -> DataFrame:
    return stats.withColumns({
        "mean_measure": round_half_up(ratio(F.col("sum_measure").cast("double"), "n_measure")),
        "pct_positive": percent("n_pos", "n_known"),
        "pct_negative": percent("n_neg", "n_known"),
    })


def with_changes(df: DataFrame, level: Level, period: str = "period") -> DataFrame:
    """Previous-available-period values and their changes.

    The lag is the previous row of the series, not period - 1. Deltas are
    taken between the already rounded values, then rounded again.
    """
    w = Window.partitionBy(*level.window_keys).orderBy(period, *level.order_keys)

    def lag(c: str) -> Column:
        return F.lag(c).over(w)

    out = df.withColumns({
        "prev_n_total": lag("n_total"),
        "prev_mean_measure": lag("mean_measure"),
        "prev_pct_positive": lag("pct_positive"),
        "prev_pct_negative": lag("pct_negative"),
    })
    return out.withColumns({
        "delta_mean_measure": round_half_up(F.col("mean_measure") - F.col("prev_mean_measure")),
        "delta_pct_positive": round_half_up(F.col("pct_positive") - F.col("prev_pct_positive")),
        "delta_pct_negative": round_half_up(F.col("pct_negative") - F.col("prev_pct_negative")),
        "growth_pct": F.when(
            F.col("prev_n_total") > 0,
            round_half_up(ratio(F.col("n_total") - F.col("prev_n_total"),
                                "prev_n_total") * F.lit(100))),
    })


def level_indicators(stats: DataFrame, level: Level, period: str = "period") -> DataFrame:
    """Indicator block of one level from statistics already at that level."""
    out = with_changes(_measures(stats), level, period)
    return out.select(period, *level.keys, *INDICATOR_COLUMNS)


def fact_leaf(gold: DataFrame, period: str = "period") -> DataFrame:
    return leaf_stats(gold, AREA.keys, period)


def indicators_for(gold: DataFrame, level: Level, period: str = "period") -> DataFrame:
    """Indicator block of one level, computed through the leaf statistics."""
    leaf = fact_leaf(gold, period)
    stats = leaf if level is AREA else roll_up(leaf, level.keys, period)
    return level_indicators(stats, level, period)


def all_levels(gold: DataFrame, period: str = "period", levels: Sequence[Level] = LEVELS,
               leaf: DataFrame | None = None) -> DataFrame:
    """All levels stacked with a level tag and placeholder keys.

    ``leaf`` may be a persisted/checkpointed leaf frame; otherwise the leaf
    aggregate is one exchange that Spark reuses for every level.
    """
    leaf = leaf if leaf is not None else fact_leaf(gold, period)
    parts = []
    for level in levels:
        stats = leaf if level.keys == AREA.keys else roll_up(leaf, level.keys, period)
        parts.append((level, level_indicators(stats, level, period)))
    return stacked(parts, period)


def stacked(blocks: Sequence[tuple[Level, DataFrame]], period: str = "period") -> DataFrame:
    """Indicator blocks of several levels as one table, with tag and placeholders."""
    parts = [block.withColumns({"level": F.lit(level.name),
                                **{k: F.lit(v) for k, v in level.placeholders.items()}})
             .select(period, "level", *ALL_LEVEL_KEYS, *INDICATOR_COLUMNS) for level, block in blocks]
    return reduce(lambda a, b: a.unionByName(b), parts)


def grouping_sets_base(gold: DataFrame, period: str = "period") -> DataFrame:
    """Cross-check: the three levels' measures with GROUPING SETS on the fact."""
    y = F.col("outcome")
    sets = [[period, *lvl.keys] for lvl in LEVELS]
    agg = gold.groupingSets(sets, period, *ALL_LEVEL_KEYS).agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count(y).alias("n_known"),
        F.sum(F.when(y == 1, 1).otherwise(0)).cast("bigint").alias("n_pos"),
        F.sum(F.when(y == 0, 1).otherwise(0)).cast("bigint").alias("n_neg"),
        exact_sum("measure").alias("sum_measure"),
        F.count("measure").alias("n_measure"),
        F.grouping_id().alias("gid"),
    )
    # grouping_id: one bit per grouping column, first column = highest bit,
    # set when the column is aggregated away. Region rows drop area code and
    # name (bits 4 and 2); country rows also drop region code and name.
    gid = F.col("gid")
    level = (F.when(gid == 0, F.lit(AREA.name))
             .when(gid == 0b000110, F.lit(REGION.name))
             .otherwise(F.lit(COUNTRY.name)))
    out = _measures(agg).withColumn("level", level)
    for lvl in (REGION, COUNTRY):
        out = out.withColumns({
            k: F.when(F.col("level") == lvl.name, F.lit(v)).otherwise(F.col(k))
            for k, v in lvl.placeholders.items()})
    return out.select(period, "level", *ALL_LEVEL_KEYS, *MEASURE_COLUMNS)
