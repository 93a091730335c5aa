"""Model frame: fact joined to indicators, group context, derived features,
feature selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from lamina import fixed
from lamina.plans.joins import DEFAULT_BROADCAST_BYTES, join_aggregate

INDICATOR_JOIN_KEYS = ("period", "region_code", "area_code", "segment_code")


def drop_overlap(right: DataFrame, left: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop from ``right`` the non-key columns that ``left`` already has."""
    return right.drop(*[c for c in right.columns if c in left.columns and c not in keys])


def join_indicators(fact: DataFrame, indicators: DataFrame,
                    keys: Sequence[str] = INDICATOR_JOIN_KEYS, weight: str = "n_total",
                    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Left join of the fact to an aggregated indicator table, whose column ``weight``
    counts the rows of a key: broadcast where proven small, else heavy keys and null keys
    apart from the shuffle join."""
    ind = drop_overlap(indicators.withColumn("__weight", F.col(weight)), fact, keys)
    return join_aggregate(fact, ind, keys, "__weight", max_bytes=max_broadcast_bytes).drop("__weight")


def group_rate(df: DataFrame, group: str, outcome: str,
               prior_pos: float = fixed.RATE_PRIOR_POSITIVES,
               prior_n: float = fixed.RATE_PRIOR_COUNT, exclude_self: bool = False,
               rate_col: str = "group_rate", volume_col: str = "group_volume",
               max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Smoothed outcome rate of each row's group: (sum(y) + a) / (count(y) + b)
    and the group volume count(y). Null outcomes are ignored; a group with no
    known outcome gets a null rate; null group ids form one group.

    Computed as a map-side-combined group-by joined back null-safely, so a hot
    group costs one row per task in the shuffle, not all its rows; where the groups
    are too many to broadcast, heavy ones are joined apart (``join_aggregate``).
    ``exclude_self`` removes the row's own outcome (leave-one-out).
    """
    y = F.col(outcome)
    stats = df.groupBy(group).agg(F.sum(y).cast("double").alias("__s"),
                                  F.count(y).alias("__c"), F.count(F.lit(1)).alias("__n"))
    out = join_aggregate(df, stats, [group], "__n", null_safe=True, max_bytes=max_broadcast_bytes)
    s, c = F.col("__s"), F.col("__c")
    if exclude_self:
        s = s - F.coalesce(y.cast("double"), F.lit(0.0))
        c = c - F.when(y.isNotNull(), 1).otherwise(0)
        s = F.when(c > 0, s)  # nothing left -> null, like an all-null group
    rate = (s + F.lit(prior_pos)) / (c.cast("double") + F.lit(prior_n))
    return out.withColumns({rate_col: rate, volume_col: c.cast("bigint")}).drop("__s", "__c", "__n")


# Optional derived features: inputs that exist only in some data sets.
DERIVED_INPUTS = {
    "income": "income_current",
    "vulnerability": "vulnerability_current",
    "index_current": "index_current",
    "index_previous": "index_previous",
    "rate_current": "rate_current",
    "rate_previous": "rate_previous",
}


def derived_features(df: DataFrame, names: dict = DERIVED_INPUTS) -> DataFrame:
    """Ratio, log and change features, each added only if its inputs exist.

    ``log1p(max(0, x))`` keeps null for a null x (no silent 0); a zero
    denominator gives null instead of an error.
    """
    cols = set(df.columns)
    inc, vul = names["income"], names["vulnerability"]
    idx, idx_prev = names["index_current"], names["index_previous"]
    rate, rate_prev = names["rate_current"], names["rate_previous"]
    new = {}
    if inc in cols and vul in cols:
        new["income_vulnerability_ratio"] = F.try_divide(F.col(inc), F.col(vul) + F.lit(1.0))
        new["log_income"] = F.when(F.col(inc).isNotNull(),
                                   F.log1p(F.greatest(F.lit(0.0), F.col(inc).cast("double"))))
    if idx in cols and vul in cols:
        new["social_pressure"] = F.try_divide(F.col(vul), F.col(idx) + F.lit(1e-4))
    if idx in cols and idx_prev in cols:
        new["index_change"] = F.col(idx) - F.col(idx_prev)
    if rate in cols and rate_prev in cols:
        new["rate_change"] = F.col(rate) - F.col(rate_prev)
    return df.withColumns(new) if new else df


# Columns that leak the outcome or identify the row, never used as features.
LEAKAGE = ("measure", "outcome_label", "mean_measure", "pct_positive", "pct_negative",
           "entity_id", "period", "area_code", "area_name", "present", "present_label")
CATEGORICAL_OVERRIDES = ("group_id",)


def feature_columns(df: DataFrame, target: str = "outcome", exclude: Sequence[str] = LEAKAGE,
                    categorical_overrides: Sequence[str] = CATEGORICAL_OVERRIDES,
                    ignore: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(numeric, categorical) feature names by schema. Every numeric type is
    numeric; strings are categorical; ids listed in ``categorical_overrides``
    move to categorical. Any other type raises instead of being dropped."""
    numeric, categorical = [], []
    skip = set(exclude) | {target} | set(ignore)
    for f in df.schema.fields:
        if f.name in skip:
            continue
        if f.name in categorical_overrides or isinstance(f.dataType, StringType):
            categorical.append(f.name)
        elif isinstance(f.dataType, NumericType):
            numeric.append(f.name)
        else:
            raise TypeError(f"feature {f.name!r} has unsupported type {f.dataType}")
    return numeric, categorical


def select_features(df: DataFrame, target: str = "outcome", keep: Sequence[str] = (),
                    **kw) -> DataFrame:
    numeric, categorical = feature_columns(df, target, ignore=keep, **kw)
    return df.select(*keep, *numeric, *categorical, target)
