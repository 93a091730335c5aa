"""Dimension enrichment, default filling and code decoding (the published fact)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.functions.exprs import (
    NOT_INFORMED,
    OUTCOME_LABELS,
    PRESENCE_LABELS,
    SEGMENT_LABELS,
    UNKNOWN,
    decode,
    fill_code,
    fill_text,
)
from lamina.plans.joins import DEFAULT_BROADCAST_BYTES, sized_broadcast

ON_DUPLICATE = ("fanout", "error", "first")


def distinct_dim(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct projection of a dimension (distinct on the whole projection)."""
    return df.select(*columns).distinct()


def duplicate_keys(dim: DataFrame, key: str, name: str) -> DataFrame:
    """Keys of a (key, name) dimension that carry more than one name."""
    return (dim.groupBy(key)
            .agg(F.count_distinct(name).alias("n_names"),
                 F.min(name).alias("first_name"), F.max(name).alias("last_name"))
            .filter(F.col("n_names") > 1))


def enrich(fact: DataFrame, dim: DataFrame, key: str, on_duplicate: str = "fanout",
           max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Left join ``fact`` to ``dim`` on ``key``.

    ``on_duplicate`` says what a key with several dimension rows does:
    ``fanout`` multiplies fact rows (plain join), ``error`` raises,
    ``first`` keeps the smallest value of every other column.
    A null key never matches and comes back with null dimension columns.
    """
    if on_duplicate not in ON_DUPLICATE:
        raise ValueError(f"on_duplicate must be one of {ON_DUPLICATE}")
    others = [c for c in dim.columns if c != key]
    if on_duplicate == "error":
        dup = dim.groupBy(key).count().filter(F.col("count") > 1)
        if dup.limit(1).count() > 0:
            raise ValueError(f"dimension key {key!r} is not unique")
    elif on_duplicate == "first":
        dim = dim.groupBy(key).agg(*[F.min(c).alias(c) for c in others])
    # not persisted: an in-memory dimension would stop Spark from reusing the
    # fact's exchanges across branches (e.g. the levels of the indicator block)
    return fact.join(sized_broadcast(dim, max_broadcast_bytes), on=key, how="left")


def fill_defaults(df: DataFrame, codes: Sequence[str] = (), texts: Sequence[str] = (),
                  code_value: int = 0, text_label: str = NOT_INFORMED) -> DataFrame:
    """Null numeric codes -> ``code_value``; null or empty texts -> ``text_label``."""
    for c in codes:
        dt = df.schema[c].dataType.typeName()
        if dt not in ("integer", "long", "short", "byte"):
            raise TypeError(f"code column {c!r} must be integral, got {dt}")
    return df.withColumns({**{c: fill_code(c, code_value) for c in codes},
                           **{c: fill_text(c, text_label) for c in texts}})


def decode_columns(df: DataFrame, specs: Mapping[str, tuple[str, Mapping]],
                   default: str = UNKNOWN) -> DataFrame:
    """Add label columns: ``{new: (source, {code: label})}``; unmatched -> default."""
    return df.withColumns({new: decode(src, mapping, default)
                           for new, (src, mapping) in specs.items()})


GOLD_COLUMNS = ("entity_id", "group_id", "period", "region_code", "region_name",
                "area_code", "area_name", "segment_code", "measure", "outcome", "present")

GOLD_DECODES = {
    "outcome_label": ("outcome", OUTCOME_LABELS),
    "present_label": ("present", PRESENCE_LABELS),
    "segment_label": ("segment_code", SEGMENT_LABELS),
}


def enrich_fact(fact: DataFrame, regions: DataFrame, areas: DataFrame,
                on_duplicate: str = "fanout") -> DataFrame:
    """Fact joined to both dimensions, defaults filled (not yet decoded)."""
    areas = distinct_dim(areas, ["area_code", "area_name"])
    regions = distinct_dim(regions, ["region_code", "region_name"])
    out = enrich(fact, areas, "area_code", on_duplicate)
    out = enrich(out, regions, "region_code", on_duplicate)
    return fill_defaults(out, codes=["area_code", "region_code", "segment_code"],
                         texts=["area_name", "region_name"])


def gold_fact(fact: DataFrame, regions: DataFrame, areas: DataFrame,
              on_duplicate: str = "fanout") -> DataFrame:
    """The published fact: 11 selected columns plus 3 decoded labels."""
    base = enrich_fact(fact, regions, areas, on_duplicate).select(*GOLD_COLUMNS)
    return decode_columns(base, GOLD_DECODES)
