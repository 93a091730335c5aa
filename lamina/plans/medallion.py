"""End-to-end batch: raw -> clean -> published tables, written under a root.

Each layer is read back from storage by the next, as separate batch jobs
would (and as the reference's stages do), so a failed run restarts from the
last written layer and no layer's plan drags the previous one's lineage.

* raw: per-wave sources stacked by name with lineage columns;
* clean: lower-case names, whole-row dedup, fact filters, trimmed text,
  upper-cased code columns; plus a null profile per table;
* published: the enriched/decoded fact (partitioned by period), the
  indicator block of every level and all levels together (partitioned by
  period), and a narrow reference table (partitioned by year).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lamina.operators import clean as cl
from lamina.operators import enrich as en
from lamina.operators import indicators as ind
from lamina.operators import ingest as ing
from lamina.operators import profile as pr
from lamina.sources import versions


@dataclass
class BatchSources:
    """Per-entity lists of per-wave source frames."""

    fact: Sequence[DataFrame]
    regions: Sequence[DataFrame]
    areas: Sequence[DataFrame]
    others: Mapping[str, Sequence[DataFrame]]
    reference: DataFrame | None = None
    reference_partition: str | None = None


def run_batch(spark: SparkSession, src: BatchSources, root: str, fmt: str = "parquet",
              upper_codes: Sequence[str] = ()) -> dict[str, str]:
    """Write every layer under ``root``; returns {table name: path}. A rerun replaces each
    table atomically (``sources.versions``): one that stops leaves every table whole."""
    paths: dict[str, str] = {}

    def put(name: str, df: DataFrame, partition_by: Sequence[str] = (), deal: bool = True) -> DataFrame:
        paths[name] = versions.replace(df, f"{root}/{name}", fmt, partition_by, deal=deal)
        return versions.read(spark, paths[name])

    # raw layer
    raw = {"fact": put("raw_fact", ing.stack_periods(src.fact)),
           "regions": put("raw_regions", ing.stack_periods(src.regions)),
           "areas": put("raw_areas", ing.stack_periods(src.areas))}
    for name, frames in src.others.items():
        raw[name] = put(f"raw_{name}", ing.stack_periods(frames))

    # clean layer (lineage columns stay, as in the reference; dedup keeps them)
    cleaned, counts = cl.clean_fact_counted(raw["fact"], upper=upper_codes)
    clean = {"fact": put("clean_fact", cleaned)}
    put("audit_clean_fact", spark.createDataFrame(
        [tuple(counts.get().values())], ", ".join(f"{n} long" for n in counts.NAMES)))
    for name in ("regions", "areas", *src.others):
        clean[name] = put(f"clean_{name}", cl.clean_table(raw[name], upper=upper_codes))
    for name, df in clean.items():
        put(f"profile_nulls_{name}", pr.null_profile_long(df))

    # published layer
    fact = clean["fact"].select(*[c for c in clean["fact"].columns
                                  if c not in (ing.INGESTED_AT, ing.ORIGIN)])
    gold = put("published_fact", en.gold_fact(fact, clean["regions"], clean["areas"]),
               partition_by=["period"], deal=False)     # years: large tables aren't shuffled for them
    leaf = put("published_leaf_stats", ind.fact_leaf(gold))
    written = []
    for level in ind.LEVELS:
        stats = leaf if level is ind.AREA else ind.roll_up(leaf, level.keys)
        written.append((level, put(f"published_indicators_{level.name}", ind.level_indicators(stats, level),
                                   partition_by=["period"])))
    put("published_indicators", ind.stacked(written), partition_by=["period"])
    if src.reference is not None:
        put("published_reference", src.reference,
            partition_by=[src.reference_partition] if src.reference_partition else [], deal=False)
    return paths
