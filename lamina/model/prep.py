"""Preprocessing statistics, all computed as distributed aggregations.

* exact medians: approximate quantiles narrow the value range, then the counts of the
  values inside are ranked by ranges; no step holds a whole column in one task;
* mean / population std for standardising;
* most frequent value per categorical column (ties -> smallest value);
* target encoding with empirical-Bayes ("auto") smoothing, cross-fitted over
  hash folds: out-of-fold statistics are totals minus the fold's own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from lamina.plans.joins import DEFAULT_BROADCAST_BYTES, materialize, sized_broadcast

# -- exact order statistics ---------------------------------------------------------


def _brackets(data: DataFrame, wanted: dict[str, Sequence[int]], counts: dict[str, int],
              rel_err: float) -> dict[str, tuple[float, float, int]]:
    """Per column (lo, hi, rows below lo) with all wanted ranks among the rows of
    lo <= x <= hi: one approximate-quantile pass and one count over all columns.
    A column whose ranks the sketch missed is left out."""
    if not wanted:
        return {}
    probs = {c: (max(0.0, min(r) / counts[c] - 2 * rel_err), min(1.0, (max(r) + 1) / counts[c] + 2 * rel_err))
             for c, r in wanted.items()}
    listed = sorted({p for pair in probs.values() for p in pair})
    found = dict(zip(wanted, data.approxQuantile(list(wanted), listed, rel_err)))
    ends = {c: tuple(found[c][listed.index(p)] for p in probs[c]) for c in wanted}
    row = data.agg(*[f for c, (lo, hi) in ends.items() for f in (
        F.count(F.when(F.col(c) < lo, 1)).alias(f"b_{c}"),
        F.count(F.when(F.col(c).between(lo, hi), 1)).alias(f"i_{c}"))]).first()
    return {c: (lo, hi, row[f"b_{c}"]) for c, (lo, hi) in ends.items()
            if row[f"b_{c}"] <= min(wanted[c]) and row[f"b_{c}"] + row[f"i_{c}"] > max(wanted[c])}


def kth_smallest_many(data: DataFrame, wanted: dict[str, Sequence[int]],
                      max_exact_rows: int = 1_000_000, rel_err: float = 1e-3,
                      buckets: int | None = None) -> dict[str, list[float]]:
    """Exact values at 0-based ranks (close together) of several columns.

    Columns with more than ``max_exact_rows`` values are first bracketed with Spark's
    quantile sketch. What is left is counted by (column, value) - tied values are one
    row - and dealt out by ranges; the buckets' sums tell which ones hold the ranks,
    and only these are ranked. No step needs a bound on the number of values.
    """
    counts = data.agg(*[F.count(F.col(c)).alias(c) for c in wanted]).first().asDict()
    large = {c: r for c, r in wanted.items() if counts[c] > max_exact_rows}
    inside = _brackets(data, large, counts, rel_err)
    items = F.array(*[F.struct(
        F.lit(c).alias("feature"),
        (F.when(F.col(c).between(*inside[c][:2]), F.col(c)) if c in inside else F.col(c)).alias("v")) for c in wanted])
    n = buckets or 4 * int(data.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    vals = (data.select(F.explode(items).alias("it")).select("it.*").where(F.col("v").isNotNull())
            .groupBy("feature", "v").agg(F.count(F.lit(1)).alias("n"))
            .repartitionByRange(n, "feature", "v").withColumn("b", F.spark_partition_id()))
    vals = materialize(vals, "order-statistics")
    sums = vals.groupBy("feature", "b").agg(F.sum("n").alias("n")).collect()    # columns x buckets
    ranks = []          # (feature, bucket, rank within it, wanted rank)
    for c, wanted_ranks in wanted.items():
        own = sorted((r["b"], r["n"]) for r in sums if r["feature"] == c)
        for k in wanted_ranks:
            left = k - (inside[c][2] if c in inside else 0)
            for b, size in own:
                if left < size:
                    ranks.append((c, b, left, k))
                    break
                left -= size
    at = None
    for c, b in {(c, b) for c, b, _, _ in ranks}:
        cond = (F.col("feature") == c) & (F.col("b") == b)
        at = cond if at is None else at | cond
    w = Window.partitionBy("feature", "b").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    cum = vals.where(at).withColumn("cum", F.sum("n").over(w))
    hit = None
    for c, b, r, _ in ranks:
        cond = (F.col("feature") == c) & (F.col("b") == b) & (F.col("cum") > r) & (F.col("cum") - F.col("n") <= r)
        hit = cond if hit is None else hit | cond
    rows = cum.where(hit).collect()
    value = {(c, k): next(float(x["v"]) for x in rows if (x["feature"], x["b"]) == (c, b) and x["cum"] - x["n"] <= r < x["cum"])
             for c, b, r, k in ranks}
    return {c: [value[c, k] for k in r] for c, r in wanted.items()}


def exact_medians(df: DataFrame, columns: Sequence[str], **kw) -> dict[str, float | None]:
    """Interpolated median (mean of the two middle values) of every column.

    The numeric projection is persisted for the few passes this takes and
    released afterwards (a cache, rebuilt from lineage if an executor is lost).
    """
    if not columns:
        return {}
    data = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).persist()
    try:
        counts = data.agg(*[F.count(F.col(c)).alias(c) for c in columns]).first()
        wanted = {c: [(int(counts[c]) - 1) // 2, int(counts[c]) // 2]
                  for c in columns if counts[c]}
        got = kth_smallest_many(data, wanted, **kw) if wanted else {}
    finally:
        data.unpersist()
    return {c: ((got[c][0] + got[c][1]) / 2.0 if c in got else None) for c in columns}


def approx_medians(df: DataFrame, columns: Sequence[str], rel_err: float = 1e-4) -> dict:
    """Spark ML Imputer's notion: approximate lower median, one pass."""
    qs = df.approxQuantile(list(columns), [0.5], rel_err)
    return {c: (q[0] if q else None) for c, q in zip(columns, qs)}


def impute(df: DataFrame, values: dict, as_double: bool = True) -> DataFrame:
    return df.withColumns({
        c: F.coalesce(F.col(c).cast("double") if as_double else F.col(c), F.lit(v))
        for c, v in values.items()})


# -- standardising ----------------------------------------------------------------


def mean_std(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std per column from one aggregation; std 0 -> 1."""
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    r = df.agg(*aggs).first()
    out = {}
    for c in columns:
        m, s = r[f"m_{c}"], r[f"s_{c}"]
        out[c] = (m, 1.0 if (s is None or s == 0.0) else s)
    return out


def standardize(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in stats.items()})


# -- most frequent ------------------------------------------------------------------


def long_categories(df: DataFrame, columns: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """(extra..., feature, category) with every category cast to string."""
    return df.select(*extra, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        list(extra), list(columns), "feature", "category")


def most_frequent(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, category, n): the most frequent non-null value per column,
    ties to the smallest value (numeric order for numeric columns). One
    aggregation over all columns."""
    numeric = {f.name for f in df.schema.fields
               if f.name in columns and isinstance(f.dataType, NumericType)}
    items = F.array(*[F.struct(
        F.lit(c).alias("feature"), F.col(c).cast("string").alias("category"),
        (F.col(c).cast("double") if c in numeric else F.lit(None).cast("double"))
        .alias("order_key")) for c in columns])
    long = df.select(F.explode(items).alias("it")).select("it.*")  # one scan
    counts = (long.where(F.col("category").isNotNull())
              .groupBy("feature", "category", "order_key").agg(F.count(F.lit(1)).alias("n")))
    best = counts.groupBy("feature").agg(
        F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("order_key"), F.col("category")))
        .alias("b"))
    return best.select("feature", F.col("b.category").alias("category"),
                       (-F.col("b.neg_n")).alias("n"))


def impute_modes(df: DataFrame, modes: dict) -> DataFrame:
    """Fill nulls of each categorical column (as string) with its mode."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(v))
                           for c, v in modes.items()})


# -- target encoding ---------------------------------------------------------------


def _encode(n, s, g_mean, g_var):
    """Empirical-Bayes blend for a 0/1 target: lambda = n*tau2/(n*tau2 + var_c)
    with var_c = p(1-p) of the category and tau2 the overall variance;
    0/0 -> weight 0 (global mean)."""
    mean_c = s / n
    var_c = mean_c * (F.lit(1.0) - mean_c)
    num = n * g_var
    lam = F.when((num + var_c) == 0, F.lit(0.0)).otherwise(num / (num + var_c))
    return lam * mean_c + (F.lit(1.0) - lam) * g_mean


def target_stats(df: DataFrame, columns: Sequence[str], target: str,
                 fold_col: str | None = None) -> DataFrame:
    """(feature, category[, fold], n, s): rows and positives per category."""
    extra = [target] + ([fold_col] if fold_col else [])
    long = long_categories(df, columns, extra).where(F.col(target).isNotNull())
    keys = ["feature", "category"] + ([fold_col] if fold_col else [])
    return long.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("n"),
                                   F.sum(F.col(target)).cast("double").alias("s"))


def global_rate(df: DataFrame, target: str, fold_col: str | None = None):
    """Mean target overall (a float), or per held-out fold: {fold: mean of the
    other folds}. Scalars only, from one small aggregation."""
    known = df.where(F.col(target).isNotNull())
    if fold_col is None:
        return known.agg(F.avg(F.col(target).cast("double"))).first()[0]
    rows = known.groupBy(fold_col).agg(F.count(F.lit(1)).alias("n"),
                                       F.sum(F.col(target)).alias("s")).collect()
    tn, ts = sum(r["n"] for r in rows), sum(r["s"] for r in rows)
    return {r[fold_col]: ((ts - r["s"]) / (tn - r["n"]) if tn > r["n"] else None)
            for r in rows}


def _by_fold(values: dict, fold_col: str):
    expr = None
    for f, v in sorted(values.items()):
        expr = (F.when(F.col(fold_col) == F.lit(f), F.lit(v)) if expr is None
                else expr.when(F.col(fold_col) == F.lit(f), F.lit(v)))
    return expr


def target_encoding(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Full-data encoding: (feature, category, n, encoding)."""
    stats = target_stats(df, columns, target)
    gm = F.lit(global_rate(df, target))
    return stats.select("feature", "category", "n",
                        _encode(F.col("n"), F.col("s"), gm, gm * (F.lit(1.0) - gm))
                        .alias("encoding"))


def target_encoding_oof(df: DataFrame, columns: Sequence[str], target: str,
                        fold_col: str) -> DataFrame:
    """Out-of-fold encoding per (feature, category, fold) present in the data:
    statistics of the other folds = category totals - the fold's own, and the
    global mean of the other folds. A category seen only in its own fold gets
    that global mean."""
    per_fold = target_stats(df, columns, target, fold_col)
    totals = per_fold.groupBy("feature", "category").agg(F.sum("n").alias("tn"),
                                                         F.sum("s").alias("ts"))
    gm = _by_fold(global_rate(df, target, fold_col), fold_col)
    j = per_fold.join(totals, ["feature", "category"], "inner")
    n_out = F.col("tn") - F.col("n")
    s_out = F.col("ts") - F.col("s")
    enc = F.when(n_out > 0, _encode(n_out, s_out, gm, gm * (F.lit(1.0) - gm))).otherwise(gm)
    return j.select("feature", "category", fold_col, n_out.alias("n_out"), enc.alias("encoding"))


def apply_encoding(df: DataFrame, columns: Sequence[str], encoding: DataFrame,
                   default, fold_col: str | None = None,
                   max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Replace each categorical column by its encoding; an unseen category gets
    ``default`` (a float, or with ``fold_col`` a {fold: float} dict). One
    equi-join per column against that column's slice of the encoding table."""
    out = df
    dflt = _by_fold(default, fold_col) if isinstance(default, dict) else F.lit(default)
    for c in columns:
        cat, enc = f"__cat_{c}", f"__enc_{c}"
        table = (encoding.where(F.col("feature") == F.lit(c))
                 .select(F.col("category").alias(cat),
                         *([F.col(fold_col).alias(f"__fold_{c}")] if fold_col else []),
                         F.col("encoding").alias(enc)))
        table = sized_broadcast(table, max_broadcast_bytes, derived=True)
        left = out.withColumn(cat, F.col(c).cast("string"))
        keys = [cat]
        if fold_col:
            left = left.withColumn(f"__fold_{c}", F.col(fold_col))
            keys.append(f"__fold_{c}")
        out = (left.join(table, keys, "left")
               .withColumn(c, F.coalesce(F.col(enc), dflt))
               .drop(*keys, enc))
    return out
