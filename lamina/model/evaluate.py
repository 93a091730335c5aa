"""Evaluation of a probability score against a 0/1 label, as aggregations.

Nothing is collected: confusion cells are conditional counts; ROC-AUC and the
ROC curve need running sums over the score order, which are computed per bucket
of distinct scores, with buckets taken from the data, so no window spans all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina import fixed
from lamina.plans.joins import materialize, sized_broadcast

def _safe(num: Column, den: Column) -> Column:
    """num / den, 0 when den is 0 (zero-division -> 0 convention)."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den)


def predicted(score: str, threshold: float | Column, strict: bool = False) -> Column:
    t = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return F.when((F.col(score) > t) if strict else (F.col(score) >= t), 1).otherwise(0)


def confusion_cells(df: DataFrame, label: str, score: str, threshold: float | Column = 0.5,
                    strict: bool = False, group: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn (class 1 = positive) per group, one aggregation."""
    y = F.col(label)
    p = predicted(score, threshold, strict)
    cells = [F.count(F.when((y == 1) & (p == 1), 1)).alias("tp"),
             F.count(F.when((y == 0) & (p == 1), 1)).alias("fp"),
             F.count(F.when((y == 1) & (p == 0), 1)).alias("fn"),
             F.count(F.when((y == 0) & (p == 0), 1)).alias("tn")]
    known = df.where(y.isNotNull())
    return known.groupBy(*group).agg(*cells) if group else known.agg(*cells)


def confusion_matrix(df: DataFrame, label: str, score: str, threshold: float | Column = 0.5,
                     strict: bool = False) -> DataFrame:
    """Dense 2x2 in long form: (actual, predicted, n), zero cells included."""
    cells = confusion_cells(df, label, score, threshold, strict)
    items = F.array(*[F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"),
                               F.col(c).alias("n"))
                      for a, b, c in ((1, 1, "tp"), (0, 1, "fp"), (1, 0, "fn"), (0, 0, "tn"))])
    return cells.select(F.explode(items).alias("c")).select("c.*")


def metric_columns(cells: DataFrame) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    f1_1 = _safe(2 * tp, 2 * tp + fp + fn)
    f1_0 = _safe(2 * tn, 2 * tn + fn + fp)
    return cells.withColumns({
        "accuracy": _safe(tp + tn, n),
        "f1": f1_1,
        "f1_macro": (f1_1 + f1_0) / F.lit(2.0),
        "recall_class0": _safe(tn, tn + fp),
    })


def below_sums(df: DataFrame, label: str, score: str, group: Sequence[str] = (),
               buckets: int | None = None, neighbours: bool = False) -> DataFrame:
    """Per (group, distinct score): n_pos, n_neg and the counts of positives /
    negatives with a strictly lower score, without a global window. ``neighbours`` adds
    ``lower``, the next lower score's (n_pos, n_neg); null for the lowest one.

    Distinct scores are dealt out by ranges that Spark samples from them, so that
    buckets are even whatever the scores' distribution; running sums are taken over
    the buckets, and within each one. Buckets exchange their sums and last scores alone.
    """
    y = F.col(label)
    g = list(group)
    n = buckets or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_score = (df.where(y.isNotNull() & F.col(score).isNotNull())
                 .groupBy(*g, score)
                 .agg(F.count(F.when(y == 1, 1)).alias("n_pos"),
                      F.count(F.when(y == 0, 1)).alias("n_neg"))
                 .repartitionByRange(n, *g, score).withColumn("__b", F.spark_partition_id()))
    per_score = materialize(per_score, "scores")     # read twice: the buckets must be the same
    per_bucket = per_score.groupBy(*g, "__b").agg(F.sum("n_pos").alias("bp"),
                                                  F.sum("n_neg").alias("bn"),
                                                  F.max_by(F.struct("n_pos", "n_neg"), score).alias("last"))
    wb = Window.partitionBy(*g).orderBy("__b")       # at most n rows a group
    offsets = per_bucket.select(*g, "__b",
                                (F.sum("bp").over(wb) - F.col("bp")).alias("off_pos"),
                                (F.sum("bn").over(wb) - F.col("bn")).alias("off_neg"),
                                *([F.lag("last").over(wb).alias("before")] if neighbours else []))
    ws = Window.partitionBy(*g, "__b").orderBy(score)
    within = per_score.withColumns({
        "in_pos": F.sum("n_pos").over(ws) - F.col("n_pos"),
        "in_neg": F.sum("n_neg").over(ws) - F.col("n_neg")})
    if neighbours:
        within = within.withColumn("within", F.lag(F.struct("n_pos", "n_neg")).over(ws))
    j = within.join(sized_broadcast(offsets, derived=True), [*g, "__b"], "inner")
    return j.select(*g, score, "n_pos", "n_neg",
                    (F.col("off_pos") + F.col("in_pos")).alias("pos_below"),
                    (F.col("off_neg") + F.col("in_neg")).alias("neg_below"),
                    *([F.coalesce("within", "before").alias("lower")] if neighbours else []))


def roc_auc(df: DataFrame, label: str, score: str, group: Sequence[str] = (),
            buckets: int | None = None) -> DataFrame:
    """Exact ROC-AUC (Mann-Whitney, ties count one half) per group."""
    s = below_sums(df, label, score, group, buckets)
    wins = F.col("n_pos").cast("double") * (F.col("neg_below").cast("double")
                                            + F.lit(0.5) * F.col("n_neg").cast("double"))
    aggs = [F.sum(wins).alias("__w"), F.sum("n_pos").alias("__p"), F.sum("n_neg").alias("__n")]
    out = s.groupBy(*group).agg(*aggs) if group else s.agg(*aggs)
    # a group with only one class has no pairs: null, not an error
    auc = F.try_divide(F.col("__w"), F.col("__p").cast("double") * F.col("__n").cast("double"))
    return out.select(*group, auc.alias("roc_auc"))


def roc_curve_points(df: DataFrame, label: str, score: str,
                     buckets: int | None = None) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score: rates of rows scoring >= it."""
    return _roc_points(df, label, score, below_sums(df, label, score, (), buckets), F.lit(True))


def roc_curve(df: DataFrame, label: str, score: str, buckets: int | None = None) -> DataFrame:
    """(threshold, fpr, tpr) of the curve's bends: it starts at (0, 0) with an infinite
    threshold; of the distinct scores' points those are left out, but for the first and
    the last, behind which the curve goes on by the same step."""
    s = below_sums(df, label, score, (), buckets, neighbours=True)
    step = F.struct("n_pos", "n_neg")
    first = (F.col("pos_below") + F.col("n_pos") == F.col("__P")) & (F.col("neg_below") + F.col("n_neg") == F.col("__N"))
    points = _roc_points(df, label, score, s, F.col("lower").isNull() | first | (F.col("lower") != step))
    start = df.sparkSession.range(1).select(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"),
                                            F.lit(0.0).alias("tpr"))
    return start.unionByName(points)


def _roc_points(df: DataFrame, label: str, score: str, s: DataFrame, keep: Column) -> DataFrame:
    tot = df.where(F.col(label).isNotNull() & F.col(score).isNotNull()).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("P"),
        F.count(F.when(F.col(label) == 0, 1)).alias("N")).first()
    P, N = float(tot["P"]), float(tot["N"])
    tpr = (F.lit(P) - F.col("pos_below")) / F.lit(P) if P else F.lit(None)
    fpr = (F.lit(N) - F.col("neg_below")) / F.lit(N) if N else F.lit(None)
    s = s.withColumns({"__P": F.lit(tot["P"]), "__N": F.lit(tot["N"])}).filter(keep)
    return s.select(F.col(score).alias("threshold"), fpr.cast("double").alias("fpr"), tpr.cast("double").alias("tpr"))


def threshold_grid(start: int = fixed.SWEEP_START_PCT, count: int = fixed.SWEEP_POINTS,
                   div: int = fixed.SWEEP_DIVISOR) -> list[float]:
    return [(start + i) / div for i in range(count)]


def threshold_sweep(df: DataFrame, label: str, score: str, start: int = fixed.SWEEP_START_PCT,
                    count: int = fixed.SWEEP_POINTS, div: int = fixed.SWEEP_DIVISOR) -> DataFrame:
    """Class-0 F1 at thresholds (start+i)/div, predicting 1 when score >= t.

    Each row gets j = number of thresholds <= its score (JVM-side
    comparisons), so one group-by on j replaces a rows x thresholds product;
    a running sum over the count+1 values of j gives every threshold's cells.
    """
    spark = df.sparkSession
    ts = threshold_grid(start, count, div)
    p = F.col(score)
    j = sum((F.when(p >= F.lit(t), 1).otherwise(0) for t in ts), F.lit(0))
    y = F.col(label)
    per_j = (df.where(y.isNotNull()).withColumn("j", j).groupBy("j")
             .agg(F.count(F.when(y == 1, 1)).alias("pos"), F.count(F.when(y == 0, 1)).alias("neg")))
    dense = spark.range(count + 1).select(F.col("id").cast("int").alias("j"))
    w = Window.orderBy("j").rowsBetween(Window.unboundedPreceding, 0)  # count+1 rows
    cum = (dense.join(per_j, "j", "left").na.fill(0, ["pos", "neg"])
           .withColumns({"cum_pos": F.sum("pos").over(w), "cum_neg": F.sum("neg").over(w),
                         "all_neg": F.sum("neg").over(Window.partitionBy())}))
    # threshold i predicts 0 for rows with j <= i
    tp0, fp0 = F.col("cum_neg"), F.col("cum_pos")
    fn0 = F.col("all_neg") - F.col("cum_neg")
    out = cum.where(F.col("j") < count).select(
        ((F.lit(start) + F.col("j")).cast("double") / F.lit(div)).alias("threshold"),
        tp0.alias("tp"), fp0.alias("fp"), fn0.alias("fn"),
        _safe(2 * tp0, 2 * tp0 + fp0 + fn0).alias("f1_class0"))
    return out


def best_threshold(sweep: DataFrame, default: float = fixed.DEFAULT_THRESHOLD) -> DataFrame:
    """Highest class-0 F1, the lowest threshold on ties; ``default`` if all 0."""
    best = sweep.orderBy(F.col("f1_class0").desc(), F.col("threshold").asc()).limit(1)
    return best.select(
        F.when(F.col("f1_class0") > 0, F.col("threshold")).otherwise(F.lit(default))
        .alias("threshold"), "f1_class0")


def best_threshold_value(sweep: DataFrame, default: float = fixed.DEFAULT_THRESHOLD) -> float:
    return float(best_threshold(sweep, default).first()["threshold"])


def classification_report(df: DataFrame, label: str, score: str,
                          threshold: float | Column = 0.5) -> DataFrame:
    """(label, precision, recall, f1, support) for class 0, class 1, accuracy,
    macro avg and weighted avg, from one row of confusion cells."""
    cells = confusion_cells(df, label, score, threshold)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    p0, r0 = _safe(tn, tn + fn), _safe(tn, tn + fp)
    p1, r1 = _safe(tp, tp + fp), _safe(tp, tp + fn)
    f0, f1 = _safe(2 * p0 * r0, p0 + r0), _safe(2 * p1 * r1, p1 + r1)
    s0, s1 = tn + fp, tp + fn
    w0, w1 = _safe(s0, n), _safe(s1, n)
    acc = _safe(tp + tn, n)

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("label"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
                        s.cast("bigint").alias("support"))

    none = F.lit(None).cast("double")
    rows = F.array(row("0", p0, r0, f0, s0), row("1", p1, r1, f1, s1),
                   row("accuracy", none, none, acc, n),
                   row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
                   row("weighted avg", p0 * w0 + p1 * w1, r0 * w0 + r1 * w1, f0 * w0 + f1 * w1, n))
    return cells.select(F.explode(rows).alias("r")).select("r.*")


def binary_metrics(df: DataFrame, label: str, score: str, group: Sequence[str] = (),
                   threshold: float = fixed.DEFAULT_THRESHOLD, strict: bool = True,
                   buckets: int | None = None) -> DataFrame:
    """accuracy, f1 (class 1), f1_macro, recall_class0 at the model's own rule
    (class 1 when p > 0.5) and ROC-AUC, per group."""
    cells = metric_columns(confusion_cells(df, label, score, threshold, strict, group))
    m = cells.select(*group, "accuracy", "f1", "f1_macro", "recall_class0")
    auc = roc_auc(df, label, score, group, buckets)
    if group:
        return m.join(auc, list(group), "left")
    return m.withColumn("roc_auc", F.lit(auc.first()["roc_auc"]))


def champion(metrics: DataFrame, model_col: str = "model", order_col: str = "model_order",
             by: str = "roc_auc") -> DataFrame:
    """Best model by ``by``; the first listed wins ties."""
    return metrics.orderBy(F.col(by).desc(), F.col(order_col).asc()).limit(1)
