"""Queries of the modelling stage that have an SQL oracle: model frame,
group context, sampling and splitting, preprocessing statistics, and
evaluation of a score (no trained model needed)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.functions.exprs import risk_tier, round_fine, round_half_up
from lamina.model import evaluate as ev
from lamina.model import prep
from lamina.model import split as sp
from lamina.model.train import class_weights
from lamina.operators import features as fe
from lamina.operators import indicators as ind
from lamina.plans import oracle_ml as sql
from lamina.plans.gold_queries import gold
from lamina.plans.joins import materialize, sized_broadcast
from lamina.plans.registry import register
from lamina.sources.tables import read_table

LABEL = "outcome"
NUMERIC = list(sql.NUMERIC)
CATEGORICAL = list(sql.CATEGORICAL)


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published fact, written once to the shared folder."""
    return materialize(gold(spark, sf_dir), "published-fact")


def model_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published fact + area indicators (overlap dropped) + group context.

    The published fact feeds the indicator aggregation, the indicator join and
    the group statistics with their join back, so it is written once to the
    shared folder (as the published table it is) and read for each use,
    instead of recomputing its joins three times."""
    g = published(spark, sf_dir)
    joined = fe.join_indicators(g, ind.indicators_for(g, ind.AREA))
    # derived features come before the selection; each is added where its inputs exist
    return fe.derived_features(fe.group_rate(joined, "group_id", LABEL))


def model_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    mf = sp.split_hash(model_base(spark, sf_dir), "entity_id")
    return mf.withColumn("fold", sp.fold_id("entity_id"))


def labeled(mf: DataFrame) -> DataFrame:
    return mf.where(F.col(LABEL).isNotNull())


def train_rows(mf: DataFrame) -> DataFrame:
    return labeled(mf).where(F.col("split") == sp.TRAIN)


# -- model frame ---------------------------------------------------------------------


@register("join_fact_indicator", sql.JOIN_FACT_INDICATOR)
def q_join_fact_indicator(spark, sf_dir):
    g = gold(spark, sf_dir)
    return fe.join_indicators(g, ind.indicators_for(g, ind.AREA))


@register("group_smoothed_rate", sql.GROUP_SMOOTHED_RATE)
def q_group_smoothed_rate(spark, sf_dir):
    g = gold(spark, sf_dir).select("entity_id", "group_id", LABEL)
    return fe.group_rate(g, "group_id", LABEL).drop(LABEL)


@register("group_rate_exclude_self", sql.GROUP_RATE_EXCLUDE_SELF)
def q_group_rate_exclude_self(spark, sf_dir):
    g = gold(spark, sf_dir).select("entity_id", "group_id", LABEL)
    return fe.group_rate(g, "group_id", LABEL, exclude_self=True).drop(LABEL)


DERIVED_NEW = ("income_vulnerability_ratio", "log_income", "social_pressure", "index_change")


@register("derived_features", f"""
SELECT c_custkey, c_acctbal AS income_current,
       CAST(c_nationkey AS DOUBLE) AS vulnerability_current,
       CAST(n_regionkey AS DOUBLE) / 4 AS index_current,
       CAST(n_regionkey AS DOUBLE) / 5 AS index_previous,
       {sql.rf('c_acctbal / (CAST(c_nationkey AS DOUBLE) + 1.0)')} AS income_vulnerability_ratio,
       {sql.rf('CASE WHEN c_acctbal IS NULL THEN NULL ELSE ln(1 + greatest(0.0, c_acctbal)) END')} AS log_income,
       {sql.rf('CAST(c_nationkey AS DOUBLE) / (CAST(n_regionkey AS DOUBLE) / 4 + 0.0001)')} AS social_pressure,
       {sql.rf('CAST(n_regionkey AS DOUBLE) / 4 - CAST(n_regionkey AS DOUBLE) / 5')} AS index_change
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def q_derived_features(spark, sf_dir):
    """Customer data standing in for area socio-economic inputs; the two
    rate inputs are absent, so their change feature is (correctly) not added."""
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    src = c.join(sized_broadcast(n), c.c_nationkey == n.n_nationkey).select(
        "c_custkey", F.col("c_acctbal").alias("income_current"),
        F.col("c_nationkey").cast("double").alias("vulnerability_current"),
        (F.col("n_regionkey").cast("double") / F.lit(4.0)).alias("index_current"),
        (F.col("n_regionkey").cast("double") / F.lit(5.0)).alias("index_previous"))
    out = fe.derived_features(src)
    return out.withColumns({c: round_fine(c) for c in DERIVED_NEW})


@register("select_features", sql.SELECT_FEATURES)
def q_select_features(spark, sf_dir):
    return fe.select_features(model_base(spark, sf_dir), LABEL, keep=("entity_id",))


@register("class_balance", sql.CLASS_BALANCE)
def q_class_balance(spark, sf_dir):
    y = F.col(LABEL)
    n_neg, n_pos = F.count(F.when(y == 0, 1)), F.count(F.when(y == 1, 1))
    return published(spark, sf_dir).agg(
        n_neg.alias("n_neg"), n_pos.alias("n_pos"),
        (n_neg.cast("double") / F.greatest(F.lit(1), n_pos)).alias("imbalance_ratio"))


# -- sampling and splitting ------------------------------------------------------------

# query parameter (the library default is fixed.SAMPLE_TARGET_ROWS, which would not
# sample a table this small): exercises the sampling path on the driver tables
SAMPLE_TARGET_ROWS = 5000


@register("sample_stratified_hash", sql.sample_sql(SAMPLE_TARGET_ROWS))
def q_sample_stratified_hash(spark, sf_dir):
    mf = published(spark, sf_dir)
    return sp.sample_to_target(mf, LABEL, [0, 1], "entity_id", SAMPLE_TARGET_ROWS).select(
        "entity_id", LABEL)


@register("sample_stratified_bernoulli")
def q_sample_stratified_bernoulli(spark, sf_dir):
    """Spark's sampleBy (not reproducible across partitionings: rows-only)."""
    return sp.sample_bernoulli(published(spark, sf_dir), LABEL, {0: 0.33, 1: 0.33}).select(
        "entity_id", LABEL)


@register("sample_bernoulli_check", sql.with_gold() + """
SELECT outcome, COUNT(*) AS n_class, TRUE AS within FROM gold WHERE outcome IN (0, 1) GROUP BY outcome""")
def q_sample_bernoulli_check(spark, sf_dir):
    """Kept rows of each class lie within five standard deviations of the expected."""
    rows = published(spark, sf_dir).select("entity_id", LABEL)
    kept = sp.sample_bernoulli(rows, LABEL, {0: 0.33, 1: 0.33}).groupBy(LABEL).agg(F.count("*").alias("k"))
    n = F.col("n_class")
    return (rows.groupBy(LABEL).agg(F.count("*").alias("n_class")).join(kept, LABEL)
            .select(LABEL, "n_class", (F.abs(F.col("k") - n * 0.33) <= 5 * F.sqrt(n * 0.33 * 0.67)).alias("within")))


@register("split_hash", sql.SPLIT_HASH)
def q_split_hash(spark, sf_dir):
    return sp.split_hash(labeled(published(spark, sf_dir)), "entity_id").select("entity_id", LABEL, "split")


@register("split_exact", sql.SPLIT_EXACT)
def q_split_exact(spark, sf_dir):
    lab = labeled(published(spark, sf_dir)).select("entity_id", LABEL)
    return sp.split_exact(lab, LABEL, "entity_id")


# -- preprocessing statistics -------------------------------------------------------------


def imputed_numeric(mf: DataFrame) -> DataFrame:
    meds = prep.exact_medians(train_rows(mf), NUMERIC)
    return prep.impute(labeled(mf).select("entity_id", "split", *NUMERIC), meds)


@register("impute_median", sql.IMPUTE_MEDIAN)
def q_impute_median(spark, sf_dir):
    out = imputed_numeric(model_frame(spark, sf_dir))
    return out.select("entity_id", *[round_fine(c).alias(c) for c in NUMERIC])


@register("standardize", sql.STANDARDIZE)
def q_standardize(spark, sf_dir):
    imp = imputed_numeric(model_frame(spark, sf_dir))
    stats = prep.mean_std(imp.where(F.col("split") == sp.TRAIN), NUMERIC)
    z = prep.standardize(imp, stats)
    return z.select("entity_id", *[round_fine(c).alias(c) for c in NUMERIC])


def imputed_categorical(mf: DataFrame) -> DataFrame:
    modes = {r["feature"]: r["category"]
             for r in prep.most_frequent(train_rows(mf), CATEGORICAL).collect()}
    return prep.impute_modes(labeled(mf).select("entity_id", LABEL, "split", "fold",
                                                *CATEGORICAL), modes)


@register("impute_mode", sql.IMPUTE_MODE)
def q_impute_mode(spark, sf_dir):
    return imputed_categorical(model_frame(spark, sf_dir)).select("entity_id", *CATEGORICAL)


@register("target_encode", sql.TARGET_ENCODE)
def q_target_encode(spark, sf_dir):
    cats = imputed_categorical(model_frame(spark, sf_dir))
    enc = prep.target_encoding(cats.where(F.col("split") == sp.TRAIN), CATEGORICAL, LABEL)
    return enc.withColumn("encoding", round_fine("encoding"))


@register("target_encode_oof", sql.TARGET_ENCODE_OOF)
def q_target_encode_oof(spark, sf_dir):
    cats = imputed_categorical(model_frame(spark, sf_dir))
    enc = prep.target_encoding_oof(cats.where(F.col("split") == sp.TRAIN), CATEGORICAL, LABEL,
                                   "fold")
    return enc.withColumn("encoding", round_fine("encoding"))


@register("class_weights", sql.CLASS_WEIGHTS)
def q_class_weights(spark, sf_dir):
    cw = class_weights(train_rows(sp.split_hash(published(spark, sf_dir), "entity_id")), LABEL)
    return cw.withColumns({c: round_fine(c) for c in ("weight_0", "weight_1", "scale_pos_weight")})


# -- evaluation of a score ---------------------------------------------------------------

METRICS = ("accuracy", "f1", "f1_macro", "recall_class0", "roc_auc")


def fine(df: DataFrame, columns) -> DataFrame:
    """The columns without last-ulp noise: for the registered results alone,
    decisions are made on the raw values."""
    return df.withColumns({c: round_fine(c) for c in columns})



def eval_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-level scores with a known outcome: price, inverse price and the
    customer's smoothed outcome rate."""
    o = read_table(spark, sf_dir, "orders")
    y = (F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0))
    base = o.select(F.col("o_orderkey").alias("entity_id"), "o_custkey", y.alias(LABEL),
                    "o_totalprice")
    rated = fe.group_rate(base, "o_custkey", LABEL, rate_col="cust_rate", volume_col="cust_n")
    price = F.col("o_totalprice") / F.lit(500000)
    scored = rated.select(
        "entity_id", LABEL,
        price.alias("score_price"), (F.lit(1) - price).alias("score_inverse"),
        F.col("cust_rate").alias("score_group"))
    return sp.split_hash(scored, "entity_id").where(F.col(LABEL).isNotNull())


def validation(spark, sf_dir):
    return eval_frame(spark, sf_dir).where(F.col("split") == sp.VALIDATION)


def test_rows(spark, sf_dir):
    return eval_frame(spark, sf_dir).where(F.col("split") == sp.TEST)


@register("binary_metrics", sql.BINARY_METRICS)
def q_binary_metrics(spark, sf_dir):
    return fine(ev.binary_metrics(validation(spark, sf_dir), LABEL, "score_price"), METRICS)


def score_long(df: DataFrame) -> DataFrame:
    """One row per (model, row): the three scores as competing models."""
    items = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(o).alias("model_order"),
                               F.col(LABEL).alias(LABEL), F.col(s).alias("score"))
                      for m, s, o in sql.MODELS])
    return df.select(F.explode(items).alias("m")).select("m.*")


def metrics_table(spark, sf_dir):
    long = score_long(validation(spark, sf_dir))
    m = ev.binary_metrics(long, LABEL, "score", group=["model"])
    order = spark.createDataFrame([(m_, o) for m_, _, o in sql.MODELS], "model string, model_order int")
    return m.join(order, "model")


@register("metrics_table", sql.METRICS_TABLE_SELECT)
def q_metrics_table(spark, sf_dir):
    return fine(metrics_table(spark, sf_dir), METRICS)


@register("champion_model", sql.CHAMPION)
def q_champion_model(spark, sf_dir):
    return fine(ev.champion(metrics_table(spark, sf_dir)), METRICS)


@register("roc_auc", sql.ROC_AUC)
def q_roc_auc(spark, sf_dir):
    return fine(ev.roc_auc(validation(spark, sf_dir), LABEL, "score_price"), ["roc_auc"])


@register("roc_curve_points", sql.ROC_CURVE)
def q_roc_curve_points(spark, sf_dir):
    return fine(ev.roc_curve_points(validation(spark, sf_dir), LABEL, "score_price"), ["fpr", "tpr"])


@register("roc_curve", sql.ROC_BENDS)
def q_roc_curve(spark, sf_dir):
    return fine(ev.roc_curve(validation(spark, sf_dir), LABEL, "score_price"), ["fpr", "tpr"])


@register("threshold_sweep", sql.THRESHOLD_SWEEP)
def q_threshold_sweep(spark, sf_dir):
    return fine(ev.threshold_sweep(validation(spark, sf_dir), LABEL, "score_price"), ["f1_class0"])


@register("best_threshold", sql.BEST_THRESHOLD)
def q_best_threshold(spark, sf_dir):
    best = ev.best_threshold(ev.threshold_sweep(validation(spark, sf_dir), LABEL, "score_price"))
    return fine(best, ["f1_class0"])


def tuned_threshold(spark, sf_dir) -> float:
    return ev.best_threshold_value(ev.threshold_sweep(validation(spark, sf_dir), LABEL,
                                                      "score_price"))


@register("confusion_matrix", sql.CONFUSION)
def q_confusion_matrix(spark, sf_dir):
    return ev.confusion_matrix(test_rows(spark, sf_dir), LABEL, "score_price",
                               tuned_threshold(spark, sf_dir))


@register("classification_report", sql.REPORT)
def q_classification_report(spark, sf_dir):
    report = ev.classification_report(test_rows(spark, sf_dir), LABEL, "score_price",
                                      tuned_threshold(spark, sf_dir))
    return fine(report, ["precision", "recall", "f1"])


@register("score_risk_tier", sql.RISK_TIER)
def q_score_risk_tier(spark, sf_dir):
    t = test_rows(spark, sf_dir).withColumn("score_pct", round_half_up(F.col("score_price") * 100, 2))
    return t.select("entity_id", LABEL, "score_price", "score_pct",
                    risk_tier("score_pct").alias("risk_tier"))


@register("attribution_linear", sql.ATTRIBUTION_LINEAR)
def q_attribution_linear(spark, sf_dir):
    """Exact attributions of a linear score w.x: phi_j = w_j (x_j - mean_j),
    means over the training rows; summary per feature."""
    from lamina.model.explain import linear_attribution

    frame = eval_frame(spark, sf_dir)
    return linear_attribution(frame.where(F.col("split") == sp.TEST),
                              frame.where(F.col("split") == sp.TRAIN), sql.ATTRIBUTION_WEIGHTS)


__all__ = ["model_frame", "model_base", "eval_frame"]
