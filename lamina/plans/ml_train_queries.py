"""Training-stage queries (rows-only checks: fitted models are not SQL).

Fitted models are kept per (session, data set) so that the chain
benchmark -> tuning -> threshold -> scoring -> save/load -> attribution fits
each model once per session, as the reference's single run does.
"""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina import fixed
from lamina.functions.exprs import risk_tier, round_fine, round_half_up
from lamina.model import evaluate as ev
from lamina.model import split as sp
from lamina.model import workflow as wf
from lamina.model.boosting import SecondOrderTrees
from lamina.model.explain import sampled_shapley, tree_summary
from lamina.model.train import REFERENCE_CANDIDATES
from lamina.model.tree_attribution import expected, tree_attribution
from lamina.operators.profile import require_non_empty
from lamina.plans import ml_queries as mq
from lamina.plans import oracle_ml
from lamina.plans.oracle import rf
from lamina.plans.joins import materialize
from lamina.plans.registry import register
from lamina.session import work_path
from lamina.sources import sinks
from lamina.sources.tables import input_files, read_table

EXPLAIN_SALT = "|explain42"
GRADIENT_LEFT = 0.01     # of the steepest slope at zero coefficients
ATTRIBUTION_ORDERS = 8   # sampled feature orders a row

_CACHE: dict = {}


def _cached(spark: SparkSession, sf_dir: str, name: str, build):
    key = (spark.sparkContext.applicationId, input_files(spark, sf_dir), name)
    if key not in _CACHE:
        _CACHE[key] = build()
    return _CACHE[key]


def model_frame(spark, sf_dir) -> DataFrame:
    return _cached(spark, sf_dir, "mf",
                   lambda: materialize(mq.model_frame(spark, sf_dir), "model-frame"))


def model_data(spark, sf_dir) -> wf.ModelData:
    return _cached(spark, sf_dir, "data", lambda: wf.prepare(
        require_non_empty(model_frame(spark, sf_dir), "model frame"), mq.NUMERIC, mq.CATEGORICAL, mq.LABEL, "entity_id"))


def matrix(spark, sf_dir) -> wf.Matrix:
    return _cached(spark, sf_dir, "matrix", lambda: wf.training_matrix(model_data(spark, sf_dir)))


def fitted(spark, sf_dir, name: str) -> PipelineModel:
    cand = next(c for c in REFERENCE_CANDIDATES if c.name == name)
    return _cached(spark, sf_dir, f"fit:{name}", lambda: wf.fit_candidate(
        model_data(spark, sf_dir), cand, matrix(spark, sf_dir)))


def validation_metrics(spark, sf_dir, name: str) -> DataFrame:
    def build():
        rows = wf.evaluate(fitted(spark, sf_dir, name), model_data(spark, sf_dir).validation,
                           name).collect()
        return spark.createDataFrame(rows)
    return _cached(spark, sf_dir, f"metrics:{name}", build)


def benchmark(spark, sf_dir) -> tuple[DataFrame, str]:
    def build():
        parts = [validation_metrics(spark, sf_dir, c.name).withColumn("model_order", F.lit(i))
                 for i, c in enumerate(REFERENCE_CANDIDATES)]
        table = parts[0]
        for p in parts[1:]:
            table = table.unionByName(p)
        return table, ev.champion(table).first()["model"]
    return _cached(spark, sf_dir, "benchmark", build)


def tuned(spark, sf_dir):
    def build():
        _, best = benchmark(spark, sf_dir)
        cand = next(c for c in REFERENCE_CANDIDATES if c.name == best)
        res, model, params = wf.random_search(model_data(spark, sf_dir), cand,
                                              matrix=matrix(spark, sf_dir))
        return res.withColumn("model", F.lit(best)), model, params
    return _cached(spark, sf_dir, "tuned", build)


def tuned_threshold(spark, sf_dir) -> float:
    def build():
        _, model, _ = tuned(spark, sf_dir)
        s = wf.score(model, model_data(spark, sf_dir).validation).select(wf.LABEL, wf.SCORE)
        return ev.best_threshold_value(ev.threshold_sweep(s, wf.LABEL, wf.SCORE))
    return _cached(spark, sf_dir, "threshold", build)


@register("train_logistic")
def q_train_logistic(spark, sf_dir):
    return validation_metrics(spark, sf_dir, "logreg")


@register("train_forest")
def q_train_forest(spark, sf_dir):
    return validation_metrics(spark, sf_dir, "rf")


@register("train_boosted")
def q_train_boosted(spark, sf_dir):
    return validation_metrics(spark, sf_dir, "gbt")


@register("model_benchmark")
def q_model_benchmark(spark, sf_dir):
    table, best = benchmark(spark, sf_dir)
    return table.withColumn("champion", F.col("model") == F.lit(best))


@register("tune_random_search")
def q_tune_random_search(spark, sf_dir):
    res, _, params = tuned(spark, sf_dir)
    return res.withColumn("chosen", F.col("params") == F.lit(json.dumps(params, sort_keys=True)))


def scored_test(spark, sf_dir) -> DataFrame:
    """Test rows with their original columns, scored by the tuned champion with the
    tuned threshold; the score in percent and its tier."""
    _, model, _ = tuned(spark, sf_dir)
    t = tuned_threshold(spark, sf_dir)
    rows = wf.score_rows(model, model_data(spark, sf_dir).test_rows.drop("fold"))
    return rows.withColumns({
        "actual": F.col(wf.LABEL).cast("int"),
        "predicted": F.when(F.col(wf.SCORE) >= F.lit(t), 1).otherwise(0),
        "score_pct": round_half_up(F.col(wf.SCORE) * 100, 2),
    }).withColumn("risk_tier", risk_tier("score_pct")).drop(wf.LABEL, "split")


@register("score_batch")
def q_score_batch(spark, sf_dir):
    """The scored rows, published as a table and as CSV (errors propagate)."""
    path = work_path(spark, "scored")
    sinks.write_table(scored_test(spark, sf_dir).drop(wf.SCORE), path)
    scored = sinks.read_back(spark, path)
    sinks.export_csv(scored, work_path(spark, "scored-csv"))
    return scored


TEST_IDS = oracle_ml.with_mf() + "\nSELECT entity_id, outcome AS actual, {} FROM labeled WHERE split = 'test'"


@register("score_batch_check", TEST_IDS.format("TRUE AS consistent"))
def q_score_batch_check(spark, sf_dir):
    """Every test row is scored once, with its own outcome; score, prediction and
    tier agree."""
    t = tuned_threshold(spark, sf_dir)
    pct, p = F.col("score_pct"), F.col(wf.SCORE)
    tier = (F.when(pct < fixed.RISK_HIGH_BELOW, "High").when(pct < fixed.RISK_LOW_FROM, "Medium").otherwise("Low"))
    consistent = (p.between(0, 1) & (F.abs(pct - p * 100) <= 0.005 + 1e-9) & (F.col("risk_tier") == tier)
                  & (F.col("predicted") == (p >= t).cast("int")) & (F.col("actual") == F.col("outcome")))
    return scored_test(spark, sf_dir).select("entity_id", "actual", consistent.alias("consistent"))


@register("metrics_published", """
SELECT * FROM (VALUES ('logreg', 0, TRUE), ('rf', 1, TRUE), ('gbt', 2, TRUE)) t(model, model_order, plausible)""")
def q_metrics_published(spark, sf_dir):
    """The benchmark's metrics table, exported as CSV and read back: one row per
    candidate, each better than chance."""
    table, _ = benchmark(spark, sf_dir)
    path = work_path(spark, "metrics-csv")
    sinks.export_csv(table, path, single_file=True)
    back = sinks.read_back(spark, path, fmt="csv", schema=table.schema, options={"header": "true"})
    ok = F.col("accuracy").between(0, 1) & F.col("f1").between(0, 1) & (F.col("roc_auc") > 0.5)
    return back.select("model", "model_order", ok.alias("plausible"))


@register("model_roundtrip")
def q_model_roundtrip(spark, sf_dir):
    """Save the tuned pipeline, load it back, score the test rows with both."""
    _, model, _ = tuned(spark, sf_dir)
    path = work_path(spark, "model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    test = model_data(spark, sf_dir).test
    a = wf.score(model, test).select("entity_id", F.col(wf.SCORE).alias("p_saved"))
    b = wf.score(loaded, test).select("entity_id", F.col(wf.SCORE).alias("p_loaded"))
    return a.join(b, "entity_id").withColumn(
        "equal", F.abs(F.col("p_saved") - F.col("p_loaded")) <= F.lit(1e-12))


@register("model_roundtrip_check", TEST_IDS.format("TRUE AS equal"))
def q_model_roundtrip_check(spark, sf_dir):
    """Every test row scores the same after saving and loading the model."""
    ids = model_data(spark, sf_dir).test.select("entity_id", F.col(wf.LABEL).cast("int").alias("actual"))
    return ids.join(q_model_roundtrip(spark, sf_dir).select("entity_id", "equal"), "entity_id")


def explain_rows(spark, sf_dir, rows: int | None = None) -> DataFrame:
    """All test rows; with ``rows``, about that many, chosen by a salted hash of the id."""
    test = model_data(spark, sf_dir).test
    if rows is None:
        return test
    n = test.count()
    frac = min(1.0, rows / n) if n else 1.0
    return test.where(sp.hash_u32("entity_id", EXPLAIN_SALT) < F.lit(frac * sp.TWO_32))


def background_point(spark, sf_dir) -> dict:
    """Reference point of the attributions: training means of the numeric
    features and training modes of the categorical ones."""
    from lamina.model import prep

    train = model_data(spark, sf_dir).train
    means = train.agg(*[F.avg(c).alias(c) for c in mq.NUMERIC]).first().asDict()
    modes = {r["feature"]: r["category"]
             for r in prep.most_frequent(train, mq.CATEGORICAL).collect()}
    return {**means, **modes}


@register("attribution_sampled")
def q_attribution_sampled(spark, sf_dir):
    _, model, _ = tuned(spark, sf_dir)
    rows = explain_rows(spark, sf_dir)
    out = sampled_shapley(model, rows, background_point(spark, sf_dir),
                          mq.NUMERIC, mq.CATEGORICAL, "entity_id", n_perm=ATTRIBUTION_ORDERS)
    return out.withColumn("mean_abs", round_fine("mean_abs"))


@register("attribution_check", TEST_IDS.format("TRUE AS additive"))
def q_attribution_check(spark, sf_dir):
    """Of every test row: the attributions add up to its score less the background's."""
    _, model, _ = tuned(spark, sf_dir)
    rows, point = explain_rows(spark, sf_dir), background_point(spark, sf_dir)
    parts = sampled_shapley(model, rows, point, mq.NUMERIC, mq.CATEGORICAL, "entity_id", n_perm=1, keep_rows=True)
    base = wf.score(model, spark.createDataFrame([point]).select(*mq.NUMERIC, *mq.CATEGORICAL)).first()[wf.SCORE]
    total = parts.groupBy("entity_id").agg(F.sum("v").alias("phi"))
    scored = wf.score(model, rows).select("entity_id", F.col(wf.LABEL).cast("int").alias("actual"), wf.SCORE)
    return scored.join(total, "entity_id").select(
        "entity_id", "actual", (F.abs(F.col("phi") - (F.col(wf.SCORE) - F.lit(base))) < 1e-9).alias("additive"))


@register("train_check", oracle_ml.with_mf() + """
SELECT m.model, COUNT(*) AS n, COUNT(CASE WHEN l.outcome = 1 THEN 1 END) AS n_pos
FROM labeled l CROSS JOIN (VALUES ('logreg'), ('rf'), ('gbt')) m(model)
WHERE l.split = 'validation' GROUP BY m.model""")
def q_train_check(spark, sf_dir):
    """Confusion cells of each candidate on validation add up to the rows and positives."""
    valid = model_data(spark, sf_dir).validation
    parts = [ev.confusion_cells(wf.score(fitted(spark, sf_dir, c.name), valid), wf.LABEL, wf.SCORE, strict=True)
             .select(F.lit(c.name).alias("model"), (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n"),
                     (F.col("tp") + F.col("fn")).alias("n_pos")) for c in REFERENCE_CANDIDATES]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("forest_check", oracle_ml.with_mf() + f"""
SELECT CAST(t.tree AS INTEGER) AS tree, CAST(FLOOR(COUNT(*) * {fixed.FOREST_PARAMS['share']} + 0.5) AS BIGINT) AS draws,
       TRUE AS consistent
FROM labeled l CROSS JOIN range({fixed.FOREST_PARAMS['trees']}) t(tree) WHERE l.split = 'train' GROUP BY t.tree""")
def q_forest_check(spark, sf_dir):
    """Each tree draws its share of the training rows exactly; a node's draws are its
    children's together, every split lowers the impurity and no node is deeper than allowed."""
    model = fitted(spark, sf_dir, "rf").stages[-1]
    nodes = model.nodes(spark)
    child = nodes.select("tree", F.col("node").alias("child"), F.col("cover").alias("below"))
    sums = (nodes.where("feature >= 0").select("tree", "node", F.explode(F.array("left", "right")).alias("child"))
            .join(child, ["tree", "child"]).groupBy("tree", "node").agg(F.sum("below").alias("below")))
    # a leaf holds its share of class 1 over the number of trees
    ok = F.when(F.col("feature") >= 0, (F.col("below") == F.col("cover")) & (F.col("gain") > 0) & (F.col("cover") >= 2)) \
        .otherwise(F.col("cover").isNotNull() & F.col("value").between(0, 1.0 / fixed.FOREST_PARAMS["trees"] + 1e-12))
    return (nodes.join(sums, ["tree", "node"], "left").groupBy("tree")
            .agg(F.max(F.when(F.col("node") == 0, F.col("cover"))).cast("long").alias("draws"),
                 F.every(F.coalesce(ok, F.lit(False))).alias("consistent")))


@register("logistic_check", f"""
SELECT unnest({[*mq.NUMERIC, *mq.CATEGORICAL, '(intercept)']!r}) AS feature, TRUE AS stationary""")
def q_logistic_check(spark, sf_dir):
    """Of each coefficient: the gradient of the weighted, penalised loss at the fitted point,
    from sums over the training matrix, is nearly zero against the one at zero coefficients."""
    m, fit = matrix(spark, sf_dir), fitted(spark, sf_dir, "logreg").stages[-1]
    names = [*mq.NUMERIC, *mq.CATEGORICAL]
    coef, n = [float(c) for c in fit.coefficients], m.n
    weight = F.when(F.col(wf.LABEL) == 1, n / (2.0 * max(1, m.n_pos))).otherwise(n / (2.0 * max(1, m.n_neg)))
    rows = m.rows.select(vector_to_array(wf.FEATURES).alias("x"), F.col(wf.LABEL).alias("y"), weight.alias("w"))
    x = [F.col("x")[i] for i in range(len(names))] + [F.lit(1.0)]
    z = sum((x[i] * F.lit(c) for i, c in enumerate(coef)), F.lit(float(fit.intercept)))
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    sums = rows.select("w", "y", p.alias("p"), F.array(*x).alias("x")).agg(
        F.sum("w").alias("w"),
        *[F.sum(F.col("w") * (F.col("p") - F.col("y")) * F.col("x")[i]).alias(f"g{i}") for i in range(len(x))],
        *[F.sum(F.col("w") * (F.lit(0.5) - F.col("y")) * F.col("x")[i]).alias(f"s{i}") for i in range(len(x))])
    reg = 1.0 / (fixed.LOGISTIC_PARAMS["C"] * n)
    start = F.greatest(*[F.abs(F.col(f"s{i}") / F.col("w")) for i in range(len(x))])
    parts = [F.struct(F.lit(name).alias("feature"), (
        F.abs(F.col(f"g{i}") / F.col("w") + F.lit(reg * coef[i] if i < len(coef) else 0.0)) <= GRADIENT_LEFT * start)
        .alias("stationary")) for i, name in enumerate([*names, "(intercept)"])]
    return sums.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


# -- boosted trees ---------------------------------------------------------------------

FIRST_TREE_FEATURES = ("l_quantity", "l_discount", "l_tax")


def _best_split(rows: str) -> str:
    """Of each side of ``rows`` (side, f, v, g, h), the border of the highest gain."""
    return f"""
  SELECT side, f, cut, gain, -gl / (hl + 1) AS value_left, -(g - gl) / (h - hl + 1) AS value_right FROM (
    SELECT *, (gl*gl/(hl+1) + (g-gl)*(g-gl)/(h-hl+1) - g*g/(h+1)) / 2 AS gain FROM (
      SELECT side, f, v AS cut, SUM(g) OVER below AS gl, SUM(h) OVER below AS hl,
             SUM(g) OVER every AS g, SUM(h) OVER every AS h
      FROM (SELECT side, f, v, SUM(g) AS g, SUM(h) AS h FROM {rows} GROUP BY side, f, v)
      WINDOW below AS (PARTITION BY side, f ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
             every AS (PARTITION BY side, f))
    WHERE hl >= 1 AND h - hl >= 1)
  QUALIFY ROW_NUMBER() OVER (PARTITION BY side ORDER BY gain DESC, f, cut) = 1"""


@register("boosted_first_tree", f"""
WITH base AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN -0.5::DOUBLE ELSE 0.5::DOUBLE END AS g, 0.25::DOUBLE AS h,
         [{', '.join(f'CAST({c} AS DOUBLE)' for c in FIRST_TREE_FEATURES)}] AS x
  FROM lineitem
),
long0 AS (SELECT '' AS side, g, h, unnest(range(3)) AS f, unnest(x) AS v FROM base),
root AS ({_best_split('long0')}),
long1 AS (SELECT CASE WHEN x[CAST(r.f AS INT) + 1] < r.cut THEN 'L' ELSE 'R' END AS side, b.g, b.h,
                 unnest(range(3)) AS f, unnest(x) AS v FROM base b CROSS JOIN root r),
splits AS (SELECT * FROM root UNION ALL {_best_split('long1')})
SELECT side, CAST(f AS INTEGER) AS feature, cut AS threshold, {rf('gain')} AS gain,
       CASE WHEN side <> '' THEN {rf('value_left')} END AS value_left,
       CASE WHEN side <> '' THEN {rf('value_right')} END AS value_right
FROM splits""")
def q_boosted_first_tree(spark, sf_dir):
    """The first tree, two levels deep, on three columns of ``lineitem``: each split with
    its gain, and the leaves' values."""
    from pyspark.ml.functions import array_to_vector

    rows = read_table(spark, sf_dir, "lineitem").select(
        F.xxhash64("l_orderkey", "l_linenumber").alias("id"),
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
        array_to_vector(F.array(*[F.col(c).cast("double") for c in FIRST_TREE_FEATURES])).alias("features"))
    model = SecondOrderTrees(boost=json.dumps({"rounds": 1, "depth": 2, "step": 1.0}),
                             partitions=wf.training_partitions(rows.count())).fit(rows)
    tree = model.trees[0]
    root = [("", 0)] if tree.feature[0] >= 0 else []
    sides = [(s, int(x[0])) for s, x in (("L", tree.left), ("R", tree.right)) if root and tree.feature[int(x[0])] >= 0]
    out = [(s, int(tree.feature[n]), float(tree.threshold[n]), float(tree.gain[n]),
            *((float(tree.value[tree.left[n]]), float(tree.value[tree.right[n]])) if s else (None, None)))
           for s, n in root + sides]
    frame = spark.createDataFrame(out, "side string, feature int, threshold double, gain double, "
                                       "value_left double, value_right double")
    return frame.withColumns({c: round_fine(c) for c in ("gain", "value_left", "value_right")})


def boosted_matrix(spark, sf_dir):
    """The fitted boosted trees and all test rows as their feature vectors."""
    pipeline = fitted(spark, sf_dir, "gbt")
    rows = explain_rows(spark, sf_dir).drop(wf.OOF_FLAG)
    for stage in pipeline.stages[:-1]:
        rows = stage.transform(rows)
    return pipeline.stages[-1], rows


@register("attribution_trees")
def q_attribution_trees(spark, sf_dir):
    """Exact attributions of the boosted trees over all test rows."""
    model, rows = boosted_matrix(spark, sf_dir)
    return tree_summary(model, rows, [*mq.NUMERIC, *mq.CATEGORICAL], "entity_id")


@register("attribution_trees_check", TEST_IDS.format("TRUE AS additive"))
def q_attribution_trees_check(spark, sf_dir):
    """Of every test row: the attributions add up to its margin less the mean one."""
    model, rows = boosted_matrix(spark, sf_dir)
    parts = tree_attribution(model, rows, [*mq.NUMERIC, *mq.CATEGORICAL], "entity_id")
    total = parts.groupBy("entity_id").agg(F.sum("v").alias("phi"))
    scored = model.transform(rows).select("entity_id", F.col(wf.LABEL).cast("int").alias("actual"), "margin")
    return scored.join(total, "entity_id").select(
        "entity_id", "actual",
        (F.abs(F.col("phi") + F.lit(expected(model.trees, model.base)) - F.col("margin")) < 1e-9).alias("additive"))
