"""Train, compare, tune and score binary classifiers with Spark ML.

The stages mirror the reference's model step but stay distributed end to end:
the training split is never sampled down or collected; only metrics and
chosen parameters (scalars) reach the driver.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina import fixed
from lamina.model import evaluate as ev
from lamina.model import split as sp
from lamina.model.stages import (CrossFitTargetEncoder, MedianImputer, ModeImputer,
                                 Standardizer)
from lamina.plans.joins import materialize
from lamina.plans.parallel import CONCURRENT_CALLS, run_together
from lamina.model.train import (REFERENCE_CANDIDATES, SEARCH_GRIDS, Candidate, assemble_stage,
                                class_weights, make_classifier, sample_param_maps)
from lamina.session import collect_garbage, work_path

LABEL = "label"
WEIGHT = "weight"
OOF_FLAG = "__oof"
SCORE = "p1"
FEATURES = "features"
CV_SALT = f"|cv{fixed.SEED}"
#: Fits of a search that run at once: a forest's own jobs fill the executors.
CONCURRENT_FITS = {"forest": 2}
ROWS_PER_PARTITION = 1_000_000
MIN_PARTITIONS = 8


def training_partitions(n_rows: int) -> int:
    """A layout that follows the data (about a million rows a partition, never less
    than MIN_PARTITIONS) and is the same on every run: seeded tree models repeat."""
    return max(MIN_PARTITIONS, -(-int(n_rows) // ROWS_PER_PARTITION))


@dataclass
class ModelData:
    train: DataFrame
    validation: DataFrame
    test: DataFrame
    test_rows: DataFrame      # the test split with all its columns
    numeric: list[str]
    categorical: list[str]
    id_col: str
    weights: dict = field(default_factory=dict)


def prepare(mf: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str,
            id_col: str, split_col: str = "split", fold_col: str = "fold") -> ModelData:
    """Labelled rows of a split frame as train / validation / test, with a
    double label, the out-of-fold flag on train rows and class weights."""
    base = (mf.where(F.col(target).isNotNull())
            .withColumn(LABEL, F.col(target).cast("double")))
    keep = [id_col, *numeric, *categorical, LABEL, fold_col, split_col]
    names = [c.lower() for c in mf.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"the model frame repeats columns: {sorted({c for c in names if names.count(c) > 1})}")
    whole, base = base, base.select(*keep)
    train = base.where(F.col(split_col) == sp.TRAIN).withColumn(OOF_FLAG, F.lit(True))
    cw = class_weights(train, LABEL).first()
    weights = {"balanced": (cw["weight_0"], cw["weight_1"]),
               "scale_pos": (1.0, cw["scale_pos_weight"]), "n_train": cw["n"]}
    return ModelData(train, base.where(F.col(split_col) == sp.VALIDATION),
                     base.where(F.col(split_col) == sp.TEST),
                     whole.where(F.col(split_col) == sp.TEST), list(numeric), list(categorical),
                     id_col, weights)


def _weighted(df: DataFrame, w: tuple[float, float]) -> DataFrame:
    return df.withColumn(WEIGHT, F.when(F.col(LABEL) == 1, F.lit(float(w[1])))
                         .otherwise(F.lit(float(w[0]))))


def preprocessing(numeric: Sequence[str], categorical: Sequence[str],
                  fold_col: str = "fold") -> Pipeline:
    """Everything before the classifier, which depends on the rows alone."""
    return Pipeline(stages=[
        MedianImputer(inputCols=list(numeric)), Standardizer(inputCols=list(numeric)),
        ModeImputer(inputCols=list(categorical)),
        CrossFitTargetEncoder(inputCols=list(categorical), labelCol=LABEL,
                              foldCol=fold_col, oofCol=OOF_FLAG),
        assemble_stage(numeric, categorical)])


@dataclass
class Matrix:
    """Fitted preprocessing and the training matrix it gives, written once and
    shared by every classifier fitted on these rows."""

    model: PipelineModel
    rows: DataFrame           # id, features, label
    n_neg: int
    n_pos: int

    @property
    def n(self) -> int:
        return self.n_neg + self.n_pos


def training_matrix(data: ModelData, train: DataFrame | None = None) -> Matrix:
    rows = train if train is not None else data.train
    model = preprocessing(data.numeric, data.categorical).fit(rows)
    matrix = materialize(model.transform(rows).select(data.id_col, FEATURES, LABEL), "train-matrix")
    c = matrix.agg(F.count(F.when(F.col(LABEL) == 0, 1)).alias("n0"),
                   F.count(F.when(F.col(LABEL) == 1, 1)).alias("n1")).first()
    return Matrix(model, matrix, int(c["n0"]), int(c["n1"]))


def fit_classifier(matrix: Matrix, cand: Candidate, scale_pos: float, id_col: str):
    """The classifier alone. Balanced class weights and the regularisation follow the
    rows of this fit; the boosted trees' positive scale is the training split's."""
    w = tuple(matrix.n / (2.0 * max(1, c)) for c in (matrix.n_neg, matrix.n_pos))
    if cand.kind in ("boosted", "forest"):
        return make_classifier(cand.kind, cand.params, label_col=LABEL, scale_pos=scale_pos, order_col=id_col,
                               partitions=-(-matrix.n // ROWS_PER_PARTITION), weights=w).fit(matrix.rows)
    parts = training_partitions(matrix.n)
    rows = _weighted(matrix.rows, w).repartition(parts, id_col).sortWithinPartitions(id_col)
    fit = make_classifier(cand.kind, cand.params, label_col=LABEL, weight_col=WEIGHT,
                          n_train=matrix.n).fit(rows)
    return reloaded(matrix.rows.sparkSession, fit, "logistic")


def reloaded(spark: SparkSession, model, name: str):
    """The model as saved and read back: its coefficients alone. A fitted one also holds
    its training summary and so the session, which tasks can't be sent once the session
    has observed a metric."""
    path = work_path(spark, name)
    model.write().save(path)
    return type(model).load(path)


def fit_candidate(data: ModelData, cand: Candidate, matrix: Matrix | None = None) -> PipelineModel:
    """Preprocessing and classifier as one model; ``matrix`` shares the former."""
    matrix = matrix or training_matrix(data)
    classifier = fit_classifier(matrix, cand, data.weights["scale_pos"][1], data.id_col)
    collect_garbage(matrix.rows.sparkSession)
    return PipelineModel([*matrix.model.stages, classifier])


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Model output as ``p1`` = probability of class 1 (the id and label kept)."""
    out = model.transform(df.drop(OOF_FLAG))
    return out.withColumn(SCORE, vector_to_array(F.col("probability"))[1])


def evaluate(model: PipelineModel, df: DataFrame, name: str) -> DataFrame:
    scored = score(model, df).select(LABEL, SCORE)
    m = ev.binary_metrics(scored, LABEL, SCORE)
    return m.select(F.lit(name).alias("model"), *m.columns)


def score_rows(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` as it is, and ``p1``: the original columns travel through the model's
    stages, nothing is joined back."""
    kept = df.drop(OOF_FLAG).withColumn("__row", F.struct(*[F.col(c) for c in df.columns if c != OOF_FLAG]))
    out = model.transform(kept)
    return out.select("__row.*", vector_to_array(F.col("probability"))[1].alias(SCORE))


def benchmark(data: ModelData, candidates: Sequence[Candidate] = REFERENCE_CANDIDATES):
    """Fit every candidate on one training matrix, evaluate on validation; champion =
    best ROC-AUC, the first listed on ties. Returns (metrics frame, models, champion name)."""
    matrix = training_matrix(data)
    models, rows = {}, []
    for i, cand in enumerate(candidates):
        models[cand.name] = fit_candidate(data, cand, matrix)
        rows.append(evaluate(models[cand.name], data.validation, cand.name)
                    .withColumn("model_order", F.lit(i)))
    metrics = rows[0]
    for r in rows[1:]:
        metrics = metrics.unionByName(r)
    best = ev.champion(metrics).first()["model"]
    return metrics, models, best


def random_search(data: ModelData, cand: Candidate, grid: dict | None = None,
                  n_iter: int = fixed.SEARCH_DRAWS, n_folds: int = fixed.SEARCH_FOLDS,
                  seed: int = fixed.SEED, matrix: Matrix | None = None, concurrent: int = CONCURRENT_CALLS):
    """Randomised search over the candidate's grid: ``n_iter`` draws, each
    scored by mean ROC-AUC over ``n_folds`` hash folds of the training rows
    (fit on the others, evaluated with full-fit encodings), then the best
    draw is refit on all training rows. Preprocessing is fitted once per fold and
    shared by the draws; up to ``concurrent`` fits run at once, with the same results
    as one after another. Returns (results frame, model, params)."""
    grid = grid or SEARCH_GRIDS[cand.kind]
    spark = data.train.sparkSession
    cv_fold = sp.hash_u32(data.id_col, CV_SALT) % n_folds
    train = data.train.withColumn("__cv", cv_fold)
    draws = sample_param_maps(grid, n_iter, seed)
    def fold_matrices(k: int):
        fold = training_matrix(data, train.where(F.col("__cv") != k).drop("__cv"))
        held = fold.model.transform(train.where(F.col("__cv") == k).drop("__cv", OOF_FLAG))
        held = materialize(held.select(data.id_col, FEATURES, LABEL), "held-matrix")
        collect_garbage(spark)
        return fold, held

    def trial(fold: Matrix, held: DataFrame, params: dict) -> float:
        drawn = Candidate(cand.name, cand.kind, {**cand.params, **params})
        model = fit_classifier(fold, drawn, data.weights["scale_pos"][1], data.id_col)
        s = model.transform(held).select(LABEL, vector_to_array(F.col("probability"))[1].alias(SCORE))
        auc = ev.roc_auc(s, LABEL, SCORE).first()["roc_auc"]
        if cand.kind == "forest":
            model.discard()             # a trial's files, which no one reads again
        collect_garbage(spark)
        return auc

    folds = [fold_matrices(k) for k in range(n_folds)]      # their plans, and not their rows, are large
    found = run_together(spark, [partial(trial, *fold, params) for params in draws for fold in folds],
                         min(concurrent, CONCURRENT_FITS.get(cand.kind, concurrent)))
    aucs = [found[d * n_folds:(d + 1) * n_folds] for d in range(len(draws))]
    results = [(d, json.dumps(p, sort_keys=True), float(sum(a) / len(a)))
               for d, (p, a) in enumerate(zip(draws, aucs))]
    res = spark.createDataFrame(results, "draw int, params string, cv_roc_auc double")
    best = max(results, key=lambda r: (r[2], -r[0]))
    best_params = json.loads(best[1])
    final = fit_candidate(data, Candidate(cand.name, cand.kind, {**cand.params, **best_params}), matrix)
    return res, final, best_params
