"""Class weights, candidate models, benchmarking and random search on Spark ML.

Everything trains on the full training split as a distributed Spark ML fit;
nothing is sampled down to fit a single machine.
"""

from __future__ import annotations

import json
import random
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina import fixed
from lamina.model.boosting import SecondOrderTrees
from lamina.model.forest import HistogramForest


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (2 n_c) and the positive-class scale n_neg / max(1, n_pos)."""
    y = F.col(label)
    cnt = df.where(y.isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(y == 0, 1)).alias("n_neg"),
        F.count(F.when(y == 1, 1)).alias("n_pos"))
    n, n0, n1 = (F.col(c).cast("double") for c in ("n", "n_neg", "n_pos"))
    return cnt.withColumns({
        "weight_0": n / (F.lit(2.0) * n0),
        "weight_1": n / (F.lit(2.0) * n1),
        "scale_pos_weight": n0 / F.greatest(F.lit(1.0), n1),
    })


@dataclass
class Candidate:
    name: str
    kind: str       # "logistic" | "forest" | "boosted"
    params: dict


REFERENCE_CANDIDATES = (
    Candidate("logreg", "logistic", dict(fixed.LOGISTIC_PARAMS)),
    Candidate("rf", "forest", dict(fixed.FOREST_PARAMS)),
    Candidate("gbt", "boosted", dict(fixed.BOOSTED_PARAMS)),
)

SEARCH_GRIDS = {"boosted": fixed.BOOSTED_GRID, "forest": fixed.FOREST_GRID,
                "logistic": fixed.LOGISTIC_GRID}


def make_classifier(kind: str, params: dict, features_col: str = "features",
                    label_col: str = "label", weight_col: str | None = "weight",
                    n_train: int | None = None, seed: int = fixed.SEED, scale_pos: float = 1.0,
                    order_col: str = "id", partitions: int = 1, weights: tuple[float, float] = (1.0, 1.0)):
    """Estimator for a candidate. ``C`` (inverse L2 strength) maps to
    regParam = 1 / (C * n) for an unscaled sum-of-losses objective. ``weights`` are the
    forest's for class 0 and 1."""
    from pyspark.ml.classification import LogisticRegression

    p = dict(params)
    common = {"featuresCol": features_col, "labelCol": label_col}
    if kind == "logistic":
        c = p.pop("C", 1.0)
        reg = 1.0 / (c * max(1, n_train or 1))
        est = LogisticRegression(regParam=reg, elasticNetParam=0.0, standardization=False,
                                 family="binomial", **common, **p)
        if weight_col:
            est.setWeightCol(weight_col)
        return est
    if kind == "forest":
        forest = json.dumps({**p, "weight_0": weights[0], "weight_1": weights[1], "seed": seed})
        return HistogramForest(orderCol=order_col, partitions=partitions, forest=forest, **common)
    if kind == "boosted":
        boost = json.dumps({**p, "scale_pos": scale_pos, "seed": seed})
        return SecondOrderTrees(orderCol=order_col, partitions=partitions, boost=boost, **common)
    raise ValueError(f"unknown model kind {kind!r}")


def sample_param_maps(grid: dict, n_iter: int = fixed.SEARCH_DRAWS,
                      seed: int = fixed.SEED) -> list[dict]:
    """``n_iter`` distinct points drawn without replacement from the grid."""
    keys = sorted(grid)
    points = [{}]
    for k in keys:
        points = [{**pt, k: v} for pt in points for v in grid[k]]
    rng = random.Random(seed)
    return rng.sample(points, min(n_iter, len(points)))


def assemble_stage(numeric: Sequence[str], categorical: Sequence[str],
                   features_col: str = "features"):
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=[*numeric, *categorical], outputCol=features_col,
                           handleInvalid="keep")
