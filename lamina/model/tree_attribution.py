"""Exact Shapley values of tree ensembles, path-dependent (Lundberg et al. 2020).

A feature that is unknown sends a row down both branches, weighted by their covers. For
one leaf this is a product over the features on its path: a known feature counts 1
where the row follows the path (else 0), an unknown one the product z of its cover
shares. A feature's Shapley value of that product needs, for each number of other known
features, the sum over their choices: the coefficients of prod_j (z_j + o_j t). They
depend on the row only through the bits o_j: a leaf is solved once for each pattern of
bits, before the rows come, and rows look their pattern up. Comparisons that leaves share
are made once a pass.

Rows come in Arrow batches; the trees are broadcast. Nothing is exploded.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.model.boosting import SecondOrderTreesModel, Tree

#: (row, leaf) cells that one numpy pass handles.
STEP_ROWS = 1 << 14
#: Features on a path whose patterns are all solved beforehand; of longer ones, those that occur.
SOLVED_FEATURES = 8
#: Comparisons of one pass that are kept, a byte a row each.
KEPT_BORDERS = 1 << 10


@dataclass
class Leaf:
    value: float
    features: np.ndarray                       # on the path, each once
    shares: np.ndarray                         # z of each
    splits: list[list[tuple[float, bool]]]     # of each: (threshold, whether the path goes left)


def leaves(tree: Tree) -> list[Leaf]:
    """The paths of a tree, with the nodes' covers as weights."""
    out = []
    todo = [(0, {})]
    while todo:
        node, path = todo.pop()
        f = int(tree.feature[node])
        if f < 0:
            known = sorted(path)
            out.append(Leaf(float(tree.value[node]), np.array(known, np.int64),
                            np.array([path[k][0] for k in known]), [path[k][1] for k in known]))
            continue
        for child, left in ((int(tree.left[node]), True), (int(tree.right[node]), False)):
            z, splits = path.get(f, (1.0, []))
            share = float(tree.cover[child] / tree.cover[node])
            todo.append((child, {**path, f: (z * share, [*splits, (float(tree.threshold[node]), left)])}))
    return out


def expected(trees: list[Tree], base: float = 0.0) -> float:
    """The margin where no feature is known."""
    return base + sum(leaf.value * float(np.prod(leaf.shares)) for t in trees for leaf in leaves(t))


def pattern_values(leaf: Leaf, bits: np.ndarray) -> np.ndarray:
    """Per pattern (a row of 0 / 1) and feature of the path, its Shapley value."""
    d = len(leaf.features)
    weight = np.array([math.factorial(k) * math.factorial(d - 1 - k) / math.factorial(d) for k in range(d)])
    out = np.empty(bits.shape)
    for i in range(d):
        # known others are at most d - 1: coefficients of the product without feature i
        coef = np.zeros((len(bits), d))
        coef[:, 0] = 1.0
        for j in range(d):
            if j != i:
                grown = coef * leaf.shares[j]
                grown[:, 1:] += coef[:, :-1] * bits[:, j:j + 1]
                coef = grown
        out[:, i] = (coef @ weight) * (bits[:, i] - leaf.shares[i]) * leaf.value
    return out


@dataclass
class Solved:
    """A leaf with the interval of each feature that follows its path (from, below), and the
    values of all its patterns, (feature, pattern); None: too many patterns."""

    leaf: Leaf
    intervals: list[tuple[int, float | None, float | None]]
    table: np.ndarray | None


def solve(all_leaves: list[Leaf]) -> list[Solved]:
    out = []
    for leaf in all_leaves:
        d, table = len(leaf.features), None
        if d <= SOLVED_FEATURES:
            bits = ((np.arange(1 << d)[:, None] >> np.arange(d)) & 1).astype(float)
            table = np.ascontiguousarray(pattern_values(leaf, bits).T)
        intervals = [(int(f), max((t for t, left in splits if not left), default=None),
                      min((t for t, left in splits if left), default=None))
                     for f, splits in zip(leaf.features, leaf.splits)]
        out.append(Solved(leaf, intervals, table))
    return out


def shapley_values(x: np.ndarray, all_leaves: list[Leaf], solved: list[Solved] | None = None) -> np.ndarray:
    """Rows x features."""
    out = np.zeros(x.shape)
    solved = solve(all_leaves) if solved is None else solved
    for first in range(0, len(x), STEP_ROWS):
        part = np.ascontiguousarray(x[first:first + STEP_ROWS].T)
        total, known = np.zeros(part.shape), {}

        def reached(f: int, border: float) -> np.ndarray:
            """x >= border, as 0 / 1; NaN goes left."""
            if (f, border) not in known:
                if len(known) >= KEPT_BORDERS:
                    known.clear()
                known[f, border] = (part[f] >= border).view(np.uint8)
            return known[f, border]

        for s in solved:
            d = len(s.intervals)
            if not d:
                continue
            pattern = np.zeros(part.shape[1], np.uint8 if d <= 8 else np.int64)
            for k, (f, start, end) in enumerate(s.intervals):
                bit = 1 if start is None else reached(f, start)
                if end is not None:
                    bit = bit & (reached(f, end) ^ 1)
                pattern |= (bit if pattern.dtype == np.uint8 else bit.astype(np.int64)) << k
            if s.table is not None:
                at = pattern.astype(np.intp)
                for f, values in zip(s.leaf.features, s.table):
                    total[f] += values.take(at)
                continue
            found, at = np.unique(pattern, return_inverse=True)
            bits = ((found[:, None] >> np.arange(d)) & 1).astype(float)
            total[s.leaf.features] += pattern_values(s.leaf, bits)[at].T
        out[first:first + STEP_ROWS] = total.T
    return out


def tree_attribution(model: SecondOrderTreesModel, rows: DataFrame, features: list[str], id_col: str) -> DataFrame:
    """(id, feature, v) of every row: ``features`` names the positions of the vector. The
    values of a row add up to its margin less ``expected``."""
    sc = rows.sparkSession.sparkContext
    shared = sc.broadcast(solve([leaf for t in model.trees for leaf in leaves(t)]))

    @F.pandas_udf("array<double>")
    def values(x):
        m = np.stack(x.to_numpy()) if len(x) else np.zeros((0, 1))
        return pd.Series(list(shapley_values(m, [], shared.value)))

    names = F.array(*[F.lit(f) for f in features])
    # the work by row is large: the rows, which may lie in few files, are dealt out evenly
    dealt = rows.select(F.col(id_col), vector_to_array(F.col(model.getFeaturesCol())).alias("x"))
    dealt = dealt.repartition(2 * sc.defaultParallelism)
    solved = dealt.select(F.col(id_col), values("x").alias("v"))
    return solved.select(id_col, F.explode(F.arrays_zip(names.alias("feature"), F.col("v"))).alias("a")).select(
        id_col, "a.feature", "a.v")
