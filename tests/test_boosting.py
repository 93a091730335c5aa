"""Second-order boosted trees and their exact attributions."""

import itertools
import json
import math

import duckdb
import numpy as np
import pytest
from pyspark import RDD
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.model import boosting as bo
from lamina.model import tree_attribution as ta
from lamina.session import work_path

VECTORS = T.StructType([T.StructField("id", T.LongType()), T.StructField("features", VectorUDT()),
                        T.StructField("label", T.DoubleType())])


def frame(spark, rows=600, seed=1, features=3):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 12, (rows, features)).astype(float)
    y = ((x[:, 0] > 5) ^ (x[:, 1] > 3) ^ (rng.random(rows) < 0.1)).astype(float)
    return spark.createDataFrame([(i, Vectors.dense(a.tolist()), float(b)) for i, (a, b) in enumerate(zip(x, y))],
                                 VECTORS), x, y


def fit(df, **params):
    partitions = params.pop("partitions", 2)
    return bo.SecondOrderTrees(boost=json.dumps(params), partitions=partitions).fit(df)


def brute_tree(x, g, h, p, rows=None, depth=0):
    """(feature, threshold, left, right) or a leaf's value, by trying every border."""
    rows = np.arange(len(x)) if rows is None else rows
    gs, hs = g[rows].sum(), h[rows].sum()
    best = (p.min_gain, None)
    if depth < p.depth:
        for f in range(x.shape[1]):
            for cut in np.unique(x[:, f])[1:]:
                left = x[rows, f] < cut
                hl, hr = h[rows][left].sum(), h[rows][~left].sum()
                if min(hl, hr) < p.min_child:
                    continue
                gl = g[rows][left].sum()
                gain = (gl**2 / (hl + p.l2) + (gs - gl)**2 / (hr + p.l2) - gs**2 / (hs + p.l2)) / 2
                if gain > best[0] + 1e-9:
                    best = (gain, (f, cut, rows[left], rows[~left]))
    if best[1] is None:
        return -gs / (hs + p.l2) * p.step
    f, cut, left, right = best[1]
    return f, cut, brute_tree(x, g, h, p, left, depth + 1), brute_tree(x, g, h, p, right, depth + 1)


def brute_predict(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] < tree[1] else tree[3]
    return tree


@pytest.mark.parametrize("scale", [1.0, 2.5])
def test_trees_equal_brute_force(spark, scale):
    df, x, y = frame(spark)
    p = bo.BoostParams(rounds=4, depth=3, step=0.3, scale_pos=scale)
    model = fit(df, rounds=4, depth=3, step=0.3, scale_pos=scale)
    margin = np.zeros(len(x))
    for _ in range(4):
        prob = 1 / (1 + np.exp(-margin))
        w = np.where(y == 1, scale, 1.0)
        tree = brute_tree(x, (prob - y) * w, prob * (1 - prob) * w, p)
        margin += [brute_predict(tree, r) for r in x]
    got = {r.id: r for r in model.transform(df).collect()}
    assert max(abs(got[i].margin - m) for i, m in enumerate(margin)) < 1e-9
    assert max(abs(got[i].probability[1] - 1 / (1 + math.exp(-m))) for i, m in enumerate(margin)) < 1e-12


def test_first_tree_equals_sql(spark):
    """The first tree's root and its two children's splits, by a DuckDB query."""
    df, x, y = frame(spark, seed=3)
    nodes = {(r.tree, r.node): r for r in fit(df, rounds=1, depth=2, step=1.0).nodes(spark).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT unnest($1) AS f0, unnest($2) AS f1, unnest($3) AS f2, unnest($4) AS y",
                [*(x[:, i].tolist() for i in range(3)), y.tolist()])

    def split(where):
        return con.execute(f"""
            WITH s AS (SELECT *, 0.5 - y AS g, 0.25 AS h FROM t WHERE {where}),
            long AS (SELECT g, h, unnest([0, 1, 2]) AS f, unnest([f0, f1, f2]) AS v FROM s),
            per AS (SELECT f, v, sum(g) AS g, sum(h) AS h FROM long GROUP BY f, v),
            run AS (SELECT f, v AS cut, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER p AS g, sum(h) OVER p AS h
                    FROM per WINDOW w AS (PARTITION BY f ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                                    p AS (PARTITION BY f)),
            gain AS (SELECT *, (gl*gl/(hl+1) + (g-gl)*(g-gl)/(h-hl+1) - g*g/(h+1)) / 2 AS gain FROM run
                     WHERE hl >= 1 AND h - hl >= 1)
            SELECT f, cut, gain, -gl/(hl+1), -(g-gl)/(h-hl+1) FROM gain ORDER BY gain DESC, f, cut LIMIT 1""").fetchone()

    f, cut, gain, _, _ = split("true")
    root = nodes[0, 0]
    assert (root.feature, root.threshold) == (f, cut) and abs(root.gain - gain) < 1e-9
    for child, where in ((root.left, f"f{f} < {cut}"), (root.right, f"f{f} >= {cut}")):
        cf, ccut, cgain, left, right = split(where)
        own = nodes[0, child]
        assert (own.feature, own.threshold) == (cf, ccut) and abs(own.gain - cgain) < 1e-9
        assert abs(nodes[0, own.left].value - left) < 1e-9 and abs(nodes[0, own.right].value - right) < 1e-9


def test_samples_of_rows_and_features(spark):
    df, _, _ = frame(spark, features=6)
    a = fit(df, rounds=6, depth=2, subsample=0.6, colsample=0.34).nodes(spark).collect()
    assert a == fit(df, rounds=6, depth=2, subsample=0.6, colsample=0.34).nodes(spark).collect()
    per_tree = {}
    for r in a:
        if r.feature >= 0:
            per_tree.setdefault(r.tree, set()).add(r.feature)
    assert all(len(f) <= 2 for f in per_tree.values()) and len(set().union(*per_tree.values())) > 2
    roots = [r.cover for r in a if r.node == 0]
    assert 0.4 * 150 < roots[0] < 0.8 * 150


def test_many_parts_and_lost_margins(spark, monkeypatch):
    """Sums of many tasks are added by grouped tasks; forgotten margins are computed again."""
    df, _, _ = frame(spark)
    want = fit(df, rounds=3, depth=3).nodes(spark).collect()
    monkeypatch.setattr(bo, "FAN_IN", 2)
    monkeypatch.setattr(bo, "KEPT_BLOCKS", 0)
    got = fit(df, rounds=3, depth=3, partitions=7).nodes(spark).collect()
    assert [(r.tree, r.node, r.feature, r.threshold) for r in got] == [(r.tree, r.node, r.feature, r.threshold) for r in want]


def test_odd_inputs(spark):
    one_class = spark.createDataFrame([(i, Vectors.dense([float(i)]), 1.0) for i in range(20)],
                                      VECTORS)
    model = fit(one_class, rounds=2, depth=2)
    assert model.transform(one_class).filter("margin <= 0").count() == 0
    # NaN counts as the least value
    nan = spark.createDataFrame([(i, Vectors.dense([float("nan") if i % 2 else 1.0 + i % 3, 5.0]), float(i % 2))
                                 for i in range(80)], VECTORS)
    got = {r.features[0] if r.features[0] == r.features[0] else None: r.margin
           for r in fit(nan, rounds=3, depth=2).transform(nan).collect()}
    assert got[None] == got[1.0] > 0 > max(got[2.0], got[3.0])
    with pytest.raises(ValueError):
        fit(nan.limit(0), rounds=1)


def test_save_and_load(spark):
    df, _, _ = frame(spark)
    model = fit(df, rounds=3, depth=3)
    path = work_path(spark, "t-trees")
    model.write().overwrite().save(path)
    loaded = bo.SecondOrderTreesModel.load(path)
    a = [r.margin for r in model.transform(df).orderBy("id").collect()]
    assert a == [r.margin for r in loaded.transform(df).orderBy("id").collect()]


def brute_shapley(trees, row, n_features):
    """By all subsets of the features, walking both branches where one isn't known."""
    def value(known):
        def walk(t, node):
            f = t.feature[node]
            if f < 0:
                return t.value[node]
            if f in known:
                return walk(t, t.right[node] if row[f] >= t.threshold[node] else t.left[node])
            return sum(walk(t, c) * t.cover[c] for c in (t.left[node], t.right[node])) / t.cover[node]
        return sum(walk(t, 0) for t in trees)

    out = np.zeros(n_features)
    for i in range(n_features):
        others = [f for f in range(n_features) if f != i]
        for k in range(n_features):
            for s in itertools.combinations(others, k):
                w = math.factorial(k) * math.factorial(n_features - k - 1) / math.factorial(n_features)
                out[i] += w * (value({*s, i}) - value(set(s)))
    return out, value(set())


@pytest.mark.parametrize("depth,features", [(2, 3), (5, 4), (4, 6)])
def test_attributions_equal_all_subsets(spark, depth, features):
    df, x, _ = frame(spark, seed=depth, features=features)
    model = fit(df, rounds=3, depth=depth, step=0.5)
    all_leaves = [leaf for t in model.trees for leaf in ta.leaves(t)]
    rows = np.vstack([x[:12], np.where(np.arange(features) == 0, np.nan, x[12])])
    got = ta.shapley_values(rows, all_leaves)
    for row, own in zip(rows, got):
        want, base = brute_shapley(model.trees, row, features)
        assert np.abs(own - want).max() < 1e-9
        assert abs(base - ta.expected(model.trees)) < 1e-9


def test_attributions_add_up(spark):
    df, x, _ = frame(spark, rows=300)
    model = fit(df, rounds=8, depth=4)
    long = ta.tree_attribution(model, df, ["a", "b", "c"], "id").groupBy("id").agg(F.sum("v").alias("phi"), F.count("*").alias("n"))
    rows = long.join(model.transform(df), "id").collect()
    assert len(rows) == 300 and all(r.n == 3 for r in rows)
    assert max(abs(r.phi + ta.expected(model.trees) - r.margin) for r in rows) < 1e-9


def test_leaves_are_solved_once_for_all_batches(spark, monkeypatch):
    df, x, _ = frame(spark, seed=7, features=6)
    model = fit(df, rounds=3, depth=5, step=0.5)
    all_leaves = [leaf for t in model.trees for leaf in ta.leaves(t)]
    rows = np.vstack([x, np.where(np.arange(6) == 0, np.nan, x)])
    solved = ta.solve(all_leaves)
    want = ta.shapley_values(rows, all_leaves)
    monkeypatch.setattr(ta, "SOLVED_FEATURES", 1)           # long paths: the patterns that occur
    monkeypatch.setattr(ta, "KEPT_BORDERS", 2)
    assert np.abs(ta.shapley_values(rows, all_leaves) - want).max() < 1e-12
    monkeypatch.setattr(ta, "pattern_values", None)
    assert (ta.shapley_values(rows, [], solved) == want).all()


def test_few_rows_are_dealt_out_to_parts(spark, monkeypatch):
    """One partition of blocks gives several parts, and the same trees, with and without samples."""
    df, _, _ = frame(spark, rows=900)
    monkeypatch.setattr(bo, "BLOCK_ROWS", 100)
    seen, level_sums = [], bo._level_sums
    monkeypatch.setattr(bo, "_level_sums", lambda *a: seen.append(a[-1]) or level_sums(*a))
    for subsample in (1.0, 0.7):
        trees = []
        for most, rows in ((1, 1 << 14), (8, 17)):
            monkeypatch.setattr(bo, "PARTS", most)
            monkeypatch.setattr(bo, "PIECE_ROWS", rows)
            trees.append(fit(df, rounds=3, depth=3, partitions=1, subsample=subsample).nodes(spark).collect())
        assert [(r.tree, r.node, r.feature, r.threshold) for r in trees[0]] == \
            [(r.tree, r.node, r.feature, r.threshold) for r in trees[1]]
    assert set(seen) == {1, 8}


def test_margins_by_passes_equal_single_rows(spark, monkeypatch):
    df, x, _ = frame(spark, seed=9, features=4)
    trees = fit(df, rounds=4, depth=5, step=0.5).trees
    rows = np.vstack([x, [np.nan, 3, np.inf, 1], [-np.inf, np.nan, 5, np.nan]])
    monkeypatch.setattr(bo, "STEP_ROWS", 37)
    got = bo.margins(rows, trees, 0.25, max(map(bo.tree_depth, trees)))
    for row, m in zip(rows, got):
        want = 0.25
        for t in trees:
            node = 0
            while t.feature[node] >= 0:
                node = t.right[node] if row[t.feature[node]] >= t.threshold[node] else t.left[node]
            want += t.value[node]
        assert m == want


def test_levels_plan_no_queries_and_many_parts_add_up_the_same(spark, monkeypatch):
    df, _, _ = frame(spark, seed=5, features=4)
    blocks = bo.pack(df, "features", "label", "id", 3, bo.feature_cuts(
        df, [vector_to_array("features")[i] for i in range(4)], 16))
    cut, parts = bo.pieces(blocks, 4)
    assert isinstance(cut, RDD) and cut.getNumPartitions() == parts
    sums = spark.sparkContext.parallelize(range(11), 11).map(lambda i: (i, np.full(3, float(i)).tobytes()))
    monkeypatch.setattr(bo, "FAN_IN", 2)
    added = bo._add_up(sums, 11)
    assert len(added) <= 2 and sum(np.frombuffer(s) for _, s in added).tolist() == [55.0] * 3


def test_siblings_get_what_their_parents_have_left(spark, monkeypatch):
    """F9-F11: a level counts one child of each split; all sums are as if each were counted."""
    df, _, _ = frame(spark, seed=11, rows=900, features=4)
    p = bo.BoostParams(rounds=4, depth=5, subsample=0.8, colsample=0.7, scale_pos=1.4)
    cuts = bo.feature_cuts(df, [vector_to_array("features")[i] for i in range(4)], p.bins)
    blocks = bo.pack(df, "features", "label", "id", 2, cuts)
    counted, lots = bo._counted, []
    monkeypatch.setattr(bo, "_counted", lambda level, cover: lots.append((len(level), counted(level, cover)))
                        or lots[-1][1])
    trees = bo.fit_trees(blocks, cuts, p)
    assert all(len(own) == max(1, n // 2) for n, own in lots) and max(n for n, _ in lots) >= 4
    monkeypatch.setattr(bo, "_counted", lambda level, cover: level)
    monkeypatch.setattr(bo, "_with_siblings", lambda sums, own, level, parents: sums)
    for a, b in zip(trees, bo.fit_trees(blocks, cuts, p)):
        assert (a.feature == b.feature).all() and (a.threshold == b.threshold).all()
        assert np.allclose(a.value, b.value, atol=1e-12) and np.allclose(a.cover, b.cover, atol=1e-9)
