"""The forest: exact bootstrap share, least node size, splits against brute force."""

import json
import os
import pickle

import numpy as np
import pytest
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import types as T

from lamina.model import boosting as bo
from lamina.model import forest as fo
from lamina.model import tree_attribution as ta
from lamina.session import work_path
from tests.test_boosting import frame


def fit(df, partitions=2, **params):
    return fo.HistogramForest(forest=json.dumps(params), partitions=partitions).fit(df)


def packed(df, p, partitions=3):
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F

    n = df.select(F.size(vector_to_array("features"))).first()[0]
    array = vector_to_array(F.col("features"))
    cuts = bo.feature_cuts(df, [array[i] for i in range(n)], p.bins)
    return bo.pack(df, "features", "label", "id", partitions, cuts), cuts


def test_each_tree_draws_its_share_exactly(spark):
    p = fo.ForestParams(trees=7, share=0.75)
    sizes = np.array([100, 1, 333, 0, 65])
    draws = fo.block_draws(p, sizes)
    assert (draws.sum(axis=1) == round(0.75 * sizes.sum())).all() and (draws[:, 3] == 0).all()
    rows = fo.row_draws(p, 3, (5 << 32) + 2, 333, int(draws[3, 2]))
    assert len(rows) == 333 and rows.sum() == draws[3, 2]
    df, x, _ = frame(spark, rows=601)
    trees = fit(df, trees=5, depth=3).trees
    assert [int(t.cover[0]) for t in trees] == [round(0.75 * 601)] * 5


def brute(x, y, drawn, p, tree, rows, node_ids, node=0, depth=0):
    """The tree by trying every border; nodes are numbered as they are made."""
    w = np.where(y == 1, p.weight_1, p.weight_0)

    def impurity(r):
        c = np.array([(drawn[r] * w[r])[y[r] == k].sum() for k in (0, 1)])
        return c.sum() - (c * c).sum() / c.sum() if c.sum() else 0.0

    best = (1e-9, None)
    if depth < p.depth and drawn[rows].sum() >= p.min_split and len(set(y[rows])) > 1:
        for f in fo.node_features(p, tree, node_ids[rows[0]], x.shape[1]):
            for cut in np.unique(x[:, f])[1:]:
                left = x[rows, f] < cut
                if not left.any() or left.all():
                    continue
                gain = impurity(rows) - impurity(rows[left]) - impurity(rows[~left])
                if gain > best[0] + 1e-9:
                    best = (gain, (f, cut, rows[left], rows[~left]))
    return best


def test_every_split_is_the_best_one(spark):
    df, x, y = frame(spark, rows=400, features=4)
    p = fo.ForestParams(trees=3, depth=5, min_split=12, weight_0=1.5, weight_1=0.75, bins=64)
    blocks, cuts = packed(df, p, partitions=1)
    trees = fo.fit_forest(blocks, cuts, p)
    # rows in the order of the block
    row = blocks.first()
    bins = np.frombuffer(row["bins"], np.uint8).reshape(row["n"], 4)
    label = np.frombuffer(row["labels"], np.uint8)
    value = bins.astype(float)               # twelve values a feature: bins are ranks
    n_splits = 0
    for t, tree in enumerate(trees):
        drawn = fo.row_draws(p, t, row["block"], row["n"], round(0.75 * row["n"]))
        at = {0: np.flatnonzero(drawn)}
        deep = {0: 0}
        for node in range(len(tree.feature)):
            rows = at[node]
            assert tree.cover[node] == drawn[rows].sum()
            ids = np.full(len(label), node)
            gain, found = brute(value, label, drawn, p, t, rows, ids, node, deep[node])
            if tree.feature[node] < 0:
                assert found is None
                w = drawn[rows] * np.where(label[rows] == 1, p.weight_1, p.weight_0)
                assert tree.value[node] * p.trees == pytest.approx(w[label[rows] == 1].sum() / w.sum())
                continue
            n_splits += 1
            assert tree.cover[node] >= p.min_split and tree.gain[node] == pytest.approx(gain)
            goes_left = bins[rows, tree.feature[node]] <= tree.cut_bin[node]
            for side, mine in ((tree.left, goes_left), (tree.right, ~goes_left)):
                at[int(side[node])], deep[int(side[node])] = rows[mine], deep[node] + 1
    assert n_splits > 10


def test_no_node_below_the_least_size_splits(spark):
    df, _, _ = frame(spark, rows=500)
    for least in (2, 40):
        trees = fit(df, trees=6, depth=9, min_split=least).trees
        split = np.concatenate([t.cover[t.feature >= 0] for t in trees])
        assert split.min() >= least and (least == 40 or split.min() < 40)


def test_lots_and_partitions_do_not_change_the_trees(spark, monkeypatch):
    df, _, _ = frame(spark, rows=500)
    p = fo.ForestParams(trees=4, depth=4)
    blocks, cuts = packed(df, p)
    whole = fo.fit_forest(blocks, cuts, p)
    monkeypatch.setattr(fo, "LOT_BYTES", 1)                 # a node a job
    for a, b in zip(whole, fo.fit_forest(blocks.repartition(2), cuts, p)):
        assert (a.feature == b.feature).all() and (a.threshold == b.threshold).all() and (a.value == b.value).all()


def test_subtrees_of_tasks_equal_those_of_levels(spark, monkeypatch):
    df, _, _ = frame(spark, rows=900, features=5)
    p = fo.ForestParams(trees=5, depth=7, min_split=3)
    blocks, cuts = packed(df, p)
    whole = fo.fit_forest(blocks, cuts, p)                  # each tree in one task
    monkeypatch.setattr(fo, "SUBTREE_NODES", 3)             # a few nodes counted at once
    small = fo.fit_forest(blocks, cuts, p)
    monkeypatch.setattr(fo, "SUBTREE_DRAWS", 0)             # every level in jobs
    levels = fo.fit_forest(blocks, cuts, p)
    for a, b, c in zip(whole, small, levels):
        for name in ("feature", "threshold", "left", "right", "value", "cover", "gain"):
            assert (getattr(a, name) == getattr(b, name)).all() and (getattr(a, name) == getattr(c, name)).all()
    monkeypatch.setattr(fo, "SUBTREE_DRAWS", 200)           # levels first, then subtrees
    for a, t in zip(whole, fo.fit_forest(blocks, cuts, p)):
        assert (t.feature[0], t.threshold[0]) == (a.feature[0], a.threshold[0]) and t.cover[0] == 675
        split = np.flatnonzero(t.feature >= 0)
        assert (t.cover[split] == t.cover[t.left[split]] + t.cover[t.right[split]]).all()
        assert (t.gain[split] > 0).all() and (t.cover[split] >= 3).all()
        assert sorted([*t.left[split], *t.right[split]]) == list(range(1, len(t.feature)))
        assert bo.tree_depth(t) <= 7 and abs(len(t.feature) - len(a.feature)) < len(a.feature) // 2


def test_only_few_counts_reach_the_driver(spark, monkeypatch):
    """Small nodes aren't counted level by level, whatever their number."""
    seen = []
    monkeypatch.setattr(fo, "_lot_counts", lambda *a, **k: seen.append(a) or (_ for _ in ()).throw(AssertionError))
    df, _, _ = frame(spark, rows=500)
    assert len(fit(df, trees=6, depth=9).trees) == 6 and not seen


def test_scores_save_and_attributions(spark):
    df, x, y = frame(spark, rows=800)
    model = fit(df, trees=20, depth=6, min_split=5)
    scored = model.transform(df).collect()
    p1 = np.array([r["probability"][1] for r in scored])
    label = np.array([r["label"] for r in scored])
    assert ((p1 >= 0) & (p1 <= 1 + 1e-12)).all() and ((p1 > 0.5) == label).mean() > 0.85
    path = work_path(spark, "forest")
    model.write().overwrite().save(path)
    back = fo.HistogramForestModel.load(path)
    again = {r["id"]: r["probability"][1] for r in back.transform(df).collect()}
    assert all(abs(again[r["id"]] - r["probability"][1]) < 1e-12 for r in scored)
    parts = ta.tree_attribution(model, df, ["a", "b", "c"], "id").groupBy("id").sum("v").collect()
    base, total = ta.expected(model.trees, model.base), {r["id"]: r[1] for r in parts}
    assert all(abs(total[r["id"]] + base - r["probability"][1]) < 1e-9 for r in scored)


def test_odd_rows(spark):
    shape = T.StructType([T.StructField("id", T.LongType()), T.StructField("features", VectorUDT()),
                          T.StructField("label", T.DoubleType())])
    with pytest.raises(ValueError):
        fit(spark.createDataFrame([], shape), trees=2)
    from pyspark.ml.linalg import Vectors

    same = spark.createDataFrame([(i, Vectors.dense([float("nan"), 1.0]), 1.0) for i in range(5)], shape)
    model = fit(same, trees=3)                              # one class, nothing to split
    assert [len(t.feature) for t in model.trees] == [1, 1, 1]
    assert {round(r["probability"][1], 9) for r in model.transform(same).collect()} == {1.0}


def test_the_driver_holds_no_tree(spark, monkeypatch, tmp_path):
    """F2-F8: fitting, scoring, saving and loading leave the trees to the tasks."""
    df, _, _ = frame(spark, rows=600)
    driver = os.getpid()

    def elsewhere(f):
        def run(*args):
            assert os.getpid() != driver
            return f(*args)
        return run

    for name in ("load_tree", "_joined", "store_tree", "_tree_of"):
        monkeypatch.setattr(fo, name, elsewhere(getattr(fo, name)))
    model = fit(df, trees=7, depth=6)
    p1 = {r["id"]: r["probability"][1] for r in model.transform(df).collect()}
    model.write().overwrite().save(str(tmp_path / "forest"))
    back = fo.HistogramForestModel.load(str(tmp_path / "forest"))
    assert {r["id"]: r["probability"][1] for r in back.copy().transform(df).collect()} == p1
    for m in (model, back):
        assert len(m.files) == 7 and len(pickle.dumps(vars(m)["files"])) < 7 * 250
        assert not any(isinstance(t, bo.Tree) for v in vars(m).values() if isinstance(v, (list, tuple)) for t in v)
    monkeypatch.undo()
    assert [len(t.feature) for t in model.trees] == [len(t.feature) for t in back.trees]


def test_stored_trees_score_as_trees_do(spark, monkeypatch, tmp_path):
    df, x, _ = frame(spark, rows=700)
    trees = fit(df, trees=6, depth=7).trees
    files = [fo.store_tree(t, str(tmp_path / "forest"), i) for i, t in enumerate(trees)]
    x = np.concatenate([x, np.full((3, x.shape[1]), np.nan), np.full((2, x.shape[1]), np.inf)])
    want = bo.margins(x, trees, 0.25, 7)
    for kept in (0, 3000, 1 << 20):                                # none, some and all are kept
        monkeypatch.setattr(fo, "KEPT_TREE_BYTES", kept)
        monkeypatch.setattr(fo, "_KEPT", {"folder": None, "bytes": 0, "paths": {}})
        assert (fo.leaf_sums(x, files, 0.25) == want).all() and fo._KEPT["bytes"] <= kept
        assert (fo.leaf_sums(x[:5], files, 0.25) == want[:5]).all()


def test_a_trial_leaves_no_files(spark):
    df, _, _ = frame(spark, rows=300)
    model = fit(df, trees=3, depth=3)
    system, path = fo._system(model.files[0])
    assert system.get_file_info(path).is_file
    model.discard()
    assert not system.get_file_info(path).is_file


def test_features_of_a_lot_are_those_of_its_nodes_and_even():
    p = fo.ForestParams()
    nodes = np.arange(4000)
    lot = fo.lot_features(p, np.full(4000, 3), nodes, 9, 5)
    assert lot.shape == (4000, 3) and (np.diff(lot, axis=1) > 0).all()
    assert all((lot[i] == fo.node_features(p, 3, int(i), 9, 5)).all() for i in (0, 7, 3999))
    assert abs(np.bincount(lot.ravel(), minlength=9) / 4000 - 1 / 3).max() < 0.04
    assert (fo.lot_features(p, np.full(4000, 4), nodes, 9, 5) != lot).any(axis=1).mean() > 0.9


def test_no_rows_score_to_none(spark):
    df, _, _ = frame(spark, rows=40)
    model = fit(df, trees=2, depth=2)
    none = df.where("id < 0").repartition(3)
    assert model.transform(none).collect() == [] and model.transform(none).count() == 0
