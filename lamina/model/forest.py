"""A forest of classification trees with a least node size to split, by histograms.

Each tree draws ``share`` of the rows with replacement, exactly: the draws are dealt out
to the blocks and within a block by multinomial draws, so their number doesn't vary. A
node has features of its own, drawn without replacement, and splits where the Gini
impurity, with class weights, falls most. One with fewer draws than ``min_split`` stays a
leaf.

Nodes of more than SUBTREE_DRAWS draws grow together, level by level: one Spark job counts
the draws per (node, own feature, bin, class) for a lot of nodes, as many as fit LOT_BYTES.
For the others the counts would outgrow the rows: their rows meet by (tree, node) in
grouped tasks, one for each such node, which grow all that is below it.

Whole trees grow with the rows, so the driver never holds one: a task for each tree joins
its parts and writes it as a file of the shared folder, and the driver gets its name. Tasks
that score rows read the files, one tree at a time where they don't fit.

Rows come in the blocks of ``boosting.pack``. A lost task draws the same rows again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina import fixed
from lamina.model.boosting import (FAN_IN, STEP_ROWS, Growing, SecondOrderTreesModel, Tree, _BoostCols, add_parts,
                                   bin_places, feature_cuts, pack)
from lamina.session import work_path

#: Counts of one job, on the driver and in a task; the driver gets no more of them at once.
LOT_BYTES = 4 << 20
#: Most draws of a node whose subtree grows in one task (some 20 bytes a row).
SUBTREE_DRAWS = 1 << 19
#: Bytes of drawn rows that a task of subtrees gets, in several groups; nodes that it counts at once.
SUBTREE_BYTES = 32 << 20
SUBTREE_NODES = 1 << 10
#: Bytes of trees that a worker keeps, and rows that it scores before it reads the others again.
KEPT_TREE_BYTES = 64 << 20
SCORED_ROWS = 1 << 16


@dataclass(frozen=True)
class ForestParams:
    trees: int = fixed.FOREST_PARAMS["trees"]
    depth: int = fixed.FOREST_PARAMS["depth"]
    share: float = fixed.FOREST_PARAMS["share"]
    min_split: int = 2            # least draws of a node that splits
    features: int = 0             # of a node; 0: the root of their number, rounded down
    weight_0: float = 1.0
    weight_1: float = 1.0
    bins: int = 64
    seed: int = fixed.SEED


def _rng(*key: int) -> np.random.Generator:
    return np.random.Generator(np.random.Philox(np.random.SeedSequence(key)))


def block_draws(p: ForestParams, sizes: np.ndarray) -> np.ndarray:
    """Draws of each tree from each block: (tree, block). A tree's add up to the share."""
    n = int(sizes.sum())
    total = max(1, int(p.share * n + 0.5))
    return np.stack([_rng(p.seed, t).multinomial(total, sizes / n) for t in range(p.trees)])


def row_draws(p: ForestParams, tree: int, block: int, n: int, draws: int) -> np.ndarray:
    """How often the tree draws each row of a block."""
    return np.bincount(_rng(p.seed, tree, block & 0xFFFFFFFF, block >> 32).integers(0, n, draws), minlength=n)


def _mixed(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lot_features(p: ForestParams, trees: np.ndarray, nodes: np.ndarray, n_features: int, under: int = 0) -> np.ndarray:
    """Each node's own features, (node, feature): those with the least hashes. ``nodes`` count from
    the root, or from the node ``under`` which a subtree grew."""
    own = min(n_features, p.features or max(1, int(n_features ** 0.5)))
    step, key = np.uint64(0x9E3779B97F4A7C15), np.full(len(nodes), p.seed & 0xFFFFFFFFFFFFFFFF, np.uint64)
    for x in (trees, np.full(len(nodes), under), nodes):
        key = _mixed(key * step + np.asarray(x, np.int64).astype(np.uint64) + step)
    drawn = _mixed((key[:, None] + np.arange(1, n_features + 1, dtype=np.uint64)) * step)
    return np.sort(np.argsort(drawn, axis=1, kind="stable")[:, :own], axis=1)


def node_features(p: ForestParams, tree: int, node: int, n_features: int, under: int = 0) -> np.ndarray:
    return lot_features(p, np.array([tree]), np.array([node]), n_features, under)[0]


def _by_place(at: np.ndarray, places: int) -> np.ndarray:
    """A stable order by places; few of them are sorted digit by digit."""
    return np.argsort(at.astype(np.uint16) if places <= 1 << 16 else at, kind="stable")


def _lot_counts(blocks: DataFrame, grown: list[Tree], lot: list[tuple[int, int]], depth: int, own: np.ndarray, draws,
                place_of: dict[int, int], p: ForestParams, n_parts: int) -> np.ndarray:
    """(node of the lot, its feature, bin, class) draws. The nodes are at ``depth``; ``own``: each
    one's features."""
    shape = (len(lot), own.shape[1], p.bins, 2)
    of_tree: dict[int, list[int]] = {}
    for i, (t, _) in enumerate(lot):                    # a lot's nodes of a tree follow each other
        of_tree.setdefault(t, []).append(i)
    sent = blocks.sparkSession.sparkContext.broadcast(({t: grown[t] for t in of_tree}, lot, own, of_tree))

    def run(batches):
        trees, nodes, feats, places = sent.value
        total = np.zeros(shape, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                n = row["n"]
                bins = np.ascontiguousarray(np.frombuffer(row["bins"], np.uint8).reshape(n, -1).T)
                y = np.frombuffer(row["labels"], np.uint8)
                for t, slots in places.items():
                    tree = trees[t]
                    drawn = row_draws(p, t, row["block"], n, int(draws.value[t, place_of[row["block"]]]))
                    slot = np.full(len(tree.feature), -1)
                    slot[[nodes[i][1] for i in slots]] = np.arange(len(slots))
                    rows = np.flatnonzero(drawn)
                    at = slot.take(bin_places(bins, tree, depth, rows=rows))
                    if (at < 0).any():
                        kept = np.flatnonzero(at >= 0)
                        rows, at = rows.take(kept), at.take(kept)
                    first, held, flat = slots[0], len(slots), bins.reshape(-1)
                    weight, cell = drawn.take(rows).astype(float), at * (p.bins * 2) + y.take(rows)
                    for j in range(shape[1]):
                        start = feats[first:first + held, j] * n
                        value = flat.take(start.take(at) + rows).astype(np.int64)
                        value += value
                        value += cell
                        total[first:first + held, j] += np.bincount(
                            value, weight, held * p.bins * 2).astype(np.int64).reshape(held, p.bins, 2)
        yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "sums": [total.tobytes()]},
                                         schema=pa.schema([("part", pa.int64()), ("sums", pa.binary())]))

    most = max(1, min(FAN_IN, LOT_BYTES // (8 * int(np.prod(shape)) or 1)))
    rows = add_parts(blocks.mapInArrow(run, "part long, sums binary"), n_parts, np.int64, most)
    sent.unpersist()
    return sum((np.frombuffer(r["sums"], np.int64) for r in rows), np.zeros(int(np.prod(shape)), np.int64)).reshape(shape)


def gini_splits(counts: np.ndarray, own: np.ndarray, n_cuts: np.ndarray, p: ForestParams):
    """Per node (gain, feature, border, left and right counts by class): the highest fall
    of the weighted impurity; of equal ones the first feature's first border. -inf: none."""
    left = [np.cumsum(counts[..., k], axis=2) for k in (0, 1)]          # node, feature, bin by class
    right = [c[:, :1, -1:] - c for c in left]

    def impurity(c):                                                    # weight times Gini
        w0, w1 = c[0] * p.weight_0, c[1] * p.weight_1
        s = w0 + w1
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(s > 0, s - (w0 * w0 + w1 * w1) / s, 0.0)

    gain = impurity([c[:, :1, -1:] for c in left]) - impurity(left) - impurity(right)
    border = np.arange(p.bins)[None, None, :] < n_cuts[own][:, :, None]
    gain = np.where(border & (left[0] + left[1] > 0) & (right[0] + right[1] > 0), gain, -np.inf)
    flat = gain.reshape(len(gain), -1)
    at = flat.argmax(axis=1)
    node, j, b = np.arange(len(gain)), at // p.bins, at % p.bins
    return (flat[node, at], own[node, j], b, np.stack([c[node, j, b] for c in left], axis=1),
            np.stack([c[node, j, b] for c in right], axis=1))


NODE = np.dtype([("feature", "i2"), ("cut_bin", "i2"), ("threshold", "f8"), ("left", "i4"), ("right", "i4"),
                 ("value", "f8"), ("gain", "f8"), ("cover", "f8")])
DRAWN = pa.schema([("tree", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("bins", pa.binary()),
                   ("labels", pa.binary()), ("draws", pa.binary())])


def grow_below(bins: np.ndarray, y: np.ndarray, drawn: np.ndarray, cuts: list[np.ndarray], p: ForestParams,
               tree: int, under: int, depth: int) -> np.ndarray:
    """All nodes below one at ``depth``, itself first, from its rows: bins as (row, feature),
    labels and draws. Nodes are numbered level by level."""
    n_cuts, n_features = np.array([len(c) for c in cuts], np.int64), bins.shape[1]
    width = len(node_features(p, 0, 0, n_features))
    c = np.bincount(y, drawn, 2).astype(np.int64)[None]
    levels, made = [_nodes(c, p)], 1
    ids, rows, at = np.zeros(1, np.int64), np.arange(len(y)), np.zeros(len(y), np.int64)   # rows by node
    flat, drawn, y = np.ascontiguousarray(bins).reshape(-1), drawn.astype(float), y.astype(np.int64)
    for _ in range(depth, p.depth):
        level, first_id, below = levels[-1], made - len(levels[-1]), []
        edges = np.searchsorted(at, np.arange(len(ids) + 1))
        goes = np.full(len(rows), -1)
        for a in range(0, len(ids), SUBTREE_NODES):
            lot = ids[a:a + SUBTREE_NODES]
            span = slice(edges[a], edges[a + len(lot)])
            r, slot = rows[span], at[span] - a
            own = lot_features(p, np.full(len(lot), tree), lot, n_features, under)
            counts = np.empty((len(lot), width, p.bins, 2), np.int64)
            weight, cell, start = drawn.take(r), slot * (p.bins * 2) + y.take(r), r * n_features
            for j in range(width):
                value = flat.take(start + np.ascontiguousarray(own[:, j]).take(slot)).astype(np.int64)
                value += value
                value += cell
                counts[:, j] = np.bincount(value, weight, len(lot) * p.bins * 2).reshape(len(lot), p.bins, 2)
            gain, f, b, left, right = gini_splits(counts, own, n_cuts, p)
            split = np.flatnonzero((gain > 1e-9) & ((left + right).sum(axis=1) >= p.min_split))
            if not len(split):
                continue
            nodes = level[lot[split] - first_id]
            nodes["feature"], nodes["cut_bin"], nodes["gain"] = f[split], b[split], gain[split]
            nodes["threshold"] = [cuts[i][k] for i, k in zip(f[split], b[split])]
            nodes["left"] = made + 2 * np.arange(len(split))
            nodes["right"] = nodes["left"] + 1
            level[lot[split] - first_id] = nodes
            of, border = np.full(len(lot), -1), np.full(len(lot), p.bins)        # a leaf keeps its rows
            of[split], border[split] = nodes["left"], b[split]
            goes[span] = of.take(slot) + (flat.take(start + f.take(slot)) > border.take(slot))
            children = np.stack([left[split], right[split]], axis=1).reshape(-1, 2)
            below.append(children)
            made += len(children)
        if not below:
            break
        c = np.concatenate(below)
        levels.append(_nodes(c, p))
        ids = made - len(c) + np.flatnonzero((c.min(axis=1) > 0) & (c.sum(axis=1) >= p.min_split))
        if not len(ids):
            break
        place = np.full(len(c) + 1, -1)                          # the last one: of rows that stayed
        place[ids - (made - len(c))] = np.arange(len(ids))
        at = place.take(np.where(goes >= 0, goes - (made - len(c)), len(c)))
        kept = np.flatnonzero(at >= 0)
        kept = kept.take(_by_place(at.take(kept), len(ids)))
        rows, at = rows.take(kept), at.take(kept)
    return np.concatenate(levels)


def _nodes(c: np.ndarray, p: ForestParams) -> np.ndarray:
    """Leaves of these counts by class."""
    out = np.zeros(len(c), NODE)
    w0, w1 = c[:, 0] * p.weight_0, c[:, 1] * p.weight_1
    out["feature"], out["cover"] = -1, c.sum(axis=1)
    out["value"] = np.divide(w1, w0 + w1, out=np.zeros(len(c)), where=w0 + w1 > 0) / p.trees
    return out


def _subtrees(blocks: DataFrame, n_blocks: int, sent, nodes_of: dict[int, list[int]],
              todo: dict[tuple[int, int], tuple[int, int]], draws, place_of: dict[int, int], cuts: list[np.ndarray],
              p: ForestParams) -> DataFrame:
    """(tree, node, nodes): what is below each of ``todo``, (tree, node) -> (depth, draws).
    ``sent``: all trees so far and ``todo``; ``nodes_of``: its nodes of each tree."""
    n_features = len(cuts)
    deepest = {t: max(todo[t, node][0] for node in nodes) for t, nodes in nodes_of.items()}
    lots = max(1, min(p.trees, FAN_IN // max(1, n_blocks)))       # few blocks: the trees are dealt out, too

    def deal(batches):
        trees = sent.value[0]
        for batch in batches:
            for row in batch.to_pylist():
                bins = np.frombuffer(row["bins"], np.uint8).reshape(row["n"], n_features)
                turned = np.ascontiguousarray(bins.T)
                y = np.frombuffer(row["labels"], np.uint8)
                for t in (t for t in nodes_of if t % lots == row["lot"]):
                    drawn = row_draws(p, t, row["block"], row["n"], int(draws.value[t, place_of[row["block"]]]))
                    place = np.full(len(trees[t].feature), -1)
                    place[nodes_of[t]] = np.arange(len(nodes_of[t]))
                    r = np.flatnonzero(drawn)
                    at = place.take(bin_places(turned, trees[t], deepest[t], rows=r))
                    kept = np.flatnonzero(at >= 0)
                    kept = kept.take(_by_place(at.take(kept), len(nodes_of[t])))
                    r, at = r.take(kept), at.take(kept)
                    edges = np.searchsorted(at, np.arange(len(nodes_of[t]) + 1))
                    out = []
                    for node, a, b in zip(nodes_of[t], edges, edges[1:]):
                        if b > a:
                            k = r[a:b]
                            d = drawn[k]
                            out.append({"tree": t, "node": node, "n": len(k), "bins": bins[k].tobytes(), "labels": y[k].tobytes(),
                                        "draws": (d.astype(np.uint8) if d.max() < 256 else d.astype(np.int64)).tobytes()})
                    if out:
                        yield pa.RecordBatch.from_pylist(out, schema=DRAWN)

    def grow(table: pa.Table) -> pa.Table:
        t, node = table["tree"][0].as_py(), table["node"][0].as_py()
        sizes = table["n"].to_pylist()
        parts = [table[c].to_pylist() for c in ("bins", "labels", "draws")]
        bins = np.frombuffer(b"".join(parts[0]), np.uint8).reshape(-1, n_features)
        y = np.frombuffer(b"".join(parts[1]), np.uint8).astype(np.int64)
        drawn = np.concatenate([np.frombuffer(d, np.uint8 if len(d) == n else np.int64).astype(np.int64)
                                for d, n in zip(parts[2], sizes)])
        nodes = grow_below(bins, y, drawn, cuts, p, t, node, sent.value[1][t, node][0])
        return pa.table({"tree": [t], "node": [node], "nodes": [nodes.tobytes()]})

    size = sum(n for _, n in todo.values()) * (n_features + 2)
    parts = min(len(todo), max(2 * FAN_IN, -(-size // SUBTREE_BYTES)))
    cut = blocks.withColumn("lot", F.explode(F.sequence(F.lit(0), F.lit(lots - 1)))).repartition(
        max(blocks.rdd.getNumPartitions(), min(FAN_IN, n_blocks * lots)))
    return (cut.mapInArrow(deal, "tree long, node long, n long, bins binary, labels binary, draws binary")
            .repartition(parts, "tree", "node").groupBy("tree", "node")
            .applyInArrow(grow, "tree long, node long, nodes binary"))


def _joined(top: Tree, below: dict[int, np.ndarray]) -> Tree:
    """The tree with what grew below its nodes; new nodes follow, subtree by subtree."""
    old = np.zeros(len(top.feature), NODE)
    for name in NODE.names:
        old[name] = getattr(top, name)
    parts, size = [old], len(old)
    for node in sorted(below):
        own = below[node].copy()
        inner = own["feature"] >= 0
        for side in ("left", "right"):
            own[side][inner] += size - 1
        old[node] = own[0]
        parts.append(own[1:])
        size += len(own) - 1
    nodes = np.concatenate(parts)
    return Tree(*(np.ascontiguousarray(nodes[f]) for f in ("feature", "cut_bin", "threshold", "left", "right", "value",
                                                           "gain", "cover")))


# -- trees as files ------------------------------------------------------------------

STORED = pa.schema([("feature", pa.int16()), ("cut_bin", pa.int16()), ("threshold", pa.float64()), ("left", pa.int32()),
                    ("value", pa.float64()), ("gain", pa.float64()), ("cover", pa.float64())])


def _system(uri: str):
    """The file system and path of a URI or a plain path."""
    if "://" in uri or uri.startswith("file:"):
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


def store_tree(tree: Tree, folder: str, number: int) -> str:
    """Write a tree; the file's name is unique to an attempt. A right child follows its left one."""
    inner = tree.feature >= 0
    if not (tree.right[inner] == tree.left[inner] + 1).all():
        raise ValueError("a right child doesn't follow its left one")
    columns = [pa.array(getattr(tree, f.name), f.type) for f in STORED]
    uri = f"{folder}/tree-{number:06d}-{uuid.uuid4().hex[:12]}.arrow"
    system, path = _system(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(path) as f, pa.ipc.new_file(
            f, STORED, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(pa.RecordBatch.from_arrays(columns, schema=STORED))
    return uri


def load_tree(uri: str, names: list[str] | None = None) -> Tree | list[np.ndarray]:
    """A stored tree; with ``names`` these columns alone."""
    system, path = _system(uri)
    with system.open_input_file(path) as f:
        options = pa.ipc.IpcReadOptions(included_fields=[STORED.get_field_index(n) for n in names] if names else None)
        batch = pa.ipc.open_file(f, options=options).get_batch(0)
        if names:
            return [batch.column(batch.schema.get_field_index(n)).to_numpy() for n in names]
        own = {f.name: batch.column(i).to_numpy() for i, f in enumerate(STORED)}
    return Tree(right=np.where(own["feature"] >= 0, own["left"] + 1, 0).astype(np.int32), **own)


_KEPT: dict = {"folder": None, "bytes": 0, "paths": {}}     # of a Python worker: trees of the forest it scored last


def _paths(uri: str) -> tuple:
    """Per node feature, border, left child and value, and the tree's depth. A leaf leads to itself."""
    folder = uri.rpartition("/")[0]
    if _KEPT["folder"] != folder:
        _KEPT.update(folder=folder, bytes=0, paths={})
    if uri in _KEPT["paths"]:
        return _KEPT["paths"][uri]
    feature, threshold, left, value = load_tree(uri, ["feature", "threshold", "left", "value"])
    inner = feature >= 0
    deep, level = 0, np.flatnonzero(inner[:1])
    while len(level):
        deep, below = deep + 1, left[level]
        level = np.concatenate([below, below + 1])
        level = level[inner[level]]
    own = (np.where(inner, feature, 0).astype(np.int16), np.where(inner, threshold, np.nan),
           np.where(inner, left, np.arange(len(left))).astype(np.int32), value.copy(), deep)
    size = sum(x.nbytes for x in own[:4])
    if _KEPT["bytes"] + size <= KEPT_TREE_BYTES:
        _KEPT["paths"][uri] = own
        _KEPT["bytes"] += size
    return own


def leaf_sums(x: np.ndarray, files: list[str], base: float) -> np.ndarray:
    """``boosting.margins`` by stored trees, one after another; NaN goes left."""
    out = np.full(len(x), base)
    parts = [(a, np.ascontiguousarray(x[a:a + STEP_ROWS].T)) for a in range(0, len(x), STEP_ROWS)]
    for uri in files:
        feature, border, left, value, deep = _paths(uri)
        left, start, width = left.astype(np.int64), None, -1
        for first, part in parts:
            n = part.shape[1]
            if n != width:
                start, width = feature.astype(np.int64) * n, n
            flat, rows, at = part.reshape(-1), np.arange(n), np.zeros(n, np.int64)
            for _ in range(deep):                   # nothing reaches a leaf's border, which is NaN
                at = left.take(at) + (flat.take(start.take(at) + rows) >= border.take(at))
            out[first:first + n] += value.take(at)
    return out


def store_forest(parts: DataFrame, n_trees: int, joined) -> list[str]:
    """Files of trees, in their order. ``parts``: rows of each tree by the column tree, of which
    ``joined(table)`` makes the number and the tree in a task of their own."""
    spark = parts.sparkSession
    folder = work_path(spark, "forest")

    def write(table: pa.Table) -> pa.Table:
        number, tree = joined(table)
        return pa.table({"tree": pa.array([number], pa.int64()), "uri": [store_tree(tree, folder, number)]})

    found = {r["tree"]: r["uri"] for r in parts.groupBy("tree").applyInArrow(write, "tree long, uri string").collect()}
    if sorted(found) != list(range(n_trees)):
        raise ValueError(f"trees are missing: {len(found)} of {n_trees} were written")
    return [found[t] for t in range(n_trees)]


# -- fitting -------------------------------------------------------------------------


def fit_forest(blocks: DataFrame, cuts: list[np.ndarray], p: ForestParams) -> list[Tree]:
    """The trees of ``grow_forest``, read."""
    return [load_tree(uri) for uri in grow_forest(blocks, cuts, p)]


def grow_forest(blocks: DataFrame, cuts: list[np.ndarray], p: ForestParams) -> list[str]:
    """Files of the trees. Leaves hold their weighted share of class 1 divided by the number
    of trees, so that a row's leaves add up to its probability; ``cover`` is a node's draws."""
    listed = sorted((r["block"], r["n"]) for r in blocks.select("block", "n").collect())
    n_parts = max(blocks.rdd.getNumPartitions(), min(FAN_IN, len(listed)))
    blocks = blocks.repartition(n_parts).persist()      # a cache: a lost part is read again from its files
    place_of = {b: i for i, (b, _) in enumerate(listed)}
    spread = block_draws(p, np.array([n for _, n in listed]))
    draws = blocks.sparkSession.sparkContext.broadcast(spread)
    n_cuts, n_features = np.array([len(c) for c in cuts], np.int64), len(cuts)
    trees = [Growing() for _ in range(p.trees)]
    level, todo = [], {}

    def enter(t: int, node: int, depth: int, n: int) -> None:
        if n <= SUBTREE_DRAWS:
            todo[t, node] = (depth, n)
        else:
            level.append((t, node))

    for t in range(p.trees if n_features else 0):
        enter(t, 0, 0, int(spread[t].sum()))
    width = len(node_features(p, 0, 0, n_features)) if n_features else 0
    lot_size = max(1, LOT_BYTES // (max(1, width) * p.bins * 2 * 8))

    def set_node(t: int, node: int, c: np.ndarray) -> None:
        w0, w1 = float(c[0]) * p.weight_0, float(c[1]) * p.weight_1
        trees[t].cover[node] = float(c.sum())
        trees[t].value[node] = w1 / (w0 + w1) / p.trees if w0 + w1 > 0 else 0.0

    for depth in range(p.depth):
        now, level = sorted(level), []
        if not now:
            break
        grown = [x.arrays() for x in trees]
        for a in range(0, len(now), lot_size):
            lot = now[a:a + lot_size]
            own = lot_features(p, *np.array(lot).T, n_features)
            counts = _lot_counts(blocks, grown, lot, depth, own, draws, place_of, p, n_parts)
            gain, f, b, left, right = gini_splits(counts, own, n_cuts, p)
            for i, (t, node) in enumerate(lot):
                tree, n = trees[t], left[i] + right[i]
                if depth == 0:
                    set_node(t, node, counts[i, 0].sum(axis=0))
                if not gain[i] > 1e-9 or n.sum() < p.min_split:
                    continue
                tree.feature[node], tree.cut_bin[node] = int(f[i]), int(b[i])
                tree.threshold[node], tree.gain[node] = float(cuts[f[i]][b[i]]), float(gain[i])
                for side, c in (("left", left[i]), ("right", right[i])):
                    child = tree.add()
                    getattr(tree, side)[node] = child
                    set_node(t, child, c)
                    if c.min() > 0 and c.sum() >= p.min_split and depth + 1 < p.depth:
                        enter(t, child, depth + 1, int(c.sum()))
    spark = blocks.sparkSession
    sent = spark.sparkContext.broadcast(([x.arrays() for x in trees], todo))
    parts = spark.range(p.trees).select(F.col("id").alias("tree"), F.lit(-1).cast("long").alias("node"),
                                        F.lit(b"").alias("nodes"))          # each tree has a part
    if todo:
        nodes_of: dict[int, list[int]] = {}
        for t, node in sorted(todo):
            nodes_of.setdefault(t, []).append(node)
        parts = parts.unionByName(_subtrees(blocks, len(listed), sent, nodes_of, todo, draws, place_of, cuts, p))

    def joined(table: pa.Table) -> tuple[int, Tree]:
        t = table["tree"][0].as_py()
        below = {node: np.frombuffer(nodes, NODE)
                 for node, nodes in zip(table["node"].to_pylist(), table["nodes"].to_pylist()) if node >= 0}
        return t, _joined(sent.value[0][t], below)

    files = store_forest(parts, p.trees, joined)
    for x in (blocks, draws, sent):
        x.unpersist()
    return files


class HistogramForest(Estimator, _BoostCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fits ``HistogramForestModel``; ``params`` are ForestParams as JSON."""

    forest = Param(Params._dummy(), "forest", "ForestParams as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, featuresCol="features", labelCol="label", orderCol="id", partitions=1, forest="{}"):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(featuresCol="features", labelCol="label", orderCol="id", partitions=1, forest="{}")

    def _fit(self, dataset: DataFrame) -> "HistogramForestModel":
        p = ForestParams(**json.loads(self.getOrDefault(self.forest)))
        first = dataset.select(F.size(vector_to_array(self.getFeaturesCol())).alias("n")).first()
        if first is None:
            raise ValueError("no rows to fit")
        array = vector_to_array(F.col(self.getFeaturesCol()))
        cuts = feature_cuts(dataset, [array[i] for i in range(first["n"])], p.bins)
        blocks = pack(dataset, self.getFeaturesCol(), self.getLabelCol(), self.getOrDefault(self.orderCol),
                      self.getOrDefault(self.partitions), cuts)
        return HistogramForestModel(featuresCol=self.getFeaturesCol()).with_files(grow_forest(blocks, cuts, p))


class HistogramForestModel(SecondOrderTreesModel):
    """Its ``margin`` is the probability of class 1 itself: the mean of the trees' leaves. The
    trees stay in ``files``; ``trees`` reads them all."""

    files: tuple[str, ...] = ()

    def with_files(self, files: list[str], base: float = 0.0) -> "HistogramForestModel":
        self.files, self.base = tuple(files), base
        return self

    @property
    def trees(self) -> list[Tree]:
        return [load_tree(uri) for uri in self.files] if self.files else self._trees

    @trees.setter
    def trees(self, trees: list[Tree]) -> None:
        self.files, self._trees = (), trees

    def copy(self, extra=None) -> "HistogramForestModel":
        return Model.copy(self, extra)                  # a shallow one

    def with_nodes(self, nodes: DataFrame, base: float) -> "HistogramForestModel":
        n = nodes.agg(F.max("tree")).first()[0]
        return self.with_files(store_forest(nodes, -1 if n is None else n + 1, _tree_of), base)

    def discard(self) -> None:
        """Remove the files; the model can't score any more."""
        for folder in {uri.rpartition("/")[0] for uri in self.files}:
            system, path = _system(folder)
            system.delete_dir(path)

    def _tree_reader(self, spark):
        if not self.files:
            return super()._tree_reader(spark)
        files = self.files
        return len(files), lambda t: load_tree(files[t])

    def _margin(self, dataset: DataFrame):
        if not self.files:
            return super()._margin(dataset)
        files, base = self.files, self.base

        def scored(batches):
            held, size = [], 0
            for batch in batches:
                if len(batch):
                    held.append(batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1))
                    size += len(batch)
                if size >= SCORED_ROWS:
                    yield pa.array(leaf_sums(np.concatenate(held), files, base))
                    held, size = [], 0
            if held:
                yield pa.array(leaf_sums(np.concatenate(held), files, base))

        def margin(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            return scored(batches)

        margin.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
        return F.arrow_udf(margin, "double")(vector_to_array(F.col(self.getFeaturesCol())))

    def _probability(self):
        return F.col("margin")


def _tree_of(table: pa.Table) -> tuple[int, Tree]:
    """A tree and its number, of its rows of a node table."""
    own = table.sort_by("node")
    columns = {f.name: own[f.name].to_numpy() for f in STORED if f.name != "cut_bin"}
    return own["tree"][0].as_py(), Tree(cut_bin=np.zeros(own.num_rows, np.int16), right=own["right"].to_numpy(), **columns)
