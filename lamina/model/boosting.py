"""Second-order gradient-boosted trees for a 0/1 label (Chen and Guestrin 2016).

A tree grows level by level. For each level one Spark job sums the gradients and
hessians of the logistic loss per (node, feature, bin) over all rows of one child of each
split, the other's sums are what their parent's have left; a node's split is the bin border
with the highest regularised gain

    (GL^2 / (HL + l2) + GR^2 / (HR + l2) - G^2 / (H + l2)) / 2,

and a leaf's value is -G / (H + l2), shrunk by the step. Rows with bin <= border, that
is with a value below the border's cut, go left; NaN counts as the least value.

The rows are binned once and written as blocks (``pack``); a task keeps only sums, whose
size follows the model and not the rows, and sums of many tasks are added up by grouped
tasks before the driver gets them. A row's margin is a function of the trees so far: a
worker that has lost it, or never had it, computes it again from the broadcast trees.
"""

from __future__ import annotations

import json
import uuid
from collections import OrderedDict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.ml.util import MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina import fixed
from lamina.session import work_path

#: Rows of a block, and sums that meet in one grouped task or on the driver.
BLOCK_ROWS = 1 << 16
FAN_IN = 32
#: Bytes of sums that the driver gets at once; larger ones are added up by tasks alone.
SUM_BYTES = 16 << 20
#: Parts of few rows.
PARTS = 8
#: Rows that are scored at a time.
STEP_ROWS = 1 << 12
#: Rows of a piece of a block, the unit that is dealt out to tasks.
PIECE_ROWS = 1 << 14
#: Blocks whose margins a worker keeps (half a MB each), as pieces.
KEPT_BLOCKS = 512

NODES = ("tree int, node int, feature int, threshold double, left int, right int, "
         "value double, gain double, cover double")
NODE_COLUMNS = [c.split()[0] for c in NODES.split(", ")]
NODE_KEYS, NODE_VALUES = ("tree", "node", "feature", "left", "right"), ("threshold", "value", "gain", "cover")


@dataclass(frozen=True)
class BoostParams:
    rounds: int = fixed.BOOSTED_PARAMS["rounds"]
    step: float = fixed.BOOSTED_PARAMS["step"]
    depth: int = fixed.BOOSTED_PARAMS["depth"]
    l2: float = 1.0
    min_child: float = 1.0        # least hessian sum of a child
    min_gain: float = 1e-6
    subsample: float = 1.0        # rows a tree
    colsample: float = 1.0        # features a tree
    scale_pos: float = 1.0        # weight of class 1
    bins: int = 256
    seed: int = fixed.SEED


@dataclass
class Tree:
    """Nodes in the order of their creation; a leaf has feature -1."""

    feature: np.ndarray
    cut_bin: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    cover: np.ndarray

    def places(self, x: np.ndarray, border: np.ndarray, strict: bool, depth: int) -> np.ndarray:
        """The node where each row of ``x`` ends up; ``strict`` for x < border, else x <= border."""
        at = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        for _ in range(depth):
            f = self.feature[at]
            v = x[rows, np.maximum(f, 0)]
            goes_left = (v < border[at]) if strict else (v <= border[at])
            if strict:
                goes_left |= np.isnan(v)
            at = np.where(f < 0, at, np.where(goes_left, self.left[at], self.right[at]))
        return at


def bin_places(bins: np.ndarray, tree: Tree, depth: int, start: np.ndarray | None = None,
               rows: np.ndarray | None = None) -> np.ndarray:
    """``Tree.places`` by bins, feature by feature: ``bins`` is (feature, row). A node's
    right child follows its left one. ``start``: nodes that rows have reached already; ``rows``:
    those to place, else all."""
    n = bins.shape[1]
    rows, flat = np.arange(n) if rows is None else rows, bins.reshape(-1)
    inner = tree.feature >= 0
    first = np.where(inner, tree.feature, 0).astype(np.int64) * n
    border = np.where(inner, tree.cut_bin, 255).astype(np.uint8)         # a leaf keeps its rows
    left = np.where(inner, tree.left, np.arange(len(inner))).astype(np.int64)
    at = np.zeros(len(rows), np.int64) if start is None else start.astype(np.int64)
    for _ in range(min(depth, len(inner) - 1)):
        at = left.take(at) + (flat.take(first.take(at) + rows) > border.take(at))
    return at


@dataclass
class Growing:
    """A tree under construction, as lists."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut_bin: list[int] = field(default_factory=lambda: [0])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    cover: list[float] = field(default_factory=lambda: [0.0])

    def arrays(self) -> Tree:
        return Tree(*(np.array(x) for x in (self.feature, self.cut_bin, self.threshold, self.left, self.right,
                                            self.value, self.gain, self.cover)))

    def add(self) -> int:
        for name in ("feature", "cut_bin", "threshold", "left", "right", "value", "gain", "cover"):
            getattr(self, name).append(-1 if name == "feature" else 0)
        return len(self.feature) - 1


# -- binning -------------------------------------------------------------------------


def feature_cuts(rows: DataFrame, features: list, bins: int) -> list[np.ndarray]:
    """Ascending borders of each feature's bins, at most bins - 1: data values at evenly
    spaced ranks by Spark's quantile sketch, so all values but the least where each of
    few values has a share. Null and NaN aren't ranked."""
    named = rows.select(*[F.nanvl(c.cast("double"), F.lit(None).cast("double")).alias(f"f{i}")
                          for i, c in enumerate(features)])
    probs = [i / bins for i in range(bins + 1)]
    found = named.approxQuantile(named.columns, probs, 1.0 / (8 * bins))
    return [np.unique(q)[1:][-(bins - 1):] if q else np.zeros(0) for q in found]


def pack(rows: DataFrame, features_col: str, label_col: str, order_col: str, partitions: int,
         cuts: list[np.ndarray]) -> DataFrame:
    """Blocks of rows: bins (a byte a feature, rows one after another) and labels,
    written to the shared folder. Rows are dealt out and ordered by a hash of
    ``order_col``, so that the same rows give the same blocks."""
    dealt = (rows.select(F.col(order_col).alias("__order"), vector_to_array(F.col(features_col)).alias("x"),
                         F.col(label_col).cast("double").alias("y"))
             .repartition(partitions, "__order").sortWithinPartitions("__order"))

    def run(batches):
        block = TaskContext.get().partitionId() << 32
        held, size = [], 0

        def close():
            nonlocal block
            x, y = (np.concatenate(p) for p in zip(*held))
            row = pa.RecordBatch.from_pydict({"block": [block], "n": [len(y)], "bins": [x.tobytes()],
                                              "labels": [y.astype(np.uint8).tobytes()]},
                                             schema=pa.schema([("block", pa.int64()), ("n", pa.int64()),
                                                               ("bins", pa.binary()), ("labels", pa.binary())]))
            block += 1
            return row

        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(cuts))
            binned = np.stack([np.where(np.isnan(x[:, f]), 0, np.searchsorted(c, x[:, f], side="right"))
                               for f, c in enumerate(cuts)], axis=1).astype(np.uint8) if len(cuts) else x.astype(np.uint8)
            held.append((binned, batch.column(2).to_numpy()))
            size += batch.num_rows
            if size >= BLOCK_ROWS:
                yield close()
                held, size = [], 0
        if held:
            yield close()

    packed = dealt.select("__order", "x", "y").mapInArrow(run, "block long, n long, bins binary, labels binary")
    path = work_path(rows.sparkSession, "boost-blocks")
    packed.write.parquet(path)
    return rows.sparkSession.read.schema(packed.schema).parquet(path)


# -- sums of a level -----------------------------------------------------------------

PIECES = "block long, first long, whole long, n long, bins binary, labels binary"


def pieces(blocks: DataFrame, n_features: int) -> tuple[RDD, int]:
    """The blocks cut up, as tuples of PIECES, bins feature by feature, dealt out evenly in a
    fixed order; and the number of parts: as many as the blocks' rows fill, PARTS at most, then
    one for each part of the blocks. Every part sends its sums, so that more of them cost more
    than they save. An RDD, as a level's job is short and planning a query would be most of it."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                bins = np.frombuffer(row["bins"], np.uint8).reshape(row["n"], n_features)
                for a in range(0, row["n"], PIECE_ROWS):
                    part = np.ascontiguousarray(bins[a:a + PIECE_ROWS].T)
                    yield pa.RecordBatch.from_pydict(
                        {"block": [row["block"]], "first": [a], "whole": [row["n"]], "n": [part.shape[1]],
                         "bins": [part.tobytes()], "labels": [row["labels"][a:a + PIECE_ROWS]]},
                        schema=pa.schema([(n, pa.int64()) for n in ("block", "first", "whole", "n")]
                                         + [(n, pa.binary()) for n in ("bins", "labels")]))

    n = blocks.agg(F.sum("n")).first()[0] or 1
    parts = max(blocks.rdd.getNumPartitions(), min(PARTS, -(-int(n) // BLOCK_ROWS)))
    cut = blocks.mapInArrow(run, PIECES).repartition(parts).sortWithinPartitions("block", "first")
    return cut.rdd.map(lambda r: (*r[:4], bytes(r[4]), bytes(r[5]))), parts


_MARGINS: OrderedDict = OrderedDict()      # of a Python worker: (fit, block, first) -> (trees applied, margins)


def _margins(fit: str, block: int, first: int, bins: np.ndarray, trees: list[Tree], depth: int, base: float) -> np.ndarray:
    done, margin = _MARGINS.pop((fit, block, first), (0, None))
    if margin is None or done > len(trees):
        done, margin = 0, np.full(bins.shape[1], base)
    for t in trees[done:]:
        margin = margin + t.value.take(bin_places(bins, t, depth))
    _MARGINS[fit, block, first] = len(trees), margin
    while len(_MARGINS) > KEPT_BLOCKS * (BLOCK_ROWS // PIECE_ROWS):
        _MARGINS.popitem(last=False)
    return margin


_PLACES: OrderedDict = OrderedDict()       # of a Python worker: (fit, block, first) -> (tree, levels, nodes)


def _places(fit: str, block: int, first: int, bins: np.ndarray, tree_no: int, tree: Tree, levels: int) -> np.ndarray:
    """The nodes of rows ``levels`` below the root of the growing tree, from those above, if the worker has them."""
    own, done, at = _PLACES.pop((fit, block, first), (-1, 0, None))
    if own != tree_no or done > levels:
        done, at = 0, None
    at = bin_places(bins, tree, levels - done, at)
    _PLACES[fit, block, first] = tree_no, levels, at.astype(np.int32)
    while len(_PLACES) > KEPT_BLOCKS * (BLOCK_ROWS // PIECE_ROWS):
        _PLACES.popitem(last=False)
    return at


def _sampled(p: BoostParams, tree: int, block: int, n: int) -> np.ndarray | None:
    if p.subsample >= 1.0:
        return None
    draw = np.random.Generator(np.random.Philox(np.random.SeedSequence([p.seed, tree, block])))
    return draw.random(n) < p.subsample


def add_parts(parts: DataFrame, n_parts: int, dtype=np.float64, most: int = FAN_IN) -> list:
    """Rows (part, sums) of many tasks, added up by grouped tasks until at most ``most`` are left."""

    def add(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        total = sum((np.frombuffer(r["sums"], dtype) for r in rows[1:]), np.frombuffer(rows[0]["sums"], dtype))
        return pa.table({"part": [rows[0]["part"] // FAN_IN], "sums": [total.tobytes()]})

    left = n_parts
    while left > most:
        parts = (parts.withColumn("__lot", F.floor(F.col("part") / FAN_IN)).groupBy("__lot")
                 .applyInArrow(lambda t: add(t.select(["part", "sums"])), "part long, sums binary"))
        left = -(-left // FAN_IN)
    return sorted(parts.collect(), key=lambda r: r["part"])


def _add_up(parts: RDD, n_parts: int, most: int | None = None) -> list[tuple[int, bytes]]:
    """``add_parts`` of tuples (part, sums)."""

    def add(lot):
        rows = sorted(lot[1])
        return lot[0], sum((np.frombuffer(r) for _, r in rows[1:]), np.frombuffer(rows[0][1])).tobytes()

    left = n_parts
    while left > (most or FAN_IN):
        left = -(-left // FAN_IN)
        parts = parts.keyBy(lambda r: r[0] // FAN_IN).groupByKey(left).map(add)
    return sorted(parts.collect())


def _level_sums(blocks: RDD, fit: str, trees, grown: Tree, level: list[int], depth: int, p: BoostParams,
                n_features: int, used: list[int], base: float, n_parts: int) -> np.ndarray:
    """(node, feature, bin, [gradient, hessian]) sums of ``level``, nodes at ``depth``, of the ``used``
    features and the first."""
    shape = (len(level), n_features, p.bins, 2)
    tree_no = len(trees.value)
    summed = sorted({0, *(int(f) for f in used)}) if n_features else []

    def run(part, rows):
        own, total = trees.value, np.zeros((n_features, 2, len(level) * p.bins))
        place = np.full(len(grown.feature), -1)
        place[level] = np.arange(len(level))
        for block, first, whole, n, bins, labels in rows:
            bins = np.frombuffer(bins, np.uint8).reshape(n_features, n)
            one = np.frombuffer(labels, np.uint8) == 1
            prob = 1.0 / (1.0 + np.exp(-_margins(fit, block, first, bins, own, p.depth, base)))
            g, h = prob - one, prob * (1.0 - prob)
            if p.scale_pos != 1.0:
                w = np.where(one, p.scale_pos, 1.0)
                g, h = g * w, h * w
            node = place.take(_places(fit, block, first, bins, tree_no, grown, depth))
            keep = node >= 0
            drawn = _sampled(p, tree_no, block, whole)
            if drawn is not None:
                keep &= drawn[first:first + n]
            if not keep.all():
                kept = np.flatnonzero(keep)
                g, h, node = g.take(kept), h.take(kept), node.take(kept)
            else:
                kept = None
            at = node * p.bins
            for f in summed:
                cell = at + (bins[f] if kept is None else bins[f].take(kept))
                total[f, 0] += np.bincount(cell, g, len(level) * p.bins)
                total[f, 1] += np.bincount(cell, h, len(level) * p.bins)
        sums = np.ascontiguousarray(total.reshape(n_features, 2, len(level), p.bins).transpose(2, 0, 3, 1))
        yield part, sums.tobytes()

    most = max(1, min(FAN_IN, SUM_BYTES // (8 * int(np.prod(shape)) or 1)))
    rows = _add_up(blocks.mapPartitionsWithIndex(run), n_parts, most)
    return sum((np.frombuffer(r) for _, r in rows), np.zeros(int(np.prod(shape)))).reshape(shape)


def best_splits(sums: np.ndarray, cuts: list[np.ndarray], features: np.ndarray, p: BoostParams):
    """Per node (gain, feature, border, G, H, GL, HL); of equal gains the first feature's
    first border. No admissible split: a gain of -inf."""
    g, h = sums[..., 0], sums[..., 1]
    g_all, h_all = g[:, 0, :].sum(axis=1), h[:, 0, :].sum(axis=1)
    gl, hl = np.cumsum(g, axis=2), np.cumsum(h, axis=2)
    gr, hr = g_all[:, None, None] - gl, h_all[:, None, None] - hl
    borders = np.arange(p.bins)[None, :] < np.array([len(c) for c in cuts])[:, None]
    usable = borders & np.isin(np.arange(len(cuts)), features)[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (gl**2 / (hl + p.l2) + gr**2 / (hr + p.l2) - (g_all**2 / (h_all + p.l2))[:, None, None]) / 2
    gain = np.where(usable[None] & (hl >= p.min_child) & (hr >= p.min_child) & np.isfinite(gain), gain, -np.inf)
    flat = gain.reshape(len(gain), -1)
    at = flat.argmax(axis=1)
    node, f, b = np.arange(len(gain)), at // p.bins, at % p.bins
    return flat[node, at], f, b, g_all, h_all, gl[node, f, b], hl[node, f, b]


def _counted(level: list[int], cover: list[float]) -> list[int]:
    """Of each pair of a level's nodes, which are siblings, the lighter one; of the root, it."""
    return level if len(level) < 2 else [a if cover[a] <= cover[b] else b for a, b in zip(level[::2], level[1::2])]


def _with_siblings(sums: np.ndarray, counted: list[int], level: list[int], parents: np.ndarray) -> np.ndarray:
    """The sums of all nodes of a level: what ``counted`` leave of their parents' are their siblings'.
    A bin that only rounding leaves something of is empty."""
    rest = parents - sums
    rest[rest[..., 1] <= 1e-11 * parents[..., 1]] = 0.0
    out = np.empty((len(level), *sums.shape[1:]))
    right = np.array(counted) == np.array(level[1::2])
    out[0::2], out[1::2] = np.where(right[:, None, None, None], rest, sums), np.where(right[:, None, None, None], sums, rest)
    return out


def fit_trees(blocks: DataFrame, cuts: list[np.ndarray], p: BoostParams, base: float = 0.0) -> list[Tree]:
    """``base`` is the margin before the first tree (0: a probability of one half)."""
    spark, fit = blocks.sparkSession, uuid.uuid4().hex
    n_features = len(cuts)
    done: list[Tree] = []
    blocks, n_parts = pieces(blocks, n_features)
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)      # a cache: a lost part is read again from its files
    for t in range(p.rounds):
        rng = np.random.Generator(np.random.Philox(np.random.SeedSequence([p.seed, t])))
        used = np.sort(rng.choice(n_features, max(1, int(p.colsample * n_features)), replace=False)) if n_features else []
        tree, level = Growing(), [0]
        shared = spark.sparkContext.broadcast(done)
        parents = None
        for depth in range(p.depth):
            counted = _counted(level, tree.cover)
            sums = _level_sums(blocks, fit, shared, tree.arrays(), counted, depth, p, n_features, list(used), base,
                               n_parts)
            if parents is not None:
                sums = _with_siblings(sums, counted, level, parents)
            gain, f, b, g, h, gl, hl = best_splits(sums, cuts, np.asarray(used), p)
            below = []
            for i, node in enumerate(level):
                tree.cover[node] = float(h[i])
                tree.value[node] = float(-g[i] / (h[i] + p.l2) * p.step)
                if gain[i] <= p.min_gain:
                    continue
                tree.feature[node], tree.cut_bin[node] = int(f[i]), int(b[i])
                tree.threshold[node], tree.gain[node] = float(cuts[f[i]][b[i]]), float(gain[i])
                for side, gs, hs in (("left", gl[i], hl[i]), ("right", g[i] - gl[i], h[i] - hl[i])):
                    child = tree.add()
                    getattr(tree, side)[node] = child
                    tree.cover[child], tree.value[child] = float(hs), float(-gs / (hs + p.l2) * p.step)
                    below.append(child)
            parents, level = sums[gain > p.min_gain], below
            if not level:
                break
        done = [*done, tree.arrays()]
        shared.unpersist()
    blocks.unpersist()
    return done


# -- the model -----------------------------------------------------------------------


def margins(x: np.ndarray, trees: list[Tree], base: float, depth: int) -> np.ndarray:
    """Rows of feature values; ``depth`` is the trees' most. NaN goes left."""
    out = np.full(len(x), base)
    paths = []
    for t in trees:
        own, inner = np.arange(len(t.feature)), t.feature >= 0
        child = np.stack([np.where(inner, t.left, own), np.where(inner, t.right, own)], axis=1).reshape(-1)
        paths.append((np.where(inner, t.feature, 0).astype(np.int64), child.astype(np.int64),
                      min(depth, int(inner.sum()))))
    for first in range(0, len(x), STEP_ROWS):
        part = np.ascontiguousarray(x[first:first + STEP_ROWS].T)
        n = part.shape[1]
        flat, rows = part.reshape(-1), np.arange(n)
        for t, (feature, child, steps) in zip(trees, paths):
            start, at = feature * n, np.zeros(n, np.int64)
            for _ in range(steps):
                goes_right = flat.take(start.take(at) + rows) >= t.threshold.take(at)
                at = child.take(2 * at + goes_right)
            out[first:first + n] += t.value.take(at)
    return out


def tree_depth(t: Tree) -> int:
    deep = np.zeros(len(t.feature), np.int64)
    for i in np.flatnonzero(t.feature >= 0):          # a child is made after its parent
        deep[t.left[i]] = deep[t.right[i]] = deep[i] + 1
    return int(deep.max(initial=0))


class _BoostCols(HasFeaturesCol, HasLabelCol):
    orderCol = Param(Params._dummy(), "orderCol", "column that deals out and orders the rows", TypeConverters.toString)
    partitions = Param(Params._dummy(), "partitions", "partitions of the binned rows", TypeConverters.toInt)


class SecondOrderTrees(Estimator, _BoostCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fits ``SecondOrderTreesModel``; ``params`` are BoostParams as JSON."""

    boost = Param(Params._dummy(), "boost", "BoostParams as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, featuresCol="features", labelCol="label", orderCol="id", partitions=1, boost="{}"):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(featuresCol="features", labelCol="label", orderCol="id", partitions=1, boost="{}")

    def _fit(self, dataset: DataFrame) -> "SecondOrderTreesModel":
        p = BoostParams(**json.loads(self.getOrDefault(self.boost)))
        first = dataset.select(F.size(vector_to_array(self.getFeaturesCol())).alias("n")).first()
        if first is None:
            raise ValueError("no rows to fit")
        array = vector_to_array(F.col(self.getFeaturesCol()))
        cuts = feature_cuts(dataset, [array[i] for i in range(first["n"])], p.bins)
        blocks = pack(dataset, self.getFeaturesCol(), self.getLabelCol(), self.getOrDefault(self.orderCol),
                      self.getOrDefault(self.partitions), cuts)
        return SecondOrderTreesModel(featuresCol=self.getFeaturesCol()).with_trees(fit_trees(blocks, cuts, p))


class SecondOrderTreesModel(Model, HasFeaturesCol, MLReadable, MLWritable):
    """Adds ``margin`` and ``probability`` (of class 0 and 1). The trees are numpy arrays
    in the tasks, rows come in Arrow batches."""

    @keyword_only
    def __init__(self, featuresCol="features"):
        super().__init__()
        self._set(**self._input_kwargs)
        self.trees: list[Tree] = []
        self.base = 0.0

    def with_trees(self, trees: list[Tree], base: float = 0.0) -> "SecondOrderTreesModel":
        self.trees, self.base = trees, base
        return self

    def copy(self, extra=None) -> "SecondOrderTreesModel":
        return super().copy(extra).with_trees(self.trees, self.base)

    def nodes(self, spark) -> DataFrame:
        """The node table: one row per tree and node; leaves have feature -1. Its rows are made
        in tasks, a tree at a time."""
        n, tree_at = self._tree_reader(spark)
        types = {**dict.fromkeys(NODE_KEYS, pa.int32()), **dict.fromkeys(NODE_VALUES, pa.float64())}

        def run(batches):
            for batch in batches:
                for t in batch.column(0).to_pylist():
                    tree = tree_at(t)
                    own = {"tree": np.full(len(tree.feature), t), "node": np.arange(len(tree.feature))}
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own.get(n, getattr(tree, n, None)), types[n]) for n in NODE_COLUMNS], NODE_COLUMNS)

        return spark.range(0, n, 1, max(1, min(n, FAN_IN))).mapInArrow(run, NODES)

    def _tree_reader(self, spark):
        """The number of trees, and what gives a task the t-th one."""
        sent = spark.sparkContext.broadcast(self.trees)
        return len(self.trees), lambda t: sent.value[t]

    def with_nodes(self, nodes: DataFrame, base: float) -> "SecondOrderTreesModel":
        """The model of a node table."""
        return self.with_trees(trees_of(nodes), base)

    def _probability(self):
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin")))

    def _margin(self, dataset: DataFrame):
        trees, base = dataset.sparkSession.sparkContext.broadcast(self.trees), self.base
        depth = max(map(tree_depth, self.trees), default=0)

        @F.pandas_udf("double")
        def margin(x):
            import pandas as pd

            m = np.stack(x.to_numpy()) if len(x) else np.zeros((0, 1))
            return pd.Series(margins(m, trees.value, base, depth))

        return margin(vector_to_array(F.col(self.getFeaturesCol())))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        from pyspark.ml.functions import array_to_vector

        out = dataset.withColumn("margin", self._margin(dataset))
        p = self._probability()
        return out.withColumn("probability", array_to_vector(F.array(F.lit(1.0) - p, p)))

    def write(self) -> MLWriter:
        return _TreesWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TreesReader(cls)


def _tree_bytes(table: pa.Table) -> pa.Table:
    """One tree's rows of a node table as one row of packed columns."""
    own = table.sort_by("node")
    out = {"tree": pa.array([own["tree"][0].as_py()], pa.int32()), "n": [own.num_rows]}
    for name in NODE_COLUMNS[2:]:
        out[name] = [np.ascontiguousarray(own[name].to_numpy()).tobytes()]
    return pa.table(out)


def trees_of(nodes: DataFrame) -> list[Tree]:
    """Trees of a node table, packed a tree at a time by grouped tasks."""
    packed = nodes.groupBy("tree").applyInArrow(
        _tree_bytes, "tree int, n long, " + ", ".join(f"{n} binary" for n in NODE_COLUMNS[2:])).collect()
    out = []
    for r in sorted(packed, key=lambda r: r["tree"]):
        own = {n: np.frombuffer(r[n], np.int32 if n in NODE_KEYS else np.float64) for n in NODE_COLUMNS[2:]}
        out.append(Tree(cut_bin=np.zeros(r["n"], np.int16), **own))
    return out


class _TreesWriter(MLWriter):
    def __init__(self, instance: SecondOrderTreesModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession,
                                         extraMetadata={"base": self.instance.base})
        self.instance.nodes(self.sparkSession).write.mode("overwrite").parquet(f"{path}/nodes")


class _TreesReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> SecondOrderTreesModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model.with_nodes(self.sparkSession.read.schema(NODES).parquet(f"{path}/nodes"), metadata["base"])
