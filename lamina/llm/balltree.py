"""Exact ranked lexical search with sparse ball trees.

A document is a sparse vector of saturated term frequencies (integers), a query the
sparse vector of its terms' weights, the score their inner product. A shard of
consecutive documents is one ball tree. A node's centre c and radius r bound the
score of every document below it by q.c + |q| r (Ram and Gray 2012), where only the
terms that occur below the node count, and vectors are scaled by the square root
of the weights, the scaling that treats both sides alike. A query visits nodes
best-first and stops at the first one whose bound is below its k-th best score; the
documents of a leaf are scored in 64-bit integers.

Bounds are floating-point numbers, rounded up by more than their error (``SLACK``),
and compared with integer scores, so that no document that could qualify is pruned.

Shards are searched in two waves. The first takes a bounded number of them; its k-th
best scores are the floor from which the others start, in which most subtrees are then
pruned and few rows leave a task.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.common import ship_package, write_and_read
from lamina.llm.decontam import words

#: A shard is closed at so many words or documents, whichever comes first; a longer document is one alone.
SHARD_WORDS = 1 << 22
SHARD_DOCS = 1 << 13
LEAF_DOCS = 32
#: Words of queries that one pass broadcasts.
BLOCK_WORDS = 30_000
#: Queries whose bounds are held at once.
STEP_QUERIES = 256
#: Shards of the first wave, about.
FIRST_SHARDS = 16
#: Relative and absolute rounding of a bound, upwards; the error of its sums is below.
SLACK = 1e-6

SHARDS = ("shard long, n_docs long, doc_ids array<long>, lengths array<long>, "
          "starts array<int>, terms array<int>, counts array<int>")
_SHARDS = pa.schema([("shard", pa.int64()), ("n_docs", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                     ("lengths", pa.list_(pa.int64())), ("starts", pa.list_(pa.int32())),
                     ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])


def build_shards(docs: DataFrame, terms: list[bytes], id_col: str = "doc_id", text_col: str = "text",
                 shard_words: int = SHARD_WORDS, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Documents with words, in shards: per document its id, its words and the counts
    of ``terms`` that it holds (a search needs no others). Written below
    spark.checkpoint.dir."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(terms)

    def run(batches):
        known = {t: i for i, t in enumerate(shared.value)}
        shard = TaskContext.get().partitionId() << 32
        parts, doc_ids, lengths, size = [], [], [], 0

        def close() -> pa.RecordBatch:
            n = len(doc_ids)
            sizes = [len(p) for p in parts]
            ids = np.concatenate(parts)
            key = np.repeat(np.arange(n, dtype=np.int64), sizes) * len(known) + ids
            held, counts = np.unique(key[ids >= 0], return_counts=True)
            doc, term = np.divmod(held, max(1, len(known)))
            starts = np.searchsorted(doc, np.arange(n + 1))
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int64()), pa.array([n], pa.int64()),
                 *(pa.array([x], kind) for x, kind in zip(
                     (doc_ids, lengths, starts, term, counts), _SHARDS.types[2:]))], schema=_SHARDS)

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                found = words(text.as_py())
                if not found:
                    continue
                if doc_ids and (size + len(found) > shard_words or len(doc_ids) == shard_docs):
                    yield close()
                    shard += 1
                    parts, doc_ids, lengths, size = [], [], [], 0
                parts.append(np.fromiter(map(known.get, found, repeat(-1)), np.int32, len(found)))
                doc_ids.append(doc_id.as_py())
                lengths.append(len(found))
                size += len(found)
        if doc_ids:
            yield close()

    return write_and_read(docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, SHARDS), "lexical")


@dataclass(frozen=True)
class Corpus:
    """What the scores need of the whole corpus."""

    n_docs: int                # documents with a term
    n_words: int               # their terms, with repeats
    weights: np.ndarray        # of each known term

    def saturated(self, counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Of each (document, term): 10**9 tf div (1000 tf + 20 m)."""
        m = 100 - 50 + (50 * lengths * self.n_docs) // self.n_words
        return (1_000_000_000 * counts) // (1000 * counts + 20 * m)


def corpus_statistics(shards: DataFrame, n_terms: int) -> Corpus:
    """Sums over all shards; a row a term reaches the driver."""
    whole = shards.select("n_docs", F.aggregate("lengths", F.lit(0).cast("long"), lambda s, x: s + x).alias("w"))
    n_docs, n_words = whole.agg(F.sum("n_docs"), F.sum("w")).first()
    held = shards.select(F.explode("terms").alias("t")).groupBy("t").count().toPandas()
    df = np.zeros(n_terms, np.int64)
    df[held["t"].to_numpy()] = held["count"].to_numpy()
    n = n_docs or 0
    weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * int(f) + 1))) for f in df]
    return Corpus(n, n_words or 0, np.array(weights, np.int64))


@dataclass
class Tree:
    """A ball tree over sparse rows; the nodes in the order in which they were made,
    the documents below one consecutive in ``order``."""

    order: np.ndarray
    first: list[int] = field(default_factory=list)
    last: list[int] = field(default_factory=list)
    children: list[tuple[int, int] | None] = field(default_factory=list)


def _dots(starts: np.ndarray, terms: np.ndarray, values: np.ndarray, rows: np.ndarray, dense: np.ndarray) -> np.ndarray:
    """Sparse rows times a dense vector."""
    at, sizes = _spread(starts, rows)
    return np.bincount(np.repeat(np.arange(len(rows)), sizes), values[at] * dense[terms[at]], len(rows))


def _spread(starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries of some rows, one row after another, and how many each has."""
    sizes = starts[rows + 1] - starts[rows]
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts[rows] - before, sizes) + np.arange(int(sizes.sum())), sizes


def build_tree(starts: np.ndarray, terms: np.ndarray, values: np.ndarray, n_terms: int,
               leaf_docs: int = LEAF_DOCS) -> Tree:
    """Split every node of more than ``leaf_docs`` rows in two: the row farthest from
    the centre and the row farthest from that one are poles; rows go by their place
    between them, half to each side, so that equal rows don't stop the splitting."""
    n = len(starts) - 1
    square = np.bincount(np.repeat(np.arange(n), np.diff(starts)), values * values, n)
    tree = Tree(np.arange(n))
    todo = [(0, n, -1, 0)]

    def dense(row: int) -> np.ndarray:
        out = np.zeros(n_terms)
        out[terms[starts[row]:starts[row + 1]]] = values[starts[row]:starts[row + 1]]
        return out

    while todo:
        a, b, parent, side = todo.pop()
        node = len(tree.first)
        tree.first.append(a)
        tree.last.append(b)
        tree.children.append(None)
        if parent >= 0:
            own = tree.children[parent]
            tree.children[parent] = (node, own[1]) if side == 0 else (own[0], node)
        if b - a <= leaf_docs:
            continue
        rows = tree.order[a:b]
        at, _ = _spread(starts, rows)
        centre = np.bincount(terms[at], values[at], n_terms) / (b - a)
        far = square[rows] - 2 * _dots(starts, terms, values, rows, centre)
        one = rows[int(np.argmax(far))]
        to_one = _dots(starts, terms, values, rows, dense(one))
        two = rows[int(np.argmax(square[rows] - 2 * to_one))]
        place = to_one - _dots(starts, terms, values, rows, dense(two))
        half = (b - a) // 2
        tree.order[a:b] = rows[np.argsort(-place, kind="stable")]
        tree.children[node] = (-1, -1)
        todo += [(a + half, b, node, 1), (a, a + half, node, 0)]
    return tree


class Shard:
    """One shard's tree, with what bounds and scores need."""

    def __init__(self, row: dict, corpus: Corpus, leaf_docs: int = LEAF_DOCS):
        self.doc_ids = row["doc_ids"]
        lengths = np.array(row["lengths"], np.int64)
        self.starts = np.array(row["starts"], np.int64)
        self.terms = np.array(row["terms"], np.int64)
        self.exact = corpus.saturated(np.array(row["counts"], np.int64), np.repeat(lengths, np.diff(self.starts)))
        self.used, self.local = np.unique(self.terms, return_inverse=True)
        scale = np.sqrt(corpus.weights[self.used].astype(float))
        values = self.exact * scale[self.local]
        self.tree = build_tree(self.starts, self.local, values, len(self.used), leaf_docs)
        self._balls(values)
        self.scale = scale
        # rows in the tree's order: a leaf's entries are then consecutive
        at, sizes = _spread(self.starts, self.tree.order)
        self.leaf_starts = np.concatenate(([0], np.cumsum(sizes)))
        self.leaf_terms, self.leaf_values = self.local[at], self.exact[at]

    def _balls(self, values: np.ndarray) -> None:
        t, n_terms = self.tree, len(self.used)
        nodes = len(t.first)
        self.centres = np.zeros((nodes, n_terms))
        self.present = np.zeros((nodes, n_terms), np.float32)
        self.radii = np.zeros(nodes)
        for i in range(nodes):
            rows = t.order[t.first[i]:t.last[i]]
            at, sizes = _spread(self.starts, rows)
            cols, vals = self.local[at], values[at]
            c = np.bincount(cols, vals, n_terms) / max(1, len(rows))
            self.centres[i] = c
            self.present[i, cols] = 1
            # |x - c|^2 by differences where x has a term, and c's own elsewhere: no cancellation of large sums
            of = np.repeat(np.arange(len(rows)), sizes)
            inside = np.bincount(of, (vals - c[cols]) ** 2, len(rows))
            outside = np.maximum(0.0, (c * c).sum() - np.bincount(of, c[cols] ** 2, len(rows)))
            self.radii[i] = math.sqrt(float((inside + outside).max(initial=0.0)) + SLACK * float((c * c).sum()))

    def bounds(self, queries: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
        """Of each query (its terms) and node, a score that no document below exceeds."""
        q = np.zeros((len(queries), len(self.used)))
        for i, terms in enumerate(queries):
            at = np.searchsorted(self.used, terms)
            at = at[at < len(self.used)]
            at = at[np.isin(self.used[at], terms)]
            q[i, at] = self.scale[at]
        norms = np.sqrt((q * q) @ self.present.T)
        top = q @ self.centres.T + norms * self.radii
        return np.where(norms > 0, top * (1 + SLACK) + 1, 0.0)

    def score(self, node: int, weight: np.ndarray) -> np.ndarray:
        """Scores of a leaf's documents, in 64-bit integers; ``weight`` is of the
        shard's terms, 0 outside the query."""
        a, b = self.tree.first[node], self.tree.last[node]
        x, y = self.leaf_starts[a], self.leaf_starts[b]
        sums = np.concatenate(([0], np.cumsum(self.leaf_values[x:y] * weight[self.leaf_terms[x:y]])))
        return np.diff(sums[self.leaf_starts[a:b + 1] - x])

    def search(self, queries: list[np.ndarray], weights: np.ndarray, k: int, floors: np.ndarray):
        """(query, places, scores, leaves scored) of each query's candidates: at
        least those of its k best that reach its floor. Places are in the tree's order."""
        children, own = self.tree.children, weights[self.used]
        for first in range(0, len(queries), STEP_QUERIES):
            part = queries[first:first + STEP_QUERIES]
            bounds = self.bounds(part, weights)
            for i, terms in enumerate(part):
                weight = np.where(np.isin(self.used, terms), own, 0)
                least = max(1, int(floors[first + i]))
                best: list[tuple] = []                     # the k best so far, the worst first
                places, scores, read = [], [], 0
                open_ = [(-bounds[i, 0], 0)]
                while open_ and -open_[0][0] >= least:
                    _, node = heapq.heappop(open_)
                    pair = children[node]
                    if pair:
                        for c in pair:
                            if bounds[i, c] >= least:
                                heapq.heappush(open_, (-bounds[i, c], c))
                        continue
                    read += 1
                    s = self.score(node, weight)
                    good = np.flatnonzero(s >= least)
                    if not len(good):
                        continue
                    places.append(good + self.tree.first[node])
                    scores.append(s[good])
                    for x in s[good].tolist():
                        if len(best) < k:
                            heapq.heappush(best, x)
                        else:
                            heapq.heappushpop(best, x)
                    if len(best) == k:
                        least = max(least, best[0])
                if not places:
                    yield first + i, np.zeros(0, np.int64), np.zeros(0, np.int64), read
                    continue
                at, s = np.concatenate(places), np.concatenate(scores)
                kept = s >= least                          # equal scores stay: the smaller id decides
                yield first + i, at[kept], s[kept], read


FOUND = "query int, doc_id long, score long, leaves long, leaves_read long"


def _search(shards: DataFrame, corpus, queries, k: int, floors: np.ndarray, leaf_docs: int) -> DataFrame:
    """Candidates; the first row of a query and shard says how many leaves were read,
    with a null score where there are no candidates."""
    def run(batches):
        c, q = corpus.value, queries.value
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row, c, leaf_docs)
                leaves = sum(x is None for x in shard.tree.children)
                ids = np.array([x if x is not None else -1 for x in shard.doc_ids], np.int64)
                null = np.array([x is None for x in shard.doc_ids])
                for i, at, s, read in shard.search(q, c.weights, k, floors):
                    if len(at) > k:
                        rows = shard.tree.order[at]
                        top = np.lexsort((ids[rows], null[rows], -s))[:k]
                        at, s = at[top], s[top]
                    rows = shard.tree.order[at]
                    n = max(1, len(at))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i] * n, pa.int32()),
                         pa.array(ids[rows] if len(at) else [None], pa.int64(), mask=null[rows] if len(at) else None),
                         pa.array(s if len(at) else [None], pa.int64()),
                         pa.array([leaves] + [0] * (n - 1), pa.int64()), pa.array([read] + [0] * (n - 1), pa.int64())],
                        names=["query", "doc_id", "score", "leaves", "leaves_read"])

    return shards.mapInArrow(run, FOUND)


def _blocks(items: DataFrame, id_col: str, text_col: str, block_words: int):
    """The queries in blocks of about so many words: (item id, distinct terms)."""
    rows = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    size = F.length(F.coalesce("text", F.lit(""))) / 2 + 1           # no less than its words
    total = rows.agg(F.sum(size)).first()[0] or 0
    blocks = int(total // block_words) + 1
    place = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    for b in range(blocks):
        part = rows if blocks == 1 else rows.filter(place == b)
        yield [(r["id"], sorted(set(words(r["text"])))) for r in part.collect()]


def candidates(docs: DataFrame, texts: list[list[bytes]], k: int, id_col: str = "doc_id", text_col: str = "text",
               leaf_docs: int = LEAF_DOCS, first_shards: int = FIRST_SHARDS, **shard_size) -> DataFrame:
    """One block of queries, given as their distinct terms: (query, doc_id, score,
    leaves, leaves_read), each query's k best documents among them. Written below
    spark.checkpoint.dir."""
    spark = docs.sparkSession
    terms = sorted({t for own in texts for t in own})
    at = {t: i for i, t in enumerate(terms)}
    shards = build_shards(docs, terms, id_col, text_col, **shard_size)
    corpus = corpus_statistics(shards, len(terms))
    queries = [np.array(sorted(at[t] for t in own), np.int64) for own in texts]
    most = max((int(corpus.weights[q].sum()) for q in queries), default=0)
    if most >= 2**63 // 1_000_000:
        raise OverflowError("scores beyond 64 bits")
    shared = [spark.sparkContext.broadcast(x) for x in (corpus, queries)]
    floors = np.zeros(len(queries), np.int64)
    count = shards.count()
    every = -(-count // first_shards) if first_shards else 1
    narrow = shards.repartition("shard")
    place = F.pmod(F.xxhash64("shard"), F.lit(max(1, every)))
    if every <= 1:
        return write_and_read(_search(narrow, *shared, k, floors, leaf_docs), "candidates")
    first = write_and_read(_search(narrow.filter(place == 0), *shared, k, floors, leaf_docs), "candidates")
    order = Window.partitionBy("query").orderBy(F.desc("score"))
    kth = (first.filter("score IS NOT NULL").withColumn("r", F.row_number().over(order)).filter(F.col("r") == k)
           .select("query", "score").collect())                       # a number a query of the block
    for r in kth:
        floors[r["query"]] = r["score"]
    rest = write_and_read(_search(narrow.filter(place != 0), *shared, k, floors, leaf_docs), "candidates")
    return first.unionByName(rest)


def rank(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", block_words: int = BLOCK_WORDS, **how) -> DataFrame:
    """item_id, rank (from 1, unique), doc_id, score: each item's k best documents with
    a score above 0 (all, if fewer), equal scores by ascending id, a null id last.

    Terms are lower-cased words of the whole texts, an item's once each. Null and empty
    texts have none, and score with nothing. Every item row is ranked on its own, also
    where an item id is null or repeated; every document row counts, also where
    an id is repeated. No items or no documents: no rows. Items are searched in blocks of
    ``block_words``, each a pass over the documents. Other columns aren't read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    out = None
    for block in _blocks(items, item_col, item_text_col, block_words):
        block = [(i, own) for i, own in block if own]
        if not block:
            continue
        names = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(block)], "query int, item_id long")
        found = candidates(docs, [own for _, own in block], k, id_col, text_col, **how).filter("score IS NOT NULL")
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        ranked = ranked.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")  # a block's items
        out = ranked if out is None else out.unionByName(ranked)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
