"""Exact top-k by inner product with no-random-access aggregation.

Vectors become integers. A shard of some thousand vectors keeps one list per
component, its entries (place, value) in descending order; read from the other
end, the same list serves queries with a negative weight. A query block reads all
lists of a shard in stages, from both ends, and never fetches a single vector:

* what a list has not shown yet lies between the two frontiers, so that a
  component not seen counts with the far end of its list for the lower bound of
  the score, and with the near frontier for the upper bound;
* a query stops when no outsider's upper bound reaches its k-th best lower bound;
* the candidates left are the only ones read on, to their final scores.

The bounds of a whole block of queries over a shard are two matrix products a
stage. Shards meet in a ranking per query of at most k rows a shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.common import ship_package, write_and_read

SCALE = 256
SHARD_ROWS = 4096
#: Queries that one pass broadcasts.
BLOCK_QUERIES = 8192
#: Queries whose bounds are held at once.
STEP_QUERIES = 128
#: Depths, as shares of a list read from each end, at which bounds are compared.
STAGES = (1 / 16, 1 / 8, 1 / 4)

LISTS = "shard long, ids array<long>, dim int, places binary, values binary"
_LISTS = pa.schema([("shard", pa.int64()), ("ids", pa.list_(pa.int64())), ("dim", pa.int32()),
                    ("places", pa.binary()), ("values", pa.binary())])


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of the rows that take part: an id, and a vector without null or
    non-finite components that isn't null or empty."""
    finite = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & (F.size(vec_col) > 0) & finite)
            .select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")))


def quantised(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x), as doubles that hold integers."""
    return np.floor(np.asarray(x, float) * scale)


def build_lists(vectors: DataFrame, id_col: str, vec_col: str, scale: int = SCALE,
                shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard and dimension count: ids, and each component's list packed
    in descending order of value. Vectors of different lengths go to different
    shards. Written below spark.checkpoint.dir."""
    spark = vectors.sparkSession
    ship_package(spark)

    def run(batches):
        shard = TaskContext.get().partitionId() << 32
        held: dict[int, list] = {}

        def close(dim: int) -> pa.RecordBatch:
            nonlocal shard
            ids, rows = zip(*held.pop(dim))
            x = quantised(np.array(rows), scale)
            order = np.argsort(-x, axis=0, kind="stable")
            shard += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([shard - 1], pa.int64()), pa.array([list(ids)], pa.list_(pa.int64())),
                 pa.array([dim], pa.int32()), pa.array([order.T.astype("<i4").tobytes()], pa.binary()),
                 pa.array([np.take_along_axis(x, order, 0).T.astype("<f8").tobytes()], pa.binary())],
                schema=_LISTS)

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                row = v.values.to_numpy(zero_copy_only=False)
                own = held.setdefault(len(row), [])
                own.append((i, row))
                if len(own) == shard_rows:
                    yield close(len(row))
        for dim in sorted(held):
            yield close(dim)

    return write_and_read(usable(vectors, id_col, vec_col).mapInArrow(run, LISTS), "lists")


class ShardLists:
    """Sequential access to a shard's sorted lists from both ends."""

    def __init__(self, ids: list[int], dim: int, places: bytes, values: bytes):
        self.ids = np.array(ids, np.int64)
        self.n, self.dim = len(ids), dim
        self.places = np.frombuffer(places, "<i4").reshape(dim, self.n)
        self.values = np.frombuffer(values, "<f8").reshape(dim, self.n)
        self.top, self.bottom = self.values[:, 0].copy(), self.values[:, -1].copy()
        self.low = np.tile(self.bottom, (self.n, 1))    # least that each component can be
        self.high = np.tile(self.top, (self.n, 1))      # most that it can be
        self.read = 0
        self.whole: np.ndarray | None = None

    def read_to(self, depth: int) -> None:
        """Read each list's entries up to ``depth`` from both ends; what is still
        unseen lies between the frontiers."""
        depth = min(depth, (self.n + 1) // 2)
        if depth <= self.read:
            return
        unseen = np.ones((self.n, self.dim), bool)
        for d in range(self.dim):
            for part in (slice(0, depth), slice(self.n - depth, self.n)):
                at, v = self.places[d, part], self.values[d, part]
                self.low[at, d] = self.high[at, d] = v
                unseen[at, d] = False
        near_top, near_bottom = self.values[:, depth - 1], self.values[:, self.n - depth]
        np.copyto(self.high, near_top, where=unseen)
        np.copyto(self.low, near_bottom, where=unseen)
        self.read = depth

    def final(self, places: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Final scores of a few candidates: the lists are read on for them."""
        if self.whole is None:
            self.whole = np.empty((self.n, self.dim))
            np.put_along_axis(self.whole, self.places.T.astype(np.int64), self.values.T, axis=0)
        return self.whole[places] @ q

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores, queries x vectors."""
        plus, minus = np.maximum(q, 0), np.minimum(q, 0)
        if self.read * 2 >= self.n:
            exact = q @ self.low.T
            return exact, exact
        return plus @ self.low.T + minus @ self.high.T, plus @ self.high.T + minus @ self.low.T


def shard_top(lists: ShardLists, query_ids: np.ndarray, queries: np.ndarray, k: int,
              stages: tuple[float, ...] = STAGES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, ids, scores) of each query's k best of the shard, itself left out."""
    open_ = np.arange(len(queries))
    # own[i]: the place of the query's own row in the shard, or -1
    sorter = np.argsort(lists.ids, kind="stable")
    at = np.searchsorted(lists.ids, query_ids, sorter=sorter)
    own = np.where(at < lists.n, sorter[np.minimum(at, lists.n - 1)], -1)
    own = np.where((own >= 0) & (lists.ids[own] == query_ids), own, -1)
    repeated = len(np.unique(lists.ids)) < lists.n
    for share in (*stages, 1.0):
        last = share == 1.0
        lists.read_to(lists.n if last else max(k, int(lists.n * share)))
        still = []
        for a in range(0, len(open_), STEP_QUERIES):
            part = open_[a:a + STEP_QUERIES]
            low, high = lists.bounds(queries[part])
            if repeated:
                other = lists.ids[None, :] != query_ids[part][:, None]
                low, high = np.where(other, low, -np.inf), np.where(other, high, -np.inf)
            else:
                rows = np.flatnonzero(own[part] >= 0)
                if low is high:
                    high = low = low.copy()
                low[rows, own[part][rows]] = -np.inf
                high[rows, own[part][rows]] = -np.inf
            m = min(k, lists.n)
            kth = np.partition(low, lists.n - m, axis=1)[:, lists.n - m]
            left = high >= kth[:, None]
            left &= high > -np.inf
            few = left.sum(axis=1) <= 4 * k
            for i in np.flatnonzero(few | last):
                # no outsider can qualify: resolve the candidates left, and no others
                c = np.flatnonzero(left[i])
                final = low[i, c] if last else lists.final(c, queries[part[i]])
                order = np.lexsort((lists.ids[c], -final))[:k]
                yield int(part[i]), lists.ids[c[order]], final[order]
            still.append(part[~(few | last)])
        open_ = np.concatenate(still)
        if not len(open_):
            return


def top_k(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id",
          vec_col: str = "embedding", scale: int = SCALE, shard_rows: int = SHARD_ROWS,
          block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank (from 1), id, score: each query's k best other rows by integer
    inner product, ties to the smaller id; all, if fewer.

    ``queries`` picks the query rows. Rows without an id, and vectors that are null,
    empty or hold null or non-finite components take no part; a query meets vectors
    of its own length. Rows that repeat an id are ranked each, and are never
    candidates of a query of this id. Scores beyond 2**53 raise OverflowError.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    lists = build_lists(vectors, id_col, vec_col, scale, shard_rows)
    asked = usable(vectors.filter(queries), id_col, vec_col).dropDuplicates(["id"])
    count = asked.count()
    blocks = -(-count // block_queries) or 1
    out = None
    for b in range(blocks):
        part = asked if blocks == 1 else asked.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b)
        rows = part.toPandas()                     # about block_queries rows, a few MB
        by_dim = {}
        for i, v in zip(rows["id"], rows["vec"]):
            by_dim.setdefault(len(v), ([], []))
            by_dim[len(v)][0].append(i)
            by_dim[len(v)][1].append(quantised(v, scale))
        shared = spark.sparkContext.broadcast({d: (np.array(i, np.int64), np.array(q)) for d, (i, q) in by_dim.items()})

        def run(batches, shared=shared):
            for batch in batches:
                for r in batch.to_pylist():
                    if r["dim"] not in shared.value:
                        continue
                    shard = ShardLists(r["ids"], r["dim"], r["places"], r["values"])
                    q_ids, q = shared.value[r["dim"]]
                    reach = np.abs(q).max() * np.maximum(np.abs(shard.top), np.abs(shard.bottom)).sum()
                    if reach >= 2**53:
                        raise OverflowError("scores beyond 2**53 are not exact")
                    found = list(shard_top(shard, q_ids, q, k))
                    if found:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.repeat(q_ids[[i for i, _, _ in found]], [len(c) for _, c, _ in found])),
                             pa.array(np.concatenate([c for _, c, _ in found])),
                             pa.array(np.concatenate([s for _, _, s in found]).astype(np.int64))],
                            names=["query_id", "id", "score"])

        found = lists.mapInArrow(run, "query_id long, id long, score long")
        out = found if out is None else out.union(found)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "id", "score")
