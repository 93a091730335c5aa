"""Decontamination and exact top-k against brute force."""

import random

import numpy as np
from pyspark.sql import functions as F

from lamina.llm import decontam, topk
from tests.llm.helpers import MESSY, frame, words13


def brute_hits(docs, items, window):
    phrases = {}
    for item_id, text in items:
        w = words13(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            phrases.setdefault(tuple(w[i:i + window]), set()).add(item_id)
    out = []
    for doc_id, text in docs:
        w, hit, found = words13(text), set(), set()
        for p, own in phrases.items():
            for i in range(len(w) - len(p) + 1):
                if tuple(w[i:i + len(p)]) == p:
                    hit.update(range(i, i + len(p)))
                    found |= own - {None}
        out.append((doc_id, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    bag = ["the", "of", "and", "Rare", "über", "x1", "y2", "z3"]
    docs = [(i, " ".join(rng.choice(bag) for _ in range(rng.randrange(40)))) for i in range(n)]
    items = [(i, " ".join(rng.choice(docs)[1].split()[2:9])) for i in range(12)]
    return docs + MESSY, [*items, (3, "the of"), (None, "rare rare x1"), (50, None), (51, ""), (52, "the same text again")]


def collected(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in df.collect()), key=str)


def test_hits(spark):
    docs, items = corpus(1, 60)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    want = brute_hits(docs, items, 5)
    assert collected(decontam.hits(frame(spark, docs), bench, window=5, shard_words=50)) == want
    # in many blocks, against an index of all terms
    assert collected(decontam.hits(frame(spark, docs), bench, window=5, block_words=30)) == want


def test_hits_of_empty_tables(spark):
    docs, items = corpus(2, 5)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert decontam.hits(frame(spark, docs).limit(0), bench).count() == 0
    none = decontam.hits(frame(spark, docs), bench.limit(0)).collect()
    assert len(none) == len(docs) and all(r.n_hit == 0 and r["items"] == [] for r in none)


def test_proximity():
    doc = "a b q c d".split() + [None] + "a c".split()     # two documents, a gap between
    lists = {}
    for i, w in enumerate(doc):
        if w:
            lists.setdefault(w.encode(), []).append(i)
    lists = {k: np.array(v) for k, v in lists.items()}
    first = np.array([0, 6, 9])
    assert decontam.occurrences((b"b", b"c"), lists).tolist() == []
    assert decontam.occurrences((b"b", b"c"), lists, 1, first).tolist() == [1]
    assert decontam.occurrences((b"d", b"a"), lists, 3, first).tolist() == []      # not over a document's end
    assert decontam.occurrences((b"a", b"c"), lists, 2, first).tolist() == [0, 6]


def test_contaminated_rule(spark):
    df = spark.createDataFrame([(0, 0), (0, 10), (1, 20), (1, 21), (5, 100)], "n_hit long, n_words long")
    assert [r[0] for r in df.select(decontam.contaminated()).collect()] == [False, False, True, False, True]


def brute_top(rows, k):
    ok = [(i, np.floor(256 * np.array(v, float)).astype(int)) for i, v in rows
          if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, x in ok:
        if q % 3 == 0:
            s = sorted((-int(x @ y), i) for i, y in ok if i != q and len(y) == len(x))[:k]
            out |= {(q, r + 1, i, -d) for r, (d, i) in enumerate(s)}
    return out


def test_top_k(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).round(1).tolist()) for i in range(150)]
    rows += [(150 + i, rows[7][1]) for i in range(40)]                # a large group of equal vectors: ties
    rows += [(300, None), (301, []), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (303, [float("nan")] * 6),
             (306, [float("inf")] * 6), (None, [0.5] * 6), (309, [0.1, 0.2]), (312, [0.3, 0.1]), (315, [2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]              # as floats
    df = df.withColumn("score", F.lit("clash")).withColumn("id", F.lit(1))
    for k, shard_rows in ((5, 32), (200, 64), (1, 4096)):
        got = topk.top_k(df, F.col("vec_id") % 3 == 0, k, shard_rows=shard_rows, block_queries=20)
        assert {(r.query_id, r["rank"], r.id, r.score) for r in got.collect()} == brute_top(rows, k)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 3 == 0).count() == 0
    assert topk.top_k(df, F.lit(False)).count() == 0


def test_bounds_hold_and_stop_early():
    rng = np.random.default_rng(6)
    base = rng.normal(size=(400, 8))
    x = topk.quantised(base)
    order = np.argsort(-x, axis=0, kind="stable")
    lists = topk.ShardLists(list(range(400)), 8, order.T.astype("<i4").tobytes(),
                            np.take_along_axis(x, order, 0).T.astype("<f8").tobytes())
    q = topk.quantised(rng.normal(size=(5, 8)))
    for depth in (1, 20, 100, 200):
        lists.read_to(depth)
        low, high = lists.bounds(q)
        exact = q @ x.T
        assert (low <= exact).all() and (exact <= high).all()
    assert (low == high).all()
