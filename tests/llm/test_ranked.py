"""Ranked lexical search with ball trees against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamina.llm import balltree
from tests.llm.helpers import MESSY, frame, words13


def brute(docs, items, k):
    bags = [(i, Counter(words13(t)), len(words13(t))) for i, t in docs]
    bags = [b for b in bags if b[2]]
    n, total = len(bags), sum(b[2] for b in bags)
    out = []
    for item_id, text in items:
        terms = set(words13(text))
        df = {t: sum(t in b[1] for b in bags) for t in terms}
        w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in terms}
        scored = []
        for i, bag, size in bags:
            m = 100 - 50 + 50 * size * n // total
            s = sum(w[t] * (10**9 * bag[t] // (1000 * bag[t] + 20 * m)) for t in terms if t in bag)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item_id, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    bag = ["the", "of", "and", "Rare", "über", *(f"w{i}" for i in range(60))]
    weight = [40, 30, 20, *[3] * 62]
    docs = [(i, " ".join(rng.choices(bag, weight, k=rng.randrange(1, 60)))) for i in range(n)]
    docs += [(n + i, docs[4][1]) for i in range(40)]                 # ties
    items = [(i, " ".join(rng.choice(docs)[1].split()[:9])) for i in range(12)]
    return docs + MESSY, [*items, (3, "the of The"), (None, "rare w1 x"), (50, None), (51, ""), (52, "absent"), (3, "the of")]


def ranked(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("leaf,first,size", [(4, 2, 50), (16, 1, 30), (1, 0, 1000)])
def test_rank(spark, leaf, first, size):
    docs, items = corpus(leaf, 250)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    got = balltree.rank(frame(spark, docs), bench, k=7, leaf_docs=leaf, first_shards=first, shard_docs=size)
    assert ranked(got) == brute(docs, items, 7)


def test_rank_in_blocks_of_queries_and_all_if_fewer(spark):
    docs, items = corpus(8, 60)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = balltree.rank(frame(spark, docs), bench, k=10_000, block_words=40)
    assert ranked(got) == brute(docs, items, 10_000)


def test_empty_tables(spark):
    docs, items = corpus(2, 5)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert balltree.rank(frame(spark, docs).limit(0), bench).collect() == []
    assert balltree.rank(frame(spark, docs), bench.limit(0)).collect() == []
    assert balltree.rank(frame(spark, [(1, None), (2, "  ")]), bench).collect() == []


def test_one_term_everywhere(spark):
    """Equal scores over more documents than are asked for."""
    docs = [(i, "same words here") for i in range(300)] + [(900, "same words here and more")]
    bench = spark.createDataFrame([(1, "same and")], "item_id long, text string")
    got = balltree.rank(frame(spark, docs), bench, k=50, shard_docs=40, first_shards=2)
    assert ranked(got) == brute(docs, [(1, "same and")], 50)


def clustered(rng, groups, rows):
    """Documents of groups with terms of their own and some that all share."""
    out = []
    for g in range(groups):
        for _ in range(rows):
            own = rng.choice(np.arange(g * 20, g * 20 + 20), 8, replace=False)
            shared = groups * 20 + rng.choice(10, 4, replace=False)
            out.append(np.sort(np.concatenate((own, shared))))
    rng.shuffle(out)
    return out


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(5)
    rows = clustered(rng, 12, 100)
    n_terms = 12 * 20 + 10
    df = np.bincount(np.concatenate(rows), minlength=n_terms)
    weights = np.array([math.floor(1000 * math.log((2 * len(rows) + 2) / (2 * f + 1))) for f in df])
    corpus_ = balltree.Corpus(len(rows), sum(map(len, rows)), weights)
    row = {"doc_ids": list(range(len(rows))), "lengths": [len(r) for r in rows],
           "starts": np.concatenate(([0], np.cumsum([len(r) for r in rows]))).tolist(),
           "terms": np.concatenate(rows).tolist(), "counts": rng.integers(1, 4, sum(map(len, rows))).tolist()}
    shard = balltree.Shard(row, corpus_, leaf_docs=16)
    queries = [np.sort(rng.choice(np.arange(g * 20, g * 20 + 20), 6, replace=False)) for g in range(12)]
    bounds = shard.bounds(queries, weights)
    leaves = [i for i, c in enumerate(shard.tree.children) if c is None]
    for i, q in enumerate(queries):
        weight = np.where(np.isin(shard.used, q), weights[shard.used], 0)
        for leaf in leaves:
            assert shard.score(leaf, weight).max() <= bounds[i, leaf]
    read = [r for _, _, _, r in shard.search(queries, weights, 10, np.zeros(len(queries)))]
    assert max(read) < len(leaves) / 2, "subtrees are pruned"
    children = {c for pair in shard.tree.children if pair for c in pair}
    assert len(children) == len(shard.tree.first) - 1
    assert sorted(shard.tree.order.tolist()) == list(range(len(rows)))
