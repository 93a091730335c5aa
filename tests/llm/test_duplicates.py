"""Substring deduplication and the Jaccard join against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamina.llm import paritysketch, substrings
from lamina.llm.shingles import shingle_sets
from lamina.llm.suffixsort import BlindTrie, equal_runs
from lamina.llm.common import text_chunks
from tests.llm.helpers import MESSY, frame, shingles


def test_blind_trie_orders():
    rng = random.Random(1)
    for _ in range(50):
        some = list({bytes(rng.choice(b"ab") for _ in range(20)) for _ in range(rng.randrange(1, 40))})
        trie = BlindTrie(some[0])
        for s in some[1:] + some[:3]:
            trie.insert(s)
        assert list(trie.ordered()) == sorted(some)


def test_deep_shallow_sort():
    rng = random.Random(2)
    text = bytes(rng.choice(b"ab") for _ in range(3000)) + b"long common prefix, " * 20
    starts = np.arange(len(text) - 40)
    group = starts % 2
    for shallow in (0, 8, 32):
        at, cls = equal_runs(text, starts, 40, group, shallow)
        want = {}
        for s in starts.tolist():
            want.setdefault((s % 2, text[s:s + 40]), []).append(s)
        got = {}
        for a, c in zip(at.tolist(), cls.tolist()):
            got.setdefault(c, []).append(int(starts[a]))
        assert sorted(map(sorted, got.values())) == sorted(v for v in want.values() if len(v) > 1)
        order = [(s % 2, text[s:s + 40]) for s in at.tolist()]
        assert order == sorted(order)


def brute_cut(rows, length):
    """Rows in order of (id, nulls first); strings by where they first start."""
    seen, out = {}, []
    for i, text in rows:
        b = (text or "").encode()
        covered = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if w in seen:
                covered[p:p + length] = True
            else:
                seen[w] = (i, p)
        out.append((i, len(b), int(covered.sum()), bytes(np.frombuffer(b, np.uint8)[~covered])))
    return out


def repeats(seed, n):
    rng = random.Random(seed)
    shared = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(30, 160))) for _ in range(5)]
    rows = []
    for i in range(n):
        parts = [rng.choice(shared) if rng.random() < 0.6 else "".join(rng.choice("xyzÜ") for _ in range(rng.randrange(60)))
                 for _ in range(rng.randrange(6))]
        rows.append((i * 7 - 20, "".join(parts)))
    rows += [(1000, "a" * 500), (1001, "ab" * 300), (1002, None), (1003, ""), (1004, rows[3][1]), (1005, rows[3][1])]
    return rows


@pytest.mark.parametrize("hot_in_task,hot", [(256, 20_000), (2, 4), (10_000, 1)])
def test_substrings(spark, hot_in_task, hot):
    rows = repeats(hot, 40)
    df = frame(spark, rows).repartition(3)
    got = substrings.dedup(df, 48, hot_in_task=hot_in_task, hot=hot).collect()
    have = {r.doc_id: (r.n_bytes, sum(s.end - s.start for s in r.spans), bytes(r.kept)) for r in got}
    assert have == {i: (n, removed, kept) for i, n, removed, kept in brute_cut(sorted(rows), 48)}
    assert all(a.end < b.start for r in got for a, b in zip(r.spans, r.spans[1:]))


def test_substrings_of_a_long_text_in_steps(spark, monkeypatch):
    rng = random.Random(4)
    unit = "".join(rng.choice("abcdefgh") for _ in range(300))
    text = unit + "".join(rng.choice("ijkl") for _ in range(5000)) + unit + "z" + unit[:150]
    data = np.frombuffer(text.encode(), np.uint8)
    offsets = np.array([0, len(text)])
    whole = substrings.anchors(data, offsets, 100)
    monkeypatch.setattr(substrings, "STEP", 1000)
    steps = substrings.anchors(data, offsets, 100)
    assert set(whole[1]) == set(steps[1])
    for pos, omin, omax in ((whole[1], whole[2], whole[3]), (steps[1], steps[2], steps[3])):
        starts = [p - o for p, a, b in zip(pos, omin, omax) for o in range(a, b + 1)]
        assert sorted(starts) == list(range(len(text) - 99))
    r = substrings.dedup(frame(spark, [(1, text)])).first()
    assert (r.doc_id, r.n_bytes, bytes(r.kept)) == (1, len(text), brute_cut([(1, text)], 100)[0][3])


def test_substrings_messy(spark):
    got = substrings.dedup(frame(spark, MESSY), 40).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in MESSY)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].n_bytes == by[2][0].n_bytes == 0 and bytes(by[5][0].kept) == "Zwei Wörter".encode()
    # equal rows are one document; a copy under a larger id goes
    assert bytes(by[None][0].kept) == bytes(by[None][1].kept) == MESSY[0][1].encode()
    assert sorted(r.n_bytes - len(r.kept) for r in by[9])[1:] == [len(MESSY[10][1])] * 2
    assert substrings.dedup(frame(spark, MESSY).limit(0)).count() == 0


# --- the join --------------------------------------------------------------------

def brute_join(rows, threshold=85):
    sets = [(i, frozenset(shingles(t))) for i, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, (i, s) in enumerate(sets):
        for y, (j, t) in enumerate(sets[:x]):
            if i is not None and j is not None and s and t and 100 * len(s & t) >= threshold * len(s | t):
                parent[root(x)] = root(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            least[root(x)] = min(least.get(root(x), i), i)
    return Counter((i, len(s), least[root(x)] if i is not None else None) for x, (i, s) in enumerate(sets))


def families(seed, n):
    """Chains of near copies around the threshold, boilerplate, and small sets."""
    rng = random.Random(seed)
    bag = [f"w{i}" for i in range(300)]
    board = [rng.choice(bag) for _ in range(25)]
    rows = []
    for _ in range(n):
        w = [rng.choice(bag) for _ in range(rng.choice([3, 6, 12, 25, 60, 150]))]
        if rng.random() < 0.4:
            w += board
        for _ in range(rng.randrange(1, 7)):
            rows.append((len(rows) * 3, " ".join(w)))
            w = list(w)
            for _ in range(rng.randrange(0, 1 + len(w) // 40)):
                w[rng.randrange(len(w))] = rng.choice(bag)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [512, 3])
def test_join(spark, block, monkeypatch):
    monkeypatch.setattr(paritysketch, "BLOCK", block)
    monkeypatch.setattr(paritysketch.shared_keys, "__defaults__", (block,))
    rows = families(block, 40)
    got = Counter(tuple(r) for r in paritysketch.join(frame(spark, rows).repartition(4)).select(
        "doc_id", "n_shingles", "component_id").collect())
    assert got == brute_join(rows)


def test_join_messy(spark):
    got = Counter(tuple(r) for r in paritysketch.join(frame(spark, MESSY)).select(
        "doc_id", "n_shingles", "component_id").collect())
    assert got == brute_join(MESSY)
    assert paritysketch.join(frame(spark, MESSY).limit(0)).count() == 0


def test_sketch_and_pieces_lose_no_pair():
    rng = np.random.default_rng(8)
    for _ in range(300):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = a.copy()
        for _ in range(int(rng.integers(0, 1 + n // 8))):
            if rng.random() < 0.5 and len(b) > 1:
                b = np.delete(b, rng.integers(len(b)))
            else:
                b = np.unique(np.append(b, rng.integers(0, 2**63, 1).astype(np.uint64)))
        both = len(np.intersect1d(a, b))
        x, y = paritysketch.sketch(a, 85), paritysketch.sketch(b, 85)
        both_ = paritysketch.Sketches([x, y], np.array([len(a), len(b)]), 85)
        words = min(len(x), len(y)) // 8
        hamming = np.bitwise_count(both_._at(np.array([0]), len(x) // 8, words) ^ both_._at(np.array([1]), len(y) // 8, words)).sum()
        assert hamming <= len(a) + len(b) - 2 * both
        if 100 * both >= 85 * (len(a) + len(b) - both):
            assert both_.near(np.array([0]), np.array([1]))[0]
        if 100 * both >= 85 * (len(a) + len(b) - both) and len(np.setxor1d(a, b)):
            assert len(np.intersect1d(paritysketch.keys_of(a, 85), paritysketch.keys_of(b, 85)))


def test_one_key_of_equal_groups(spark):
    rows = [(k, c, 0) for k, group in {1: (7, 8), 2: (7, 8), 3: (7, 8, 9), 4: (8, 9), 5: (7, 8, 9)}.items() for c in group]
    got = paritysketch.distinct_groups(spark.createDataFrame(rows, "key long, class long, block int")).collect()
    assert sorted((r.key, r["class"]) for r in got) == [(1, 7), (1, 8), (3, 7), (3, 8), (3, 9), (4, 8), (4, 9)]


def test_classes_that_a_followed_leader_rules_out_are_closed():
    """Whatever qualifies with a class that another leads is led too, or open; far ones aren't."""
    import pyarrow as pa

    rng = np.random.default_rng(5)
    draw = lambda n: np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
    closed = 0
    for _ in range(30):
        base = draw(int(rng.integers(20, 300)))
        sets = [draw(int(rng.integers(20, 400))) for _ in range(6)]
        for _ in range(12):
            base = np.unique(np.append(rng.permutation(base)[len(base) // 14:], draw(int(rng.integers(0, 2 + len(base) // 7)))))
            sets.append(base)
        table = pa.table({"key": np.ones(len(sets), np.int64), "block": np.zeros(len(sets), np.int64),
                          "class": np.arange(len(sets)), "n_shingles": np.array([len(s) for s in sets]),
                          "sketch": [paritysketch.sketch(s, 80) for s in sets]})
        got = {r["class"]: r for r in paritysketch._lead(table, 80).to_pylist()}
        for x, s in enumerate(sets):
            for y, u in enumerate(sets):
                both = len(np.intersect1d(s, u))
                # y has a leader, which isn't x; x and y qualify, and no leader was compared with the other
                if (x != y and got[y]["leader"] not in (x, y) and got[x]["leader"] == x
                        and 100 * both >= 80 * (len(s) + len(u) - both)):
                    head = got[y]["leader"]
                    assert got[x]["open"] or (len(s), x) < (len(sets[head]), head)
        closed += sum(not r["open"] and r["leader"] == c for c, r in got.items() if c < 6)
    assert closed > 30


def test_a_write_leaves_no_shuffle_files(spark):
    import time

    from lamina.llm.common import write_and_read

    def held():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, set_to = held(), spark.conf.get(key, None)
    grouped = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert len(write_and_read(grouped, "tidy").collect()) == 7
    assert spark.conf.get(key, None) == set_to
    own = lambda: {f for f in held() - before if f.endswith(".data")}
    for _ in range(50):
        if not own():
            break
        time.sleep(0.1)
    assert not own()


def test_shingles_are_those_of_words():
    import pyarrow as pa

    texts = [t for _, t in MESSY] + ["a b c d", "A b C d e", "x", "x y z"]
    got = [len(s) for c in text_chunks(pa.array(texts), 100) for s in shingle_sets(c)]
    assert got == [len(shingles(t)) for t in texts]
