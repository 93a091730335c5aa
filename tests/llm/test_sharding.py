"""Jump consistent hashing against the published loop."""

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lamina.llm import sharding
from tests.llm.helpers import MESSY, frame


def seed(key):
    return int(hashlib.md5(("" if key is None else str(key)).encode()).hexdigest()[:16], 16)


def jump(key, shards):
    at, to = -1, 0
    while to < shards:
        at = to
        key = (key * sharding.MULTIPLIER + 1) % 2**64
        to = int(float(at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


@pytest.mark.parametrize("shards", [1, 2, 24, 65, 5000])
def test_jump(spark, shards):
    rows = spark.range(500).select("id", sharding.jump_shard(F.col("id"), shards).alias("s")).collect()
    assert [r.s for r in rows] == [jump(seed(r.id), shards) for r in rows]


def test_many_moves(spark, monkeypatch):
    """A key with more moves than usual goes on."""
    monkeypatch.setattr(sharding, "USUAL_MOVES", 2)
    rows = spark.range(300).select("id", sharding.jump_shard(F.col("id"), 40).alias("s")).collect()
    assert [r.s for r in rows] == [jump(seed(r.id), 40) for r in rows]


def test_appended_shards_take_rows_only_into_themselves(spark):
    ids = spark.range(4000)
    rows = ids.select(*[sharding.jump_shard(F.col("id"), n).alias(f"n{n}") for n in (10, 11, 15)]).collect()
    assert all(r.n11 in (r.n10, 10) and (r.n15 == r.n10 or r.n15 >= 10) for r in rows)
    moved = sum(r.n11 != r.n10 for r in rows)
    assert 4000 / 11 * 0.8 < moved < 4000 / 11 * 1.2
    sizes = Counter(r.n10 for r in rows)
    assert min(sizes.values()) > 300 and max(sizes.values()) < 500


def check(rows, docs, shards):
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), jump(seed(i), shards),
                    jump(seed(i), shards + 1)) for i, t in docs)
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.shard, r.grown_shard) for r in rows) == want
    for s in range(shards):
        own = sorted((r.slot, -10**9 if r.doc_id is None else r.doc_id) for r in rows if r.shard == s)
        assert [slot for slot, _ in own] == list(range(len(own)))
        assert [i for _, i in own] == sorted(i for _, i in own)


def test_assign_odd_rows(spark):
    check(sharding.assign(frame(spark, MESSY), 3).collect(), MESSY, 3)
    assert sharding.assign(frame(spark, MESSY).limit(0), 3).collect() == []
    with pytest.raises(ValueError):
        sharding.assign(frame(spark, MESSY), 0)


def test_hot_key(spark):
    """A third of all rows under one key: their slots come from several ranges."""
    docs = [(7 if i % 3 == 0 else i, f"text {i % 50}") for i in range(3000)]
    check(sharding.assign(frame(spark, docs).repartition(7), 5).collect(), docs, 5)


def test_write(spark, tmp_path):
    docs = frame(spark, MESSY)
    path = str(tmp_path / "shards")
    sharding.write(docs, 4, path)
    back = spark.read.schema("shard int, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)).parquet(path)
    assert Counter((r.doc_id, r.text, r.shard) for r in back.collect()) == Counter((i, t, jump(seed(i), 4)) for i, t in MESSY)
    with pytest.raises(ValueError):
        sharding.write(docs.withColumn("shard", F.lit(1)), 4, path + "2")
