"""Sharding by jump consistent hashing (Lamping and Veach 2014).

A key seeds a linear congruential generator, whose draws are the shard counts at
which the key moves: it stays where its last move below the shard count took it.
No ring or table is held. When shards are appended, a key either stays or moves
into one of the new shards, and about n / (n + 1) of the keys stay when one is added
to n.

Everything is a built-in expression: the generator's 64-bit product is done in
32-bit halves, so that no step overflows a long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.common import write_and_read
from lamina.plans.joins import sized_broadcast

#: The generator's multiplier, a fixed value of the published algorithm.
MULTIPLIER = 2862933555777941757
#: Moves that every key may take; one with more goes on in a branch of its own.
USUAL_MOVES = 64

_LOW = 0xFFFFFFFF
_M_HIGH, _M_LOW = MULTIPLIER >> 32, MULTIPLIER & _LOW
_M_LOW1, _M_LOW0 = _M_LOW >> 16, _M_LOW & 0xFFFF


def key_halves(key: Column) -> tuple[Column, Column]:
    """The 64-bit seed of a key as two unsigned halves: the first 16 hex digits of the
    md5 of its text. A null key is the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    half = lambda at: F.conv(F.substring(digest, at, 8), 16, 10).cast("long")
    return half(1), half(9)


def _next(high: Column, low: Column) -> tuple[Column, Column]:
    """seed * MULTIPLIER + 1 modulo 2**64, on halves."""
    middle = low * _M_LOW1
    bottom = low * _M_LOW0 + 1 + F.shiftleft(middle.bitwiseAND(0xFFFF), 16)
    top = (F.shiftright(bottom, 32) + F.shiftright(middle, 16) + low * _M_HIGH
           + high * _M_LOW0 + F.shiftleft((high * _M_LOW1).bitwiseAND(0xFFFF), 16))
    return top.bitwiseAND(_LOW), bottom.bitwiseAND(_LOW)


def _walk(state: Column, moves: Column, shards: int) -> Column:
    """Up to so many moves; ``at`` is where the key is, ``to`` where it goes next."""
    def move(s: Column, _: Column) -> Column:
        high, low = _next(s["high"], s["low"])
        to = F.floor((s["to"] + 1).cast("double") * (F.lit(2147483648.0) / (F.shiftright(high, 1) + 1).cast("double")))
        taken = F.struct(high.alias("high"), low.alias("low"), s["to"].alias("at"), to.cast("long").alias("to"))
        return F.when(s["to"] < shards, taken).otherwise(s)

    return F.aggregate(moves, state, move)


def jump_shard(key: Column, shards: int) -> Column:
    """The shard (0 to shards - 1) of a key of any type that casts to a string."""
    if shards < 1:
        raise ValueError("there must be a shard")
    high, low = key_halves(key)
    start = F.struct(high.alias("high"), low.alias("low"), F.lit(-1).cast("long").alias("at"),
                     F.lit(0).cast("long").alias("to"))
    # the number of moves grows with the logarithm of the shards, but each is one at least
    walked = _walk(start, F.sequence(F.lit(1), F.lit(min(shards, USUAL_MOVES))), shards)
    if shards > USUAL_MOVES:
        rest = F.sequence(F.lit(1), F.lit(shards))
        walked = F.transform(F.array(walked), lambda s: F.when(s["to"] < shards, _walk(s, rest, shards)).otherwise(s))[0]
    return walked["at"].cast("int")


def assign(docs: DataFrame, shards: int, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the key column, size (UTF-8 bytes of the text plus 8),
    text_crc32, shard, slot (its place in the shard, from 0 without gaps) and
    grown_shard (its shard when one more is added).

    Slots follow the key, nulls first; rows that share a key have the same shard and
    follow the text's crc32. A null text has no bytes. No documents: no rows. Other columns aren't read.

    The texts are read once and not shuffled. Their narrow rows are sorted by ranges
    of (shard, key, crc32, place), which splits the rows of a hot key, too; a slot is the
    place in the range behind the rows of the shard in earlier ranges.
    """
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    key = F.col(key_col)
    narrow = docs.select(
        key, (F.octet_length(raw) + 8).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        jump_shard(key, shards).alias("shard"), jump_shard(key, shards + 1).alias("grown_shard"),
        F.monotonically_increasing_id().alias("__place"))
    order = ["shard", F.asc_nulls_first(key_col), "text_crc32", "__place"]
    dealt = write_and_read(narrow, "shard-keys").repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = write_and_read(dealt.withColumn("__at", F.monotonically_increasing_id()), "shard-ranges")
    dealt = dealt.withColumn("__range", F.shiftright("__at", 33))
    # one row per range and shard: as many as there are ranges, and a few more
    counts = dealt.groupBy("shard", "__range").agg(F.count("*").alias("n"), F.min("__at").alias("first"))
    before = Window.partitionBy("shard").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "__range", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return dealt.join(sized_broadcast(starts, derived=True), ["shard", "__range"]).select(
        key_col, "size", "text_crc32", "shard", (F.col("__at") + F.col("shift")).alias("slot"), "grown_shard")


def write(docs: DataFrame, shards: int, path: str, key_col: str = "doc_id", fmt: str = "parquet") -> None:
    """Write whole rows to ``path/shard=K``. Rows are rebalanced by shard: adaptive
    execution cuts a shard into files of the advisory partition size, so that a
    shard of any size is no single task."""
    if "shard" in docs.columns:
        raise ValueError("the documents have a column named shard")
    keyed = docs.withColumn("shard", jump_shard(F.col(key_col), shards))
    keyed.hint("rebalance", "shard").write.partitionBy("shard").format(fmt).save(path)
