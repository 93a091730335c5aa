"""N-gram Jaccard join with parity sketches.

A document's set is its distinct word shingles, as 64-bit hashes. Documents with
equal sets are a class; classes are joined, never their members.

* ``sketch``: each shingle flips one bit. Two sketches' Hamming distance never
  exceeds the sets' symmetric difference.
* Sets of sizes a and b with Jaccard t or more differ in at most
  D = (1 - t) / (1 + t) * (a + b) shingles. Size bands are as wide as t allows: a
  pair lies in one band or in two neighbours. A band's sketches fall into
  D + 1 + spare pieces, so that at least spare + 1 pieces of a qualifying pair are
  equal. A piece's key is the XOR of its shingles' 64-bit codes.
* Pieces of few shingles say little and are common: a set leaves them out, unless
  it has more of them than ``spare`` - then a pair may share no others, and both
  sets have that many, so that both put in all.

Candidates share a key; of keys that the same classes share, one counts. In each key's group, in blocks of bounded size, sketches
rule out pairs; each remaining class is verified against one leader. Then, while
verified links have left components of a group apart, one near pair of each is
verified, and at last every pair of theirs, unless longer sketches rule it out. Only
components are computed: pairs within one aren't tested. No link that connects two
components is lost, and a group of near copies makes about as many pairs as it has
members.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import mix64, ship_package, text_chunks, write_and_read
from lamina.llm.graph import components, merged
from lamina.llm.shingles import SHINGLE, shingle_sets

#: Jaccard 85 / 100, as integers.
THRESHOLD = 85
#: Pieces of at most so many shingles are left out where enough others remain.
FEW = 1
#: Members of a key's group that are compared in one go.
BLOCK = 512
#: Bits of a sketch for each shingle that a qualifying set can differ by: for the leaders of
#: every key, and for what links have left apart, most of which is just too far apart.
COARSE, FINE = 4, 16
#: Rounds in which a component has one pair verified, before all that are left.
CHOOSING_ROUNDS = 1
#: Keys that a task collects before it hands them on.
FLUSH_KEYS = 1 << 19


@functools.lru_cache(maxsize=4)
def bands(threshold: int, most: int = 1 << 40) -> np.ndarray:
    """Smallest size of each band. The sizes that a set of band j can pair with as
    the smaller one lie in bands j and j + 1."""
    out = [1]
    while out[-1] < most:
        out.append(max(out[-1] + 1, (out[-1] - 1) * 100 // threshold + 1))
    return np.array(out, np.int64)


def most_apart(a, b, threshold: int):
    """Largest symmetric difference of qualifying sets of these sizes."""
    return (100 - threshold) * (a + b) // (100 + threshold)


def pieces(band: int, threshold: int) -> tuple[int, int]:
    """(pieces, spare) of a band; no pieces where only equal sets qualify."""
    a = int(bands(threshold)[band + 1]) - 1
    apart = most_apart(a, a * 100 // threshold, threshold)
    if apart == 0:
        return 0, 0
    spare = 1 + (apart + 1) // 12
    return apart + 1 + spare, spare


_CODE, _CHECK, _BIT, _PIECE = (np.uint64(x) for x in (
    0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3))


def identity(s: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit fingerprints of a set, as signed integers."""
    one = np.bitwise_xor.reduce(mix64(s * _CODE)) + np.uint64(len(s))
    two = mix64(s ^ _CHECK).sum(dtype=np.uint64)
    return int(one.astype(np.int64)), int(two.astype(np.int64))


def sketch(s: np.ndarray, threshold: int, times: int = COARSE) -> bytes:
    """Parity sketch: a power of two of bits, at least ``times`` what a
    qualifying set can differ by. Folding a longer one by XOR gives a shorter one's bits."""
    apart = int(most_apart(len(s), len(s) * 100 // threshold, threshold))
    bits = 64
    while bits < times * apart:
        bits *= 2
    at = (mix64(s ^ _BIT) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


class Sketches:
    """Sketches of different lengths, compared many pairs at a time."""

    def __init__(self, raw: list[bytes], sizes: np.ndarray, threshold: int):
        self.n, self.threshold = sizes, threshold
        self.words = np.array([len(x) // 8 for x in raw], np.int64)
        self.place = np.zeros(len(raw), np.int64)
        self.matrix = {}
        for w in np.unique(self.words).tolist():
            rows = np.flatnonzero(self.words == w)
            self.place[rows] = np.arange(len(rows))
            self.matrix[w] = np.frombuffer(b"".join(raw[i] for i in rows), np.uint64).reshape(len(rows), w)

    def _at(self, rows: np.ndarray, words: int, to: int) -> np.ndarray:
        x = self.matrix[words][self.place[rows]]
        while x.shape[1] > to:
            half = x.shape[1] // 2
            x = x[:, :half] ^ x[:, half:]
        return x

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether sizes and sketches allow the pairs (i, j) to qualify."""
        return self.margins(i, j) >= 0

    def margins(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How much farther apart the sketches of the pairs (i, j) might be; negative where
        they or the sizes rule a pair out."""
        small, large = np.minimum(self.n[i], self.n[j]), np.maximum(self.n[i], self.n[j])
        fits = 100 * small >= self.threshold * large
        out = np.full(len(i), -1, np.int64)
        at = np.flatnonzero(fits)
        out[at] = most_apart(small[at], large[at], self.threshold) - self.distances(i[at], j[at])
        return out

    def distances(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Hamming distances of the pairs (i, j), each in the shorter one's bits."""
        out = np.zeros(len(i), np.int64)
        for a in self.matrix:
            for b in self.matrix:
                at = np.flatnonzero((self.words[i] == a) & (self.words[j] == b))
                for part in np.array_split(at, len(at) * max(a, b) // (1 << 20) + 1):
                    x = self._at(i[part], a, min(a, b)) ^ self._at(j[part], b, min(a, b))
                    out[part] = np.bitwise_count(x).sum(axis=1, dtype=np.int64)
        return out


def keys_of(s: np.ndarray, threshold: int, few: int = FEW) -> np.ndarray:
    """Keys of a set's pieces, in its own band and as the larger set of the band below."""
    starts = bands(threshold)
    home = int(np.searchsorted(starts, len(s), side="right")) - 1
    out = []
    for band in (home, home - 1):
        if band < 0:
            continue
        m, spare = pieces(band, threshold)
        if m == 0:
            continue
        at = (mix64(s ^ _PIECE) % np.uint64(m)).astype(np.int64)
        count = np.bincount(at, minlength=m)
        value = np.zeros(m, np.uint64)
        np.bitwise_xor.at(value, at, mix64(s * _CODE))
        key = mix64(value ^ mix64(np.arange(m, dtype=np.uint64) + np.uint64(band << 32)))
        rich = count > few
        out.append(key[rich] if m - rich.sum() <= spare else key)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


# --- the tables --------------------------------------------------------------------

def document_sets(docs: DataFrame, id_col: str, text_col: str, length: int, threshold: int) -> DataFrame:
    """doc_id, n_shingles, class, check, sketch, fine (a longer sketch); the last four null
    without shingles or id."""
    ship_package(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("class", pa.int64()),
                        ("check", pa.int64()), ("sketch", pa.binary()), ("fine", pa.binary())])

    def run(batches):
        for batch in batches:
            for chunk in text_chunks(batch.column(1)):
                ids = batch.column(0)[chunk.first:chunk.first + chunk.rows].to_pylist()
                n, one, two, bits, fine = [], [], [], [], []
                for doc_id, s in zip(ids, shingle_sets(chunk, length)):
                    n.append(len(s))
                    a, b = identity(s) if len(s) and doc_id is not None else (None, None)
                    one.append(a)
                    two.append(b)
                    bits.append(sketch(s, threshold) if a is not None else None)
                    fine.append(sketch(s, threshold, FINE) if a is not None else None)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip((ids, n, one, two, bits, fine), schema.types)], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_shingles long, class long, check long, sketch binary, fine binary")


def shared_keys(docs: DataFrame, id_col: str, text_col: str, length: int, threshold: int,
                block: int = BLOCK) -> DataFrame:
    """(key, class, block) of the keys that two or more classes have. A class's
    repeated sets give their keys once a task; keys and classes travel as packed
    arrays, one row per bucket of keys."""
    spark = docs.sparkSession
    ship_package(spark)
    buckets = _buckets(docs)

    def emit(batches):
        done: set[int] = set()
        keys, classes, held = [], [], 0

        def flush():
            k, c = np.concatenate(keys), np.concatenate(classes)
            bucket = (k % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((k, bucket))
            k, c, bucket = k[order], c[order], bucket[order]
            found, first = np.unique(bucket, return_index=True)
            ends = np.append(first[1:], len(bucket))
            return pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int64()),
                 pa.array([k[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
                 pa.array([c[a:b].tobytes() for a, b in zip(first, ends)], pa.binary())],
                names=["bucket", "keys", "classes"])

        for batch in batches:
            for chunk in text_chunks(batch.column(1)):
                ids = batch.column(0)[chunk.first:chunk.first + chunk.rows]
                for doc_id, s in zip(ids, shingle_sets(chunk, length)):
                    if not len(s) or not doc_id.is_valid:
                        continue
                    own, _ = identity(s)
                    if own in done:
                        continue
                    done.add(own)
                    if len(done) > 1 << 20:
                        done = {own}
                    k = keys_of(s, threshold)
                    if len(k):
                        keys.append(k)
                        classes.append(np.full(len(k), own, np.int64))
                        held += len(k)
                if held >= FLUSH_KEYS:
                    yield flush()
                    keys, classes, held = [], [], 0
        if held:
            yield flush()

    def meet(table: pa.Table) -> pa.Table:
        k = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint64)
        c = np.frombuffer(b"".join(table.column("classes").to_pylist()), np.int64)
        order = np.lexsort((c, k))
        k, c = k[order], c[order]
        new = np.append(True, (k[1:] != k[:-1]) | (c[1:] != c[:-1]))
        k, c = k[new], c[new]
        group = np.cumsum(np.append(True, k[1:] != k[:-1])) - 1
        size = np.bincount(group)
        place = np.arange(len(k)) - np.repeat(np.cumsum(size) - size, size)
        keep = size[group] > 1
        return pa.table([k[keep].astype(np.int64), c[keep], (place[keep] // block).astype(np.int32)], schema=out)

    out = pa.schema([("key", pa.int64()), ("class", pa.int64()), ("block", pa.int32())])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    met = (rows.mapInArrow(emit, "bucket long, keys binary, classes binary")
           .groupBy("bucket").applyInArrow(meet, "key long, class long, block int"))
    return write_and_read(met, "shared-keys")


def distinct_groups(entries: DataFrame) -> DataFrame:
    """``entries`` of one key for each set of classes: keys that the same classes share
    make the same candidates. Sets are told apart by their size and 128 bits."""
    sets = entries.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("class")).alias("one"),
                                      F.bit_xor(F.xxhash64(F.lit(1), "class")).alias("two"))
    kept = sets.groupBy("n", "one", "two").agg(F.min("key").alias("key")).select("key")
    return write_and_read(entries.join(kept, "key", "left_semi"), "distinct-groups")


_LED = pa.schema([("key", pa.int64()), ("leader", pa.int64()), ("class", pa.int64())])
_LED_SHAPE = "key long, leader long, class long"
_LEFT = _LED.append(pa.field("open", pa.int64()))
_LEFT_SHAPE = _LED_SHAPE + ", open long"


def _table(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [np.asarray(table.column(c).combine_chunks(), np.int64) for c in names]


def _lead(table: pa.Table, threshold: int) -> pa.Table:
    """Of each class of a (key, block): its leader, or itself where no earlier leader
    is near. All groups of a bucket of keys advance together, one leader a round.

    A class is ``open`` (1) where a class that another leads may be near to it: where its
    sketch is no farther from that leader's than both together can be. Leaders are the
    smallest of those left, so that all three distances are in the leader's bits."""
    key, block, cls, n = _table(table, "key", "block", "class", "n_shingles")
    order = np.lexsort((cls, n, block, key))
    key, block, cls = key[order], block[order], cls[order]
    raw = table.column("sketch").take(pa.array(order)).to_pylist()
    sketches = Sketches(raw, n[order], threshold)
    n = sketches.n
    leader = np.full(len(key), -1, np.int64)
    open_ = np.zeros(len(key), np.int64)
    free = np.arange(len(key))
    while len(free):
        new = np.append(True, (key[free[1:]] != key[free[:-1]]) | (block[free[1:]] != block[free[:-1]]))
        head = free[np.flatnonzero(new)[np.cumsum(new) - 1]]      # the first one left of each group
        took = head == free
        h, z = head[~took], free[~took]
        apart, most = sketches.distances(h, z), n[h] * 100 // threshold
        near = (n[z] <= most) & (apart <= most_apart(n[h], n[z], threshold))
        led = np.zeros(len(key), bool)
        led[h[near]] = True
        reach = most_apart(n[h], most, threshold) + most_apart(most, n[z], threshold)
        open_[z[led[h] & (apart <= reach)]] = 1
        took[~took] = near
        leader[free[took]] = head[took]
        free = free[~took]
    return pa.table([pa.array(key), pa.array(cls[leader]), pa.array(cls), pa.array(open_)], schema=_LEFT)


def _across(table: pa.Table, threshold: int) -> pa.Table:
    """Near pairs between the leaders of two blocks of a key, or within one."""
    key, low, high, block, cls, n = _table(table, "key", "low", "high", "block", "class", "n_shingles")
    sketches = Sketches(table.column("sketch").to_pylist(), n, threshold)
    left, right, _ = _near_pairs(sketches, key, low, high, block, lambda i, j: np.ones(np.broadcast_shapes(i.shape, j.shape), bool))
    return pa.table([pa.array(key[left]), pa.array(cls[left]), pa.array(cls[right])], schema=_LED)


#: Pairs that sizes allow and sketches are then compared for, at once.
PAIRS_AT_ONCE = 1 << 18


def _near_pairs(sketches: Sketches, key, low, high, block, wanted) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows, with their margins, between the blocks ``low`` and ``high`` of a key (within one block each
    once) that are ``wanted`` and near. Sizes decide on all pairs of two blocks at once,
    sketches on many blocks' pairs at once."""
    order = np.lexsort((block, high, low, key))
    new = np.append(True, np.any([x[order][1:] != x[order][:-1] for x in (key, low, high)], axis=0))
    begin = np.flatnonzero(new)
    n, threshold = sketches.n, sketches.threshold
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def compare() -> None:
        if held:
            i, j = (np.concatenate(x) for x in zip(*held))
            held.clear()
            margin = sketches.margins(i, j)
            good = margin >= 0
            found.append((i[good], j[good], margin[good]))

    size = 0
    for a, b in zip(begin, np.append(begin[1:], len(order))):
        own = order[a:b]
        one = low[own[0]] == high[own[0]]
        first, second = own[block[own] == low[own[0]]], own[block[own] == high[own[0]]]
        rows = max(1, PAIRS_AT_ONCE // max(1, len(second)))
        for at in range(0, len(first), rows):
            i, j = first[at:at + rows, None], second[None, :]
            ok = wanted(i, j) & (100 * np.minimum(n[i], n[j]) >= threshold * np.maximum(n[i], n[j]))
            if one:
                ok &= np.arange(at, at + len(i))[:, None] < np.arange(len(second))[None, :]
            x, y = np.nonzero(ok)
            held.append((i[x, 0], second[y]))
            size += len(x)
            if size >= PAIRS_AT_ONCE:
                compare()
                size = 0
    compare()
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*found))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()


def _sets(need: DataFrame, docs: DataFrame, classes: DataFrame, length: int) -> DataFrame:
    """(class, shingles) of the classes in ``need``: one document of each is read again."""
    texts = docs.join(classes.join(need, "class").select("doc_id", F.col("class").alias("want")), "doc_id")

    def run(batches):
        for batch in batches:
            for chunk in text_chunks(batch.column(0)):
                want = batch.column(1)[chunk.first:chunk.first + chunk.rows].to_pylist()
                # of different texts with one id, the class's own counts
                got = [(w, s.tobytes()) for w, s in zip(want, shingle_sets(chunk, length))
                       if len(s) and identity(s)[0] == w]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w for w, _ in got], pa.int64()), pa.array([x for _, x in got], pa.binary())],
                    names=["class", "shingles"])

    return write_and_read(texts.select("text", "want").mapInArrow(run, "class long, shingles binary"), "sets")


def _verified(pairs: DataFrame, held: DataFrame, threshold: int) -> DataFrame:
    """The pairs whose sets qualify. A pair's first class meets its partners' sets,
    in several groups where they are many."""
    buckets = _buckets(pairs)
    salts = pairs.groupBy("a").agg((F.count("*") / BLOCK).cast("int").alias("salts"))
    partner = (pairs.join(salts, "a").join(held.withColumnRenamed("class", "b"), "b")
               .select("a", F.pmod(F.xxhash64("b"), F.col("salts") + 1).cast("int").alias("salt"), "b", "shingles"))
    own = (salts.join(held.withColumnRenamed("class", "a"), "a")
           .select("a", F.explode(F.sequence(F.lit(0), "salts")).alias("salt"),
                   F.lit(None).cast("long").alias("b"), "shingles"))

    def compare(table: pa.Table) -> pa.Table:
        a, salt = _table(table, "a", "salt")
        b, raw = table.column("b").to_pylist(), table.column("shingles").combine_chunks()
        mine, links = {}, []
        for i, other in enumerate(b):
            if other is None:
                mine[a[i], salt[i]] = np.frombuffer(raw[i].as_py(), np.uint64)
        for i, other in enumerate(b):
            if other is not None:
                s, t = mine[a[i], salt[i]], np.frombuffer(raw[i].as_py(), np.uint64)
                both = len(np.intersect1d(s, t, assume_unique=True))
                if 100 * both >= threshold * (len(s) + len(t) - both):
                    links.append((a[i], other))
        return pa.table([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    met = own.union(partner).withColumn("bucket", F.pmod(F.xxhash64("a", "salt"), F.lit(buckets)))
    return met.groupBy("bucket").applyInArrow(compare, "a long, b long").distinct()


def _buckets(df: DataFrame) -> int:
    """Groups that one Python call each handles: many a shuffle partition."""
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _first_candidates(entries: DataFrame, of: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(leaders, across, left): per block of a key's classes, each class and its leader;
    near leaders of different blocks (both key, leader, class); and the (key, class) that
    may have a link in the key besides these, all classes of a key of several blocks."""
    buckets = F.lit(_buckets(of))
    led = write_and_read(entries.join(of, "class").groupBy(F.pmod(F.xxhash64("key", "block"), buckets).alias("bucket"))
                         .applyInArrow(lambda t: _lead(t, threshold), _LEFT_SHAPE), "leaders")
    several = entries.filter("block > 0").select("key").distinct()
    heads = led.filter("leader = class").select("key", "class").join(several, "key", "left_semi")
    blocks = heads.groupBy("key").agg((F.count("*") / BLOCK).cast("int").alias("last"))
    heads = (heads.join(blocks, "key").join(of, "class")
             .withColumn("block", F.pmod(F.xxhash64("class"), F.col("last") + 1).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), "last")))
             .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")))
    across = (heads.groupBy(F.pmod(F.xxhash64("key", "low", "high"), buckets).alias("bucket"))
              .applyInArrow(lambda t: _across(t, threshold), _LED_SHAPE))
    left = led.join(several.withColumn("several", F.lit(1)), "key", "left").filter(
        "leader != class OR open = 1 OR several = 1").select("key", "class")
    return led.drop("open"), write_and_read(across, "across"), left


def _apart(table: pa.Table, threshold: int, choose: int | None) -> pa.Table:
    """Near pairs between two blocks of a key, or within one, that links haven't
    connected yet; at least one of a pair is outside the key's largest component.

    With ``choose``, of the pairs of each component of a key and two blocks one alone:
    with 0 the nearest by its sketches, else one that a hash picks."""
    key, low, high, block, cls, n, label, major, led = _table(
        table, "key", "low", "high", "block", "class", "n_shingles", "label", "major", "near")
    sketches = Sketches(table.column("sketch").to_pylist(), n, threshold)
    left, right, margin = _near_pairs(sketches, key, low, high, block, lambda i, j: (
        (label[i] != label[j]) & ((label[i] != major[i]) | (label[j] != major[j])) & ((led[i] + led[j]) > 0)))
    if choose is not None and len(left):
        pick = -margin if choose == 0 else mix64((cls[left] ^ cls[right] ^ choose).astype(np.uint64)).astype(np.int64)
        chosen = []
        for own in (left, right):
            group = key[own], low[own], high[own], label[own]
            order = np.lexsort((pick, *group))
            first = np.append(True, np.any([g[order][1:] != g[order][:-1] for g in group], axis=0))
            at = order[first]
            # the largest component needn't choose: the others choose for it
            chosen.append(at[label[own[at]] != major[own[at]]])
        chosen = np.unique(np.concatenate(chosen))
        left, right = left[chosen], right[chosen]
    x, y = cls[left], cls[right]
    pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1), axis=0)
    return pa.table([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _second_candidates(left: DataFrame, near: DataFrame, label: DataFrame, of: DataFrame,
                       threshold: int, choose: int | None = None) -> DataFrame:
    """Pairs (a, b) of classes that share a key, are still apart, and that sizes and
    sketches don't rule out; with ``choose`` one of a component's. Of two classes that no leader of the key was near to, the
    first round has compared the sketches already."""
    marked = (left
              .join(label.withColumnRenamed("node", "class"), "class", "left")
              .join(near.select("key", "class").distinct().withColumn("near", F.lit(1)), ["key", "class"], "left")
              .select("key", "class", F.coalesce("component", "class").alias("label"),
                      F.coalesce("near", F.lit(0)).alias("near")))
    marked = write_and_read(marked, "marked")
    split = (marked.groupBy("key", "label").agg(F.count("*").alias("n"), F.max("near").alias("some"))
             .groupBy("key").agg(F.count("*").alias("labels"), F.max("some").alias("some"),
                                 (F.sum("n") / BLOCK).cast("int").alias("last"),
                                 F.max_by("label", F.struct("n", "label")).alias("major"))
             .filter("labels > 1 AND some = 1").select("key", "major", "last"))
    blocks = (marked.join(split, "key").join(of, "class")
              .withColumn("block", F.pmod(F.xxhash64("class"), F.col("last") + 1).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), "last")))
              .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")))
    return (blocks.groupBy(F.pmod(F.xxhash64("key", "low", "high"), F.lit(_buckets(of))).alias("bucket"))
            .applyInArrow(lambda t: _apart(t, threshold, choose), "a long, b long").distinct())


def join(docs: DataFrame, length: int = SHINGLE, threshold: int = THRESHOLD, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, class (documents with equal sets),
    component_id (smallest id reachable by links, itself included).

    A document without words links with nothing and has no class; one without an id
    too, and its component is null. Rows that repeat an id keep a row each and share a
    component if their sets do. No documents: no rows.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    table = write_and_read(document_sets(docs, "doc_id", "text", length, threshold), "document-sets")
    classes = write_and_read(table.filter("class IS NOT NULL").groupBy("class").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"),
        F.first("sketch").alias("sketch"), F.first("fine").alias("fine"), F.min("check").alias("c1"), F.max("check").alias("c2")), "classes")
    if not classes.filter("c1 != c2").isEmpty():
        raise RuntimeError("two different sets share a 64-bit fingerprint")
    of = classes.select("class", "n_shingles", "sketch")
    fine = classes.select("class", "n_shingles", F.col("fine").alias("sketch"))

    entries = distinct_groups(shared_keys(docs, "doc_id", "text", length, threshold))
    led, across, left = _first_candidates(entries, of, threshold)
    near = led.filter("leader != class").union(across)
    pairs = _ordered(near.select(F.col("leader").alias("a"), F.col("class").alias("b")))
    pairs = write_and_read(pairs, "pairs")
    held = _sets(_ends(pairs), docs, classes, length)
    # one leader of each class first; its other leaders where this has left them apart
    tested = write_and_read(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "tested")
    label = components(write_and_read(_verified(tested, held, threshold), "links"))

    # what links have left apart: first a pair of each component, which connects most
    # of what there is to connect, then all that is left
    for choose in (*range(CHOOSING_ROUNDS), None):
        one, two = (label.select(F.col("node").alias(c), F.col("component").alias(f"l{c}")) for c in "ab")
        rest = (pairs.join(tested, ["a", "b"], "left_anti").join(one, "a", "left").join(two, "b", "left")
                .filter("coalesce(la, a) != coalesce(lb, b)").select("a", "b"))
        if choose is not None:
            rest = rest.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
        more = rest.union(_second_candidates(left, near, label, fine, threshold, choose)).distinct()
        more = write_and_read(more.join(tested, ["a", "b"], "left_anti"), "more-pairs")
        if more.isEmpty():
            continue
        lacking = _ends(more).join(held.select("class"), "class", "left_anti")
        if not lacking.isEmpty():
            held = held.union(_sets(lacking, docs, classes, length))
        links = write_and_read(_verified(more, held, threshold), "links")
        tested = tested.union(more)
        label = write_and_read(merged(label, links), "labels")

    ids = classes.select("class", "doc_id")
    member = label.withColumnRenamed("node", "class").join(ids, "class")
    least = member.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_class = (ids.join(member.join(least, "component").select("class", "component_id"), "class", "left")
                .select("class", F.coalesce("component_id", "doc_id").alias("component_id")))
    return (table.select("doc_id", "n_shingles", "class").join(of_class, "class", "left")
            .select("doc_id", "n_shingles", "class", F.coalesce("component_id", "doc_id").alias("component_id")))
