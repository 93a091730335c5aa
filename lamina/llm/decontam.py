"""Benchmark decontamination with a distributed positional inverted index.

The index is document-partitioned: a shard holds the postings of some million
consecutive words, one row per (shard, term) with all positions of the term in
the shard. Positions count the shard's words, with a gap after each document, so
that a phrase never runs over a document's end. A shard is bounded by
``SHARD_WORDS`` (a longer document is a shard alone), and a common term has one
bounded row in each shard: no term makes a large group.

A search takes the test phrases in blocks of ``BLOCK_WORDS``. In each shard it
starts from a phrase's rarest term there, and intersects the offset-adjusted
lists of the others in order of their length until nothing is left.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import ship_package, write_and_read

SHARD_WORDS = 1 << 18
#: Words of test phrases that one pass broadcasts.
BLOCK_WORDS = 500_000
#: Beyond so many distinct test terms, the index holds all terms instead.
MAX_TERMS = 2_000_000
WINDOW = 13
MIN_SHARE = 20      # contaminated: hit words times this reach the words

#: A-Z to lower case; what is no word byte to a blank. All bytes above 127 are word bytes.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
                   for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_BYTES).split()


def _pack(positions: np.ndarray) -> bytes:
    """Gaps of an ascending list in the narrowest width."""
    gaps = np.diff(positions, prepend=0)
    for kind in ("<u1", "<u2", "<u4"):
        if gaps.max() <= np.iinfo(kind).max:
            return bytes([np.dtype(kind).itemsize]) + gaps.astype(kind).tobytes()
    raise ValueError("a shard is too long")


def _unpack(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, f"<u{raw[0]}", offset=1), dtype=np.int64)


INDEX = ("shard long, term binary, n long, postings binary, "
         "doc_ids array<long>, lengths array<int>")
_INDEX = pa.schema([("shard", pa.int64()), ("term", pa.binary()), ("n", pa.int64()),
                    ("postings", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
                    ("lengths", pa.list_(pa.int32()))])


def build_index(docs: DataFrame, terms: set[bytes] | None = None, id_col: str = "doc_id",
                text_col: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """Postings of every whole text; with ``terms``, of these alone (a search
    reads no other lists). The row with an empty term lists a shard's documents.

    A null or empty text is a document of no words. Null and repeated ids are kept:
    documents are told apart by their place in the shard. Written below
    spark.checkpoint.dir.
    """
    spark = docs.sparkSession
    ship_package(spark)
    known = spark.sparkContext.broadcast(sorted(terms)) if terms is not None else None

    def run(batches):
        shard = TaskContext.get().partitionId() << 32
        fixed = {t: i for i, t in enumerate(known.value)} if known is not None else None
        vocabulary: dict[bytes, int] = {}
        parts: list[np.ndarray] = []
        doc_ids: list = []
        lengths: list[int] = []
        size = 0

        def close() -> pa.RecordBatch:
            names = known.value if known is not None else list(vocabulary)
            ids = np.concatenate(parts) if parts else np.zeros(0, np.int32)
            places = np.arange(len(ids)) + np.repeat(np.arange(len(lengths)), lengths)
            held = np.flatnonzero(ids >= 0)
            order = held[np.argsort(ids[held], kind="stable")]
            found, first = np.unique(ids[order], return_index=True)
            ends = np.append(first, len(order))
            n = len(found)
            listed = [None] * n
            return pa.RecordBatch.from_arrays(
                [pa.array([shard] * (n + 1), pa.int64()),
                 pa.array([b""] + [names[t] for t in found], pa.binary()),
                 pa.array([len(ids)] + np.diff(ends).tolist(), pa.int64()),
                 pa.array([b""] + [_pack(places[order[a:b]]) for a, b in zip(ends[:-1], ends[1:])], pa.binary()),
                 pa.array([doc_ids] + listed, pa.list_(pa.int64())),
                 pa.array([lengths] + listed, pa.list_(pa.int32()))], schema=_INDEX)

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                found = words(text.as_py())
                if doc_ids and size + len(found) > shard_words:
                    yield close()
                    shard += 1
                    parts, doc_ids, lengths, size, vocabulary = [], [], [], 0, {}
                if fixed is not None:
                    ids = map(fixed.get, found, repeat(-1))
                else:
                    ids = (vocabulary.setdefault(w, len(vocabulary)) for w in found)
                parts.append(np.fromiter(ids, np.int32, len(found)))
                doc_ids.append(doc_id.as_py())
                lengths.append(len(found))
                size += len(found)
        if doc_ids:
            yield close()

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, INDEX)
    return write_and_read(rows, "postings")


@dataclass(frozen=True)
class Phrase:
    terms: tuple[bytes, ...]
    items: tuple[int, ...]      # the test items that hold it


def windows(items: list[tuple[int | None, str | None]], length: int = WINDOW) -> list[Phrase]:
    """Distinct windows of ``length`` consecutive words; a shorter item is one
    window, an item without words none. An item without id has no entry in items."""
    held: dict[tuple[bytes, ...], set[int]] = {}
    for item_id, text in items:
        w = words(text)
        for i in range(max(1, len(w) - length + 1) if w else 0):
            own = held.setdefault(tuple(w[i:i + length]), set())
            if item_id is not None:
                own.add(item_id)
    return [Phrase(t, tuple(sorted(i))) for t, i in held.items()]


def occurrences(terms: tuple[bytes, ...], lists: dict[bytes, np.ndarray], slop: int = 0,
                first: np.ndarray | None = None) -> np.ndarray:
    """Places where the phrase begins, by its rarest term's places. With ``slop``,
    each other term may stand up to so many words from its place in the phrase,
    within the same document (``first``: where the documents begin)."""
    if not all(t in lists for t in terms):
        return np.zeros(0, np.int64)
    order = sorted(range(len(terms)), key=lambda k: len(lists[terms[k]]))
    at = lists[terms[order[0]]] - order[0]
    if slop:
        doc = np.searchsorted(first, at + order[0], side="right")
        low, high = first[doc - 1], first[doc] - 1
    for k in order[1:]:
        near = lists[terms[k]]
        begin, end = at + (k - slop), at + (k + slop)
        if slop:
            begin, end = np.maximum(begin, low), np.minimum(end, high)
        i = np.searchsorted(near, begin)
        good = i < len(near)
        good[good] = near[i[good]] <= end[good]
        at = at[good]
        if slop:
            low, high = low[good], high[good]
        if not len(at):
            break
    return np.maximum(at, low) if slop else at


HITS = "shard long, doc long, starts array<int>, ends array<int>, items array<long>"
_HITS = pa.schema([("shard", pa.int64()), ("doc", pa.int64()), ("starts", pa.list_(pa.int32())),
                   ("ends", pa.list_(pa.int32())), ("items", pa.list_(pa.int64()))])


def _spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans, as maximal runs."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > reach[:-1])
    return starts[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]


def _search_shard(table: pa.Table, phrases: list[Phrase], slop: int) -> pa.Table:
    term = table.column("term").to_pylist()
    raw = table.column("postings").to_pylist()
    head = term.index(b"")
    shard = table.column("shard")[head].as_py()
    lengths = np.array(table.column("lengths")[head].as_py(), np.int64)
    first = np.concatenate(([0], np.cumsum(lengths + 1)))
    lists = {t: _unpack(r) for t, r in zip(term, raw) if t}
    starts, ends, items = {}, {}, {}
    for p in phrases:
        at = occurrences(p.terms, lists, slop, first)
        if not len(at):
            continue
        doc = np.searchsorted(first, at, side="right") - 1
        begin = at - first[doc]
        end = np.minimum(begin + len(p.terms), lengths[doc])
        for d in np.unique(doc).tolist():
            own = doc == d
            starts.setdefault(d, []).append(begin[own])
            ends.setdefault(d, []).append(end[own])
            items.setdefault(d, set()).update(p.items)
    rows = []
    for d in sorted(starts):
        a, b = _spans(np.concatenate(starts[d]), np.concatenate(ends[d]))
        rows.append({"shard": shard, "doc": d, "starts": a.tolist(), "ends": b.tolist(), "items": sorted(items[d])})
    return pa.Table.from_pylist(rows, schema=_HITS)


def phrase_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                block_words: int = BLOCK_WORDS, window: int = WINDOW) -> Iterator[list[Phrase]]:
    """The test set's phrases in blocks. A block is what the driver holds and
    broadcasts; its words are bounded by the number of blocks that they need."""
    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    size = F.length(F.coalesce("text", F.lit(""))) / 2 + 1           # no less than its words
    total = rows.agg(F.sum(size)).first()[0] or 0
    blocks = int(total // block_words) + 1
    which = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for k in range(blocks):
        part = rows if blocks == 1 else rows.filter(which == k)
        yield windows([(r["item_id"], r["text"]) for r in part.collect()], window)


def search(index: DataFrame, phrases: list[Phrase], slop: int = 0) -> DataFrame:
    """Documents with occurrences: (shard, doc), the hit words as maximal runs
    [start, end) and the sorted ids of the items that hold an occurring phrase."""
    spark = index.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(phrases)
    wanted = {t for p in phrases for t in p.terms}
    if len(wanted) <= MAX_TERMS:
        # an Arrow table: of a list, Spark would start Python workers on the executors to read it
        names = spark.createDataFrame(pa.table({"term": pa.array([*sorted(wanted), b""], pa.binary())}))
        index = index.join(F.broadcast(names), "term", "left_semi")   # bounded by MAX_TERMS
    return (index.select("shard", "term", "postings", "lengths").groupBy("shard")
            .applyInArrow(lambda table: _search_shard(table, shared.value, slop), HITS))


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0,
         id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per document, in no order: doc_id, n_words, spans (hit words as
    maximal runs [start, end)), n_hit, items (sorted ids of items with an occurring
    window).

    Null or empty texts have no words. Null and repeated document ids keep their
    rows; an item without an id hits, but is not listed. No test items, or none with
    words: no hits. Test sets of any size are searched in blocks of ``block_words``.
    """
    blocks = phrase_blocks(items, item_col, block_words=block_words, window=window)
    first = next(blocks)
    rest = next(blocks, None)
    terms = {t for p in first for t in p.terms} if rest is None else None
    index = build_index(docs, terms if terms is None or len(terms) <= MAX_TERMS else None,
                        id_col, text_col, shard_words)
    found = search(index, first, slop)
    if rest is not None:
        found = found.union(search(index, rest, slop))
        for block in blocks:
            found = found.union(search(index, block, slop))
        found = found.groupBy("shard", "doc").agg(
            F.flatten(F.collect_list("starts")).alias("starts"),
            F.flatten(F.collect_list("ends")).alias("ends"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    listed = (index.filter(F.length("term") == 0)
              .select("shard", F.posexplode(F.arrays_zip("doc_ids", "lengths")).alias("doc", "of"))
              .select("shard", F.col("doc").cast("long").alias("doc"),
                      F.col("of.doc_ids").alias(id_col), F.col("of.lengths").cast("long").alias("n_words")))
    spans = F.array_sort(F.arrays_zip(F.col("starts").alias("start"), F.col("ends").alias("end")))
    out = listed.join(found, ["shard", "doc"], "left").select(
        id_col, "n_words", F.coalesce(spans, F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"))
    # spans of several blocks may overlap: count what each adds to the words before it
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda s, x: F.struct((s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(s["to"], x["start"]))).alias("n"),
                              F.greatest(s["to"], x["end"]).alias("to")), lambda s: s["n"])
    return out.withColumn("n_hit", covered.cast("long"))


def contaminated(n_hit="n_hit", n_words="n_words", min_share: int = MIN_SHARE):
    """At least one word in ``min_share`` is hit."""
    return (F.col(n_hit) > 0) & (F.col(n_hit) * min_share >= F.col(n_words))
