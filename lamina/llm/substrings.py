"""Exact substring deduplication by sparse suffix sorting.

A byte goes if a string of ``length`` bytes that covers it starts earlier, too: in a
document with a smaller id, or further ahead in the same one. Texts are UTF-8 bytes,
matches never cross documents, and all strings are judged on the input.

Sorting all suffixes would move each byte of the corpus a hundred times. Equal
strings of ``length`` bytes have the same least gram (the one of ``GRAM`` bytes with
the smallest hash, the first of these), at the same offset: an anchor. Every string
start belongs to one anchor, and about one byte in 35 is one.

1. Anchors meet by gram. Of anchors with the same surroundings - the bytes of all
   strings that belong to them, by a 64-bit fingerprint beside the gram's - all but
   the earliest are covered whole.
2. Where a gram has several surroundings, the remaining ones are fetched from the
   texts, and the suffixes that start in them are ordered by deep-shallow sorting;
   of those equal over ``length`` bytes, all but the earliest are covered.
3. Spans and texts meet by document.

A task brings equal surroundings down to one before the shuffle. A gram with very
many surroundings (a line that stands in a great part of all documents) is hot: its
strings are dealt out by 128 bits of their own content instead, so that no task
gets all documents that hold it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import (
    _BASE,
    _INVERSE,
    byte_codes,
    mix64,
    powers,
    ship_package,
    span_hashes,
    text_chunks,
    write_and_read,
)
from lamina.llm.suffixsort import equal_runs

LENGTH = 100
GRAM = 32
#: Surroundings of one gram in one task's share, and in all, beyond which it is hot.
HOT_IN_TASK = 256
HOT = 20_000
#: Anchors that a task collects before it hands them on.
FLUSH_ANCHORS = 1 << 19
#: String starts that are handled in one numpy pass over a very long document.
STEP = 8 << 20

_NO_ID = -(1 << 63)
ANCHOR = np.dtype([("gram", "<u8"), ("around", "<u8"), ("doc", "<i8"), ("copy", "<i8"), ("pos", "<u4"),
                   ("omin", "u1"), ("omax", "u1"), ("hot", "u1")])
SPAN = np.dtype([("doc", "<i8"), ("copy", "<i8"), ("start", "<u4"), ("end", "<u4")])
STRING = np.dtype([("one", "<u8"), ("two", "<u8"), ("doc", "<i8"), ("copy", "<i8"), ("start", "<u4")])


def _sums(data: np.ndarray, seed: int) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte_codes(seed)[data] * powers(_BASE, len(data)), out=out[1:])
    return out


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(row, position in the data, omin, omax, gram, around) of every anchor of joined
    texts; the starts position - omax .. position - omin belong to it."""
    empty = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    n = len(data)
    if n < length:
        return empty
    gram, width = GRAM, length - GRAM + 1
    sums = _sums(data, 6)
    h = mix64((sums[gram:] - sums[:-gram]) * powers(_INVERSE, n + 1)[:n - gram + 1])
    del sums
    low = np.uint64((1 << 24) - 1)
    found = []
    for a in range(0, n - length + 1, STEP):
        b = min(a + STEP, n - length + 1)
        m = (h[a:b + width - 1] & ~low) | np.arange(b + width - 1 - a, dtype=np.uint64)
        span = 1
        while span * 2 <= width:
            m = np.minimum(m[:-span], m[span:])
            span *= 2
        if width > span:
            m = np.minimum(m[:-(width - span)], m[width - span:])
        found.append((m & low).astype(np.int64) + a)
    at = np.concatenate(found)                      # the anchor of each start
    row_first, row_last = offsets[:-1], offsets[1:] - length
    change = np.zeros(n + 2, np.int32)
    good = row_last >= row_first
    change[row_first[good]] += 1
    change[row_last[good] + 1] -= 1
    starts = np.flatnonzero(np.cumsum(change)[:len(at)] > 0)
    if not len(starts):
        return empty
    at = at[starts]
    first = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)))
    last = np.append(first[1:], len(starts)) - 1
    pos = at[first]
    omax, omin = pos - starts[first], pos - starts[last]
    around = span_hashes(data, pos - omax, pos - omin + length, seed=7)
    around ^= mix64((omin * 256 + omax + 1).astype(np.uint64))
    return np.searchsorted(offsets, pos, side="right") - 1, pos, omin, omax, h[pos], around


def _sorted(x: np.ndarray, *names: str) -> np.ndarray:
    return x[np.lexsort(tuple(x[c] for c in reversed(names)))]


def _new(x: np.ndarray, *names: str) -> np.ndarray:
    """Whether a sorted row differs from the one before in any of the columns."""
    out = np.zeros(len(x), bool)
    out[:1] = True
    for c in names:
        out[1:] |= x[c][1:] != x[c][:-1]
    return out


def _spans_of(x: np.ndarray, length: int) -> np.ndarray:
    out = np.zeros(len(x), SPAN)
    out["doc"], out["copy"] = x["doc"], x["copy"]
    out["start"] = x["pos"] - x["omax"]
    out["end"] = x["pos"] - x["omin"] + np.uint32(length)
    return out


def merged(spans: np.ndarray) -> np.ndarray:
    """Union of a document's spans as maximal runs, for all documents."""
    if not len(spans):
        return spans
    s = _sorted(spans, "doc", "copy", "start")
    new_doc = _new(s, "doc", "copy")
    # the furthest end so far within the document
    doc = np.cumsum(new_doc).astype(np.int64)
    reach = np.maximum.accumulate(s["end"].astype(np.int64) + (doc << 33)) - (doc << 33)
    new = new_doc.copy()
    new[1:] |= s["start"][1:] > reach[:-1]
    first = np.flatnonzero(new)
    out = s[first].copy()
    out["end"] = reach[np.append(first[1:], len(s)) - 1]
    return out


def _collapsed(x: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchors sorted, one for each (gram, around), the earliest; spans of the others."""
    x = _sorted(x, "gram", "around", "doc", "copy", "pos")
    x = x[_new(x, "gram", "around", "doc", "copy", "pos")]
    first = _new(x, "gram", "around")
    hot = np.maximum.reduceat(x["hot"], np.flatnonzero(first)) if len(x) else x["hot"]
    kept = x[first]
    kept["hot"] = hot
    return kept, _spans_of(x[~first], length)


def _by(values: np.ndarray, buckets: int) -> np.ndarray:
    return (values ^ (values >> 15)) % buckets


def _dealt(bucket: np.ndarray, rows: np.ndarray):
    """(bucket, packed rows) pairs."""
    order = np.argsort(bucket, kind="stable")
    found, first = np.unique(bucket[order], return_index=True)
    for b, a, e in zip(found.tolist(), first, np.append(first[1:], len(order))):
        yield b, rows[order[a:e]].tobytes()


# What moves between the stages, packed: anchors by gram (rows; their surroundings in
# text), hot grams' strings by content (rows), or, by document, requests (rows) and
# spans. A task makes one row for each bucket and kind.
_PACKED = "bucket long, kind int, rows binary, text binary, spans binary"
_ROWS = pa.schema([("bucket", pa.int64()), ("kind", pa.int32()), ("rows", pa.binary()), ("text", pa.binary()),
                   ("spans", pa.binary())])
_ANCHORS, _STRINGS, _DOCUMENTS = range(3)


def _by_document(requests: np.ndarray, spans: np.ndarray, buckets: int, *more: tuple[int, bytes, bytes]) -> list[tuple]:
    """One row a bucket of documents; ``more`` has packed rows of single buckets."""
    packed: dict[int, list[list[bytes]]] = {}
    for k, x in enumerate((requests, spans)):
        for b, raw in _dealt(_by(x["doc"], buckets), x):
            packed.setdefault(b, [[], []])[k].append(raw)
    for b, rows, found in more:
        own = packed.setdefault(b, [[], []])
        own[0].append(rows)
        own[1].append(found)
    return [(b, _DOCUMENTS, b"".join(r), None, b"".join(f)) for b, (r, f) in packed.items()]


def _passing(table: pa.Table) -> list[tuple[int, bytes, bytes]]:
    """What is by document already."""
    return [(b, r, f) for b, k, r, f in zip(*(table.column(c).to_pylist() for c in ("bucket", "kind", "rows", "spans")))
            if k == _DOCUMENTS]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[], [], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ROWS)], schema=_ROWS)


def _joined(table: pa.Table, kind: int, dtype: np.dtype, column: str = "rows") -> np.ndarray:
    rows = [r for k, r in zip(table.column("kind").to_pylist(), table.column(column).to_pylist()) if k == kind]
    return np.frombuffer(b"".join(rows), dtype).copy()


class _Plan:
    """What the stages of one run share."""

    def __init__(self, length: int, buckets: int, hot_in_task: int, hot: int):
        self.length, self.buckets = length, buckets
        self.hot_in_task, self.hot = hot_in_task, hot

    def scan(self, batches):
        """Texts -> anchors by gram; spans, and hot grams' requests, by document."""
        held, size = [], 0
        for batch in batches:
            doc = np.asarray(batch.column(0), np.int64)
            copy = np.asarray(batch.column(1), np.int64)
            for chunk in text_chunks(batch.column(2)):
                row, pos, omin, omax, gram, around = anchors(chunk.data, chunk.offsets, self.length)
                x = np.zeros(len(row), ANCHOR)
                x["gram"], x["around"], x["omin"], x["omax"] = gram, around, omin, omax
                x["doc"], x["copy"] = doc[chunk.first + row], copy[chunk.first + row]
                x["pos"] = pos - chunk.offsets[row]
                held.append(x)
                size += len(x)
                if size >= FLUSH_ANCHORS:
                    yield self._flush(held)
                    held, size = [], 0
        if size:
            yield self._flush(held)

    def _flush(self, held):
        x, spans = _collapsed(np.concatenate(held), self.length)
        group = np.cumsum(_new(x, "gram")) - 1
        x["hot"] |= (np.bincount(group)[group] > self.hot_in_task).astype(np.uint8)
        # a hot gram sends one anchor by gram, as a mark; requests are by document
        away = (x["hot"] == 1)
        mark = away & _new(x, "gram")
        requests, x = x[away], x[~away | mark]
        out = [(b, _ANCHORS, r, None, None) for b, r in _dealt((x["gram"] % np.uint64(self.buckets)).astype(np.int64), x)]
        return _batch(out + _by_document(requests, merged(spans), self.buckets))

    def meet(self, table: pa.Table) -> pa.Table:
        """Anchors of a bucket of grams -> requests and spans by document. What is by
        document already passes through."""
        x, spans = _collapsed(_joined(table, _ANCHORS, ANCHOR), self.length)
        if len(x):
            group = np.cumsum(_new(x, "gram")) - 1
            count = np.bincount(group)
            hot = (np.maximum.reduceat(x["hot"], np.flatnonzero(_new(x, "gram"))) > 0) | (count > self.hot)
            x["hot"] = hot[group]
            x = x[(count[group] > 1) | hot[group]]
        return pa.Table.from_batches([_batch(_by_document(x, merged(spans), self.buckets, *_passing(table)))])

    def fetch(self, texts: pa.Table, asked: pa.Table) -> pa.Table:
        """Texts and requests of a bucket of documents -> surroundings by gram, and
        hot grams' strings by content."""
        x = _joined(asked, _DOCUMENTS, ANCHOR)
        if not len(x):
            return pa.Table.from_batches([_batch([])])
        x = _sorted(x, "doc", "copy", "pos")
        x = x[_new(x, "doc", "copy", "pos", "omin", "omax", "around")]
        first = np.flatnonzero(_new(x, "doc", "copy"))
        of = {(int(x["doc"][a]), int(x["copy"][a])): (a, e) for a, e in zip(first, np.append(first[1:], len(x)))}
        strings, around, taken = [], [], []
        done = set()
        for doc, copy, text in zip(texts.column("doc").to_pylist(), texts.column("copy").to_pylist(), texts.column("text")):
            if (doc, copy) not in of or (doc, copy) in done:
                continue
            done.add((doc, copy))
            a, e = of[doc, copy]
            raw = text.as_py().encode()
            data = np.frombuffer(raw, np.uint8)
            y = x[a:e]
            hot = y["hot"] == 1
            if hot.any():
                strings.append(self._strings(data, y[hot]))
            y = y[~hot]
            begin = y["pos"].astype(np.int64) - y["omax"]
            end = y["pos"].astype(np.int64) - y["omin"] + self.length
            around += [raw[b:t] for b, t in zip(begin.tolist(), end.tolist())]
            taken.append(y)
        out = []
        if taken:
            y = np.concatenate(taken)
            bucket = (y["gram"] % np.uint64(self.buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            found, at = np.unique(bucket[order], return_index=True)
            for b, a, e in zip(found.tolist(), at, np.append(at[1:], len(order))):
                own = order[a:e]
                out.append((b, _ANCHORS, y[own].tobytes(), b"".join(around[i] for i in own), None))
        if strings:
            s, spans = self._earliest(np.concatenate(strings))
            out += [(b, _STRINGS, r, None, None) for b, r in _dealt((s["one"] % np.uint64(self.buckets)).astype(np.int64), s)]
            out += _by_document(x[:0], merged(spans), self.buckets)
        return pa.Table.from_batches([_batch(out)])

    def _strings(self, data: np.ndarray, y: np.ndarray) -> np.ndarray:
        """A row for each string that belongs to the anchors."""
        size = y["omax"].astype(np.int64) - y["omin"] + 1
        start = np.repeat(y["pos"].astype(np.int64) - y["omax"], size)
        start += np.arange(len(start)) - np.repeat(np.cumsum(size) - size, size)
        out = np.zeros(len(start), STRING)
        out["one"] = span_hashes(data, start, start + self.length, seed=8)
        out["two"] = span_hashes(data, start, start + self.length, seed=18)
        out["doc"], out["copy"], out["start"] = y["doc"][0], y["copy"][0], start
        return out

    def _earliest(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        s = _sorted(s, "one", "two", "doc", "copy", "start")
        s = s[_new(s, "one", "two", "doc", "copy", "start")]
        first = _new(s, "one", "two")
        later = s[~first]
        spans = np.zeros(len(later), SPAN)
        for c in ("doc", "copy", "start"):
            spans[c] = later[c]
        spans["end"] = later["start"] + np.uint32(self.length)
        return s[first], spans

    def order(self, table: pa.Table) -> pa.Table:
        """Surroundings and strings of a bucket -> spans by document."""
        _, spans = self._earliest(_joined(table, _STRINGS, STRING))
        spans = [spans]
        x = _joined(table, _ANCHORS, ANCHOR)
        if len(x):
            text = b"".join(t for k, t in zip(table.column("kind").to_pylist(), table.column("text").to_pylist())
                            if k == _ANCHORS)
            size = x["omax"].astype(np.int64) - x["omin"] + 1
            own = np.repeat(np.arange(len(x)), size)
            step = np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size)
            begin = np.cumsum(size + self.length - 1) - (size + self.length - 1)
            offset = x["omax"][own].astype(np.int64) - step
            # equal strings have their anchor's gram at the same offset
            places, cls = equal_runs(text, begin[own] + step, self.length, x["gram"][own] * np.uint64(128) + offset.astype(np.uint64))
            got = np.zeros(len(places), SPAN)
            row = own[places]
            got["doc"], got["copy"] = x["doc"][row], x["copy"][row]
            got["start"] = x["pos"][row] - x["omax"][row] + step[places].astype(np.uint32)
            got["end"] = got["start"] + np.uint32(self.length)
            order = np.lexsort((got["start"], got["copy"], got["doc"], cls))
            got, cls = got[order], cls[order]
            differs = _new(got, "doc", "copy", "start")
            differs[1:] |= cls[1:] != cls[:-1]
            got, cls = got[differs], cls[differs]
            spans.append(got[np.append(False, cls[1:] == cls[:-1])] if len(got) else got)
        spans = merged(np.concatenate(spans))
        return pa.Table.from_batches([_batch(_by_document(x[:0], spans, self.buckets, *_passing(table)))])

    def cut(self, texts: pa.Table, found: pa.Table) -> pa.Table:
        """Texts and spans of a bucket of documents -> the result."""
        s = merged(_joined(found, _DOCUMENTS, SPAN, "spans"))
        first = np.flatnonzero(_new(s, "doc", "copy"))
        of = {(int(s["doc"][a]), int(s["copy"][a])): (a, e) for a, e in zip(first, np.append(first[1:], len(s)))}
        spans, kept, size = [], [], []
        for doc, copy, text in zip(texts.column("doc").to_pylist(), texts.column("copy").to_pylist(), texts.column("text")):
            raw = text.as_py().encode()
            size.append(len(raw))
            a, e = of.get((doc, copy), (0, 0))
            pairs = list(zip(s["start"][a:e].tolist(), s["end"][a:e].tolist()))
            at, parts = 0, []
            for b, t in pairs:
                parts.append(raw[at:b])
                at = t
            kept.append(b"".join([*parts, raw[at:]]))
            spans.append([{"start": b, "end": t} for b, t in pairs])
        return pa.table([texts.column("doc_id"), pa.array(size, pa.int64()), pa.array(spans, _SPAN_LIST),
                         pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])


_SPAN_LIST = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def dedup(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
          hot_in_task: int = HOT_IN_TASK, hot: int = HOT) -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (removed bytes as maximal runs
    [start, end)), kept (the other bytes).

    A null text is empty; texts shorter than ``length`` stay. Documents without an id
    come before all others. Rows that repeat an id are ordered by their text's
    fingerprint; equal rows are one document, and each gets its result.
    """
    if not GRAM + 8 <= length <= 200 + GRAM:
        raise ValueError("length must be 40 to 232 bytes")
    spark = docs.sparkSession
    ship_package(spark)
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = _Plan(length, buckets, hot_in_task, hot)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("doc", F.coalesce("doc_id", F.lit(_NO_ID)))
    repeated = not rows.groupBy("doc").count().filter("count > 1").isEmpty()
    rows = rows.withColumn("copy", F.xxhash64("text") if repeated else F.lit(0).cast("long"))

    met = write_and_read(rows.select("doc", "copy", "text").mapInArrow(plan.scan, _PACKED)
                         .groupBy("bucket").applyInArrow(lambda t: plan.meet(t), _PACKED), "anchors")
    mixed = F.col("doc").bitwiseXOR(F.shiftright("doc", 15))
    texts = rows.withColumn("bucket", F.pmod(mixed, F.lit(buckets))).groupBy("bucket")
    around = texts.cogroup(met.filter(F.length("rows") > 0).groupBy("bucket")).applyInArrow(
        lambda t, asked: plan.fetch(t, asked), _PACKED)
    found = around.groupBy("bucket").applyInArrow(lambda t: plan.order(t), _PACKED)
    spans = met.unionByName(found).filter(F.length("spans") > 0)
    return texts.cogroup(spans.groupBy("bucket")).applyInArrow(
        lambda t, s: plan.cut(t, s), "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
