"""Token-id files with Elias-Fano document boundaries.

One file holds a range of documents in ascending id order: the ids of all of
them, one after another, in the narrowest unsigned width that the vocabulary
needs (2 or 4 bytes), and two Elias-Fano sequences, the documents' ends and
their document ids. A monotone sequence of n values below u takes about
2 + log2(u / n) bits a value; ``select`` finds the i-th value from a directory
of the upper bits, without a table of 64-bit offsets.

File layout, little-endian: the magic ``LMNTOK01``; the header's length (uint32)
and the header, JSON with the byte lengths of the parts; then the parts.

Spark deals the documents out by ranges of their id; each task encodes and
writes its files and returns one manifest row per file. Names are unique to an
attempt: what a lost or repeated attempt leaves is in no manifest.
"""

from __future__ import annotations

import array
import functools
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm.common import ship_package, write_and_read
from lamina.session import work_path

MAGIC = b"LMNTOK01"
#: A file is closed beyond so many ids.
FILE_IDS = 1 << 22
#: Units that a worker remembers; the memory is emptied beyond.
CACHE_UNITS = 700_000
#: Unknown units that the library is given as one text.
JOINED_UNITS = 64
_SELECT_EVERY = 256
_OTHER_SPACE = re.compile(r"[^\S \n]")


# --- Elias-Fano -------------------------------------------------------------

def ef_encode(values: np.ndarray) -> bytes:
    """A non-decreasing sequence of non-negative integers."""
    n = len(values)
    if n == 0:
        return struct.pack("<QB", 0, 0)
    values = values.astype(np.uint64)
    top = int(values[-1])
    low_bits = max(0, ((top + 1) // n).bit_length() - 1)
    high = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    bits = np.zeros(int(high[-1]) + 1, np.uint8)
    bits[high] = 1
    upper = np.packbits(bits, bitorder="little")
    lower = b""
    if low_bits:
        shifts = np.arange(low_bits, dtype=np.uint64)
        flat = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel()
        lower = np.packbits(flat, bitorder="little").tobytes()
    return struct.pack("<QBQ", n, low_bits, len(upper)) + upper.tobytes() + lower


class EliasFano:
    """Reads what ``ef_encode`` wrote."""

    def __init__(self, raw: bytes):
        self.n, self.low_bits = struct.unpack_from("<QB", raw)
        if self.n == 0:
            return
        size, = struct.unpack_from("<Q", raw, 9)
        self.upper = np.frombuffer(raw, np.uint8, size, 17)
        self.lower = np.frombuffer(raw, np.uint8, offset=17 + size)
        # select directory: ones before each block of the upper bits
        ones = np.unpackbits(self.upper, bitorder="little")
        starts = np.arange(0, len(ones), _SELECT_EVERY)
        self.before = np.concatenate(([0], np.cumsum(np.add.reduceat(ones, starts, dtype=np.int64))))

    def select(self, i: int) -> int:
        """The i-th value, from 0."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        block = int(np.searchsorted(self.before, i, side="right")) - 1
        first = block * _SELECT_EVERY // 8
        ones = np.unpackbits(self.upper[first:first + _SELECT_EVERY // 8], bitorder="little")
        at = block * _SELECT_EVERY + int(np.flatnonzero(ones)[i - int(self.before[block])])
        return ((at - i) << self.low_bits) | self._low(i)

    def _low(self, i: int) -> int:
        if not self.low_bits:
            return 0
        a = i * self.low_bits
        b = a + self.low_bits
        word = int.from_bytes(self.lower[a // 8:(b + 7) // 8].tobytes(), "little")
        return (word >> (a % 8)) & ((1 << self.low_bits) - 1)

    def all(self) -> np.ndarray:
        """Every value, in one pass."""
        if self.n == 0:
            return np.zeros(0, np.uint64)
        ones = np.flatnonzero(np.unpackbits(self.upper, bitorder="little"))[:self.n]
        out = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            bits = np.unpackbits(self.lower, count=self.n * self.low_bits, bitorder="little")
            weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
            out |= bits.reshape(self.n, self.low_bits).astype(np.uint64) @ weights
        return out


# --- encoding -----------------------------------------------------------------

@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class UnitEncoder:
    """Encodes texts with the tokenizers library, each distinct unit once.

    A unit is a blank and the word up to the next one. The tokenizer's byte-level
    split never joins characters over a boundary between a character that isn't white
    space and a blank before another such one, so that the ids of a text are those of
    its units. In the same way a word of letters with one sign behind (no apostrophe
    or underscore) falls into the two. Texts with a blank beside other white space, or
    with a special token's string, are given to the library whole.
    """

    def __init__(self, path: str, width: str, cache_units: int = CACHE_UNITS):
        self.tokenizer = _tokenizer(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.code, self.most = {"<u2": "H", "<u4": "I"}[width], cache_units
        self.width = np.dtype(width)
        vocabulary = self.tokenizer.get_vocab()
        self.blank = np.zeros(max(vocabulary.values()) + 1, bool)
        self.blank[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        # the word behind the blank -> ids; what was known before the last emptying
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        out = []
        for a in range(0, len(texts), 4096):
            got = self.tokenizer.encode_batch_fast(texts[a:a + 4096], add_special_tokens=False)
            out += [array.array(self.code, e.ids).tobytes() for e in got]
        return out

    def _units(self, words: list[str]) -> list[bytes]:
        """The ids of each `` word``. Many are one text for the library: a unit's first
        token, and no other, begins with the blank."""
        out = []
        texts = [" " + " ".join(words[a:a + JOINED_UNITS]) for a in range(0, len(words), JOINED_UNITS)]
        for at, raw in zip(range(0, len(words), JOINED_UNITS), self._library(texts)):
            own = words[at:at + JOINED_UNITS]
            begin = np.flatnonzero(self.blank[np.frombuffer(raw, self.width)])
            if len(begin) != len(own):
                out += self._library([" " + w for w in own])
            else:
                cut = [*(begin * self.width.itemsize).tolist(), len(raw)]
                out += [raw[a:b] for a, b in zip(cut[:-1], cut[1:])]
        return out

    def _learn(self, words: set[str]) -> None:
        """Make the ids of `` word`` known for words that aren't."""
        if len(self.known) + len(words) > self.most:
            self.older, self.known = self.known, {}
        ended = {w for w in words if not w[-1:].isalnum() and w[:-1].isalpha() and w[-1] not in "'_"}
        new = ((words - ended) | {w[:-1] for w in ended}) - self.known.keys()
        seen = new & self.older.keys()
        self.known.update(zip(seen, map(self.older.__getitem__, seen)))
        new -= seen
        # beside another unit's blank these would be other white space
        alone = [w for w in new if not w or w[0] == "\n" or w[-1] == "\n"]
        self.known.update(zip(alone, self._library([" " + w for w in alone])))
        new = list(new.difference(alone))
        self.known.update(zip(new, self._units(new)))
        signs = list({w[-1] for w in ended})
        sign = dict(zip(signs, self._library(signs)))
        self.known.update((w, self.known[w[:-1]] + sign[w[-1]]) for w in ended)

    def _assembled(self, texts: list[str]) -> list[bytes]:
        """The ids of texts that fall into units, each distinct unit looked up once."""
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        offsets, coded = np.asarray(split.offsets, np.int64), split.flatten().dictionary_encode()
        words, unit = coded.dictionary.to_pylist(), np.array(coded.indices, np.int64)
        ids = list(map(self.known.get, words))
        missing = [i for i, x in enumerate(ids) if x is None]
        if missing:
            self._learn({words[i] for i in missing})
            for i in missing:
                ids[i] = self.known[words[i]]
        # a text's first word has no blank before it
        first = offsets[:-1]
        ids += self._library([words[i] for i in unit[first]])
        unit[first] = len(words) + np.arange(len(texts))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.width.itemsize
        starts, n = np.cumsum(sizes) - sizes, sizes[unit]
        ends = np.cumsum(n)
        at = np.arange(ends[-1]) + np.repeat(starts[unit] - (ends - n), n)
        raw = np.frombuffer(b"".join(ids), self.width)[at].tobytes()
        cut = (np.append(0, ends)[offsets] * self.width.itemsize).tolist()
        return [raw[a:b] for a, b in zip(cut[:-1], cut[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian integers of ``width``."""
        whole, rest = [], []
        for i, text in enumerate(texts):
            if ("  " in text or " \n" in text or "\n " in text or any(s in text for s in self.special)
                    or not text.replace("\n", " ").isprintable() and _OTHER_SPACE.search(text)):
                whole.append(i)
            else:
                rest.append(i)
        out = [b""] * len(texts)
        for rows, make in ((rest, self._assembled), (whole, self._library)):
            for i, x in zip(rows, make([texts[i] for i in rows]) if rows else ()):
                out[i] = x
        return out


@functools.lru_cache(maxsize=2)
def _encoder(path: str, width: str) -> UnitEncoder:
    """A Python worker's encoder: what it has learned serves its next tasks, too."""
    return UnitEncoder(path, width)


# --- files ----------------------------------------------------------------------

def _open(uri: str):
    """The file system and path of a URI or a plain path."""
    if "://" in uri or uri.startswith("file:"):
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


def write_file(uri: str, doc_ids: list[int | None], texts_ids: list[bytes], width: str) -> tuple[int, int]:
    """Write one file; null document ids come first. Returns its ids and bytes."""
    item = np.dtype(width).itemsize
    ends = np.cumsum([len(x) // item for x in texts_ids]).astype(np.int64)
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    base = int(known[0]) if len(known) else 0
    parts = [ef_encode(ends), ef_encode((known - base).astype(np.uint64)), b"".join(texts_ids)]
    head = json.dumps({"width": width, "docs": len(doc_ids), "null_ids": len(doc_ids) - len(known),
                       "base": base, "parts": [len(p) for p in parts]}).encode()
    system, path = _open(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(path) as f:
        f.write(MAGIC + struct.pack("<I", len(head)) + head)
        for p in parts:
            f.write(p)
    return int(ends[-1]) if len(ends) else 0, sum(map(len, parts)) + len(head) + 12


class TokenFile:
    """Random access to one file's documents."""

    def __init__(self, uri: str):
        system, path = _open(uri)
        with system.open_input_stream(path) as f:
            raw = f.read()
        if raw[:8] != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        size, = struct.unpack_from("<I", raw, 8)
        self.head = json.loads(raw[12:12 + size])
        at, parts = 12 + size, []
        for n in self.head["parts"]:
            parts.append(raw[at:at + n])
            at += n
        self.ends, self.doc_id_part = EliasFano(parts[0]), EliasFano(parts[1])
        self.ids = np.frombuffer(parts[2], np.dtype(self.head["width"]))

    def __len__(self) -> int:
        return self.head["docs"]

    def doc_ids(self) -> list[int | None]:
        known = self.doc_id_part.all().astype(np.int64) + self.head["base"]
        return [None] * self.head["null_ids"] + known.tolist()

    def bounds(self, i: int) -> tuple[int, int]:
        """Offsets of the i-th document's ids, by two selects."""
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def document(self, i: int) -> np.ndarray:
        a, b = self.bounds(i)
        return self.ids[a:b]


def write(docs: DataFrame, tokenizer_file: str, folder: str | None = None, end_id: int = 0,
          id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """Encode every whole text, append ``end_id``, write the files.

    Returns the manifest: file, part, seq, n_docs, n_ids, n_bytes, in the order
    (part, seq) of ascending document ids. Null ids sort first; equal ids are
    ordered by their text; a null text is empty and has the end id alone. No
    documents: no files. ``folder`` defaults to a new one below
    spark.checkpoint.dir and may be any URI that pyarrow's file systems know.
    """
    spark = docs.sparkSession
    ship_package(spark)
    folder = folder or work_path(spark, "token-ids")
    vocabulary = _tokenizer(tokenizer_file).get_vocab_size(with_added_tokens=True)
    width = "<u2" if max(vocabulary, end_id + 1) <= 1 << 16 else "<u4"
    end = np.array([end_id], width).tobytes()
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    dealt = rows.repartitionByRange(n, F.asc_nulls_first("doc_id")).sortWithinPartitions(
        F.asc_nulls_first("doc_id"), "text")

    def run(batches):
        from pyspark import TaskContext

        part, item = TaskContext.get().partitionId(), np.dtype(width).itemsize
        encoder = _encoder(tokenizer_file, width)
        doc_ids: list = []
        ids: list[bytes] = []
        held = seq = 0

        def close():
            nonlocal held, seq
            uri = f"{folder}/part-{part:06d}-{seq:04d}-{uuid.uuid4().hex}.tok"
            n_ids, n_bytes = write_file(uri, doc_ids, ids, width)
            row = pa.RecordBatch.from_pylist([{"file": uri, "part": part, "seq": seq, "n_docs": len(doc_ids),
                                               "n_ids": n_ids, "n_bytes": n_bytes}], schema=schema)
            doc_ids.clear()
            ids.clear()
            held, seq = 0, seq + 1
            return row

        for batch in batches:
            for a, b in _spans(batch.column(1)):
                for d, x in zip(batch.column(0)[a:b].to_pylist(),
                                encoder.encode(batch.column(1)[a:b].to_pylist())):
                    doc_ids.append(d)
                    ids.append(x + end)
                    held += len(x) // item + 1
                if held > FILE_IDS:
                    yield close()
        if doc_ids:
            yield close()

    schema = pa.schema([("file", pa.string()), ("part", pa.int32()), ("seq", pa.int32()),
                        ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64())])
    manifest = dealt.mapInArrow(
        run, "file string, part int, seq int, n_docs long, n_ids long, n_bytes long")
    return write_and_read(manifest, "token-manifest")   # the files are written once, here


def _spans(column: pa.Array, limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    at = held = 0
    for i, n in enumerate(map(len, column.to_pylist())):
        held += n
        if held > limit:
            yield at, i + 1
            at, held = i + 1, 0
    if at < len(column):
        yield at, len(column)


def read_index(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Read the files back: per document doc_id, start (ids of all documents
    before it), n_tokens and ids_crc32 (of its ids as little-endian uint32).

    The manifest has one row per some million ids; its running sum is made on
    the driver from (part, seq, n_ids) alone.
    """
    ship_package(spark)
    files = manifest.select("file", "part", "seq", "n_ids").orderBy("part", "seq").collect()
    base = np.concatenate(([0], np.cumsum([r["n_ids"] for r in files]))).tolist()
    listed = [(r["file"], b) for r, b in zip(files, base)]
    index = spark.createDataFrame(listed, "file string, base long").repartition(max(1, len(listed)))

    def run(batches):
        for batch in batches:
            for uri, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                f = TokenFile(uri)
                ends = f.ends.all().astype(np.int64)
                starts = np.concatenate(([0], ends[:-1]))
                raw = f.ids.astype("<u4")
                crc = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f.doc_ids(), pa.int64()), pa.array(starts + first, pa.int64()),
                     pa.array(ends - starts, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return index.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
