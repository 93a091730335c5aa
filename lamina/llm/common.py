"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.session import work_path

#: Text bytes that one numpy pass handles; a longer document is a pass alone.
CHUNK_BYTES = 1 << 19

_SHIPPED: set[str] = set()


#: Whole texts travel in Arrow batches; small ones keep tasks and workers small.
BATCH_BYTES = str(8 << 20)
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Send this library to the executors' Python workers, once per application, and
    keep the session's Arrow batches small unless its configuration says otherwise."""
    if spark.sparkContext.getConf().get(_BATCH_KEY) is None:
        spark.conf.set(_BATCH_KEY, BATCH_BYTES)
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="lamina-py-"), "lamina_package.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    p = os.path.join(folder, n)
                    z.write(p, os.path.join("lamina", os.path.relpath(p, root)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


#: Spark removes a query's shuffle files at its end, not when the driver happens to collect garbage.
_TIDY_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_and_read(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` into a new folder below ``spark.checkpoint.dir``
    and read it back. A lost executor costs a reread of these files only; the write's
    shuffle files go with it."""
    path = work_path(df.sparkSession, name)
    conf = df.sparkSession.conf
    before = conf.get(_TIDY_KEY, None)
    conf.set(_TIDY_KEY, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(_TIDY_KEY) if before is None else conf.set(_TIDY_KEY, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(id_col: str = "doc_id"):
    """crc32 of the decimal id, mod 4; 2 is held out from training."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


@dataclass
class TextChunk:
    """Consecutive rows of an Arrow batch, their UTF-8 bytes joined."""

    first: int                # row in the batch
    data: np.ndarray          # uint8, the texts one after another
    offsets: np.ndarray       # int64, rows + 1 entries, offsets[0] == 0

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def row_of_byte(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows, dtype=np.int64), np.diff(self.offsets))


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[TextChunk]:
    """Split a text column into chunks of about ``limit`` bytes without copying
    the texts into Python strings. A null text is an empty one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    arr = pc.fill_null(column, "") if column.null_count else column
    n = len(arr)
    if n == 0:
        return
    buffers = arr.buffers()
    width = np.int64 if pa.types.is_large_string(arr.type) else np.int32
    offs = np.frombuffer(buffers[1], dtype=width)[arr.offset:arr.offset + n + 1]
    data = (np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None and buffers[2].size
            else np.zeros(0, np.uint8))
    at = 0
    while at < n:
        to = int(np.searchsorted(offs, int(offs[at]) + limit, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield TextChunk(at, data[offs[at]:offs[to]], offs[at:to + 1].astype(np.int64) - int(offs[at]))
        at = to


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values (two multiply-xorshift rounds)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def byte_codes(seed: int) -> np.ndarray:
    """256 random 64-bit codes from a seed: the hash of one byte."""
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 2**64, 256, dtype=np.uint64)


_POW: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _POW.get(base)
    if have is None or len(have) < n:
        step = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        step[0] = 1
        have = np.cumprod(step, dtype=np.uint64)
        _POW[base] = have
    return have[:n]


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hash of each byte string data[start:end], from prefix sums of a
    polynomial in an odd base modulo 2**64; equal strings get equal hashes
    wherever they stand."""
    codes = byte_codes(seed)
    weighted = codes[data] * powers(_BASE, len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(weighted, out=sums[1:], dtype=np.uint64)
    value = (sums[ends] - sums[starts]) * powers(_INVERSE, len(data) + 1)[starts]
    return mix64(value + (ends - starts).astype(np.uint64))
