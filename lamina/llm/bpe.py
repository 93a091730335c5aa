"""Byte-level BPE encoding and decoding with the tiktoken library.

The rank file is local (its path is a parameter) and loaded once per Python
worker. Long texts are cut at safe boundaries first, so that the memory of one
library call stays bounded:

* a cut between an ASCII letter or digit and an ASCII blank or line feed never
  lies inside a match of the split pattern;
* a run of white space of ``LONG_SPACE`` or more is one match up to its last
  character (all of it at the end of the text), which the library's regular
  expression engine can't match in one go. It is merged as one piece.
"""

from __future__ import annotations

import array
import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lamina.llm.common import ship_package

PIECE_CHARS = 1 << 18
LONG_SPACE = 512
_CUT = re.compile(r"[0-9A-Za-z](?=[ \n])")
_SPACE_RUN = regex.compile(r"\p{White_Space}{%d,}" % LONG_SPACE)


@functools.lru_cache(maxsize=4)
def _encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _encodings(rank_file: str, pattern: str) -> tuple[tiktoken.Encoding, tiktoken.Encoding]:
    """The encoding, and one that merges its whole input as a single match."""
    return _encoding(rank_file, pattern), _encoding(rank_file, r"(?s:.+)")


def safe_pieces(text: str, piece_chars: int = PIECE_CHARS) -> Iterator[tuple[str, bool]]:
    """Pieces whose encodings, joined, are the text's encoding; True marks a
    white-space match to merge whole."""
    def cut(part: str) -> Iterator[tuple[str, bool]]:
        at = 0
        while len(part) - at > piece_chars:
            m = _CUT.search(part, at + piece_chars)
            if m is None:
                break
            yield part[at:m.end()], False
            at = m.end()
        if at < len(part):
            yield part[at:], False

    at = 0
    if len(text) >= LONG_SPACE:
        for m in _SPACE_RUN.finditer(text):
            yield from cut(text[at:m.start()])
            at = m.end() if m.end() == len(text) else m.end() - 1
            yield text[m.start():at], True
    yield from cut(text[at:])


def encode_text(text: str, rank_file: str, pattern: str) -> list[int]:
    """Token ids of one text, without special tokens."""
    plain = _encoding(rank_file, pattern)
    if len(text) < LONG_SPACE:
        return plain.encode_ordinary(text)
    ids: list[int] = []
    for piece, is_space in safe_pieces(text):
        # few workers ever need the second encoding
        ids += (_encodings(rank_file, pattern)[1] if is_space else plain).encode_ordinary(piece)
    return ids


def _encoder(rank_file: str, pattern: str, keep: list[str], text_at: int, out_col: str):
    def run(batches):
        for batch in batches:
            texts = batch.column(text_at)
            ids, ends, held, first = array.array("i"), [0], 0, 0
            for i in range(batch.num_rows):
                text = texts[i].as_py() or ""
                ids.extend(encode_text(text, rank_file, pattern))
                ends.append(len(ids))
                held += len(text)
                if held > 4 << 20 or i + 1 == batch.num_rows:
                    part = batch.slice(first, i + 1 - first).columns[:len(keep)]
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.array(ids, np.int32)))
                    yield pa.RecordBatch.from_arrays([*part, lists], names=[*keep, out_col])
                    ids, ends, held, first = array.array("i"), [0], 0, i + 1
    return run


def _decoder(rank_file: str, pattern: str, ids_col: str, out_col: str):
    def run(batches):
        enc = _encoding(rank_file, pattern)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_col))
            held, out, first = 0, [], 0
            for i in range(batch.num_rows):
                value = ids[i]
                out.append(enc.decode_bytes(value.values.to_pylist()) if value.is_valid else None)
                held += len(out[-1] or b"")
                if held > 4 << 20 or i + 1 == batch.num_rows:
                    part = batch.slice(first, len(out))
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(out, pa.binary())],
                        names=[*batch.schema.names, out_col])
                    held, out, first = 0, [], i + 1
    return run


def encode(docs: DataFrame, rank_file: str, pattern: str, keep: list[str] = ("doc_id",),
           text_col: str = "text", out_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """The columns ``keep`` (the text may be one) and ``out_col`` (array of int).

    A null or empty text has no ids. Repeated rows and null ids are kept as they
    are; other columns are not read. No shuffle: the file splits are the tasks.

    With ``decoded_col``, this column is what ``decode`` gives. Both steps run in one
    Python worker then; of ``decode(encode(...))``, Spark runs one for each at a time.
    """
    ship_package(docs.sparkSession)
    keep = list(keep)
    read = keep if text_col in keep else [*keep, text_col]
    to_ids = _encoder(rank_file, pattern, keep, read.index(text_col), out_col)
    fields = [*(docs.schema[c] for c in keep), T.StructField(out_col, T.ArrayType(T.IntegerType()))]
    if decoded_col is None:
        return docs.select(*read).mapInArrow(to_ids, T.StructType(fields))
    to_bytes = _decoder(rank_file, pattern, out_col, decoded_col)
    schema = T.StructType([*fields, T.StructField(decoded_col, T.BinaryType())])
    return docs.select(*read).mapInArrow(lambda batches: to_bytes(to_ids(batches)), schema)


def decode(encoded: DataFrame, rank_file: str, pattern: str, ids_col: str = "ids",
           out_col: str = "decoded") -> DataFrame:
    """Adds the raw bytes of the ids as a binary column. Null ids give null; bytes
    need not be valid UTF-8. An id that the rank file lacks raises KeyError."""
    ship_package(encoded.sparkSession)
    schema = T.StructType([*encoded.schema.fields, T.StructField(out_col, T.BinaryType())])
    return encoded.mapInArrow(_decoder(rank_file, pattern, ids_col, out_col), schema)
