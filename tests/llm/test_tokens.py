"""Byte-level BPE and token-id files."""

import base64
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import public_tokenizers as P
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lamina.llm import bpe, idstore
from lamina.llm.queries import RANK_FILE, TOKENIZER_FILE
from tests.llm.helpers import MESSY, frame

SIGNS = ["a", "B", "é", "1", " ", "  ", "\n", "\n\n", ".", ",", "'", "s", "'t", "_", "#", "!!", "ß", "²", "\t",
         "\xa0", "中", "́", "😀", "don't", "\x85", "\x1c"]


@pytest.fixture(scope="module")
def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANK_FILE, "rb"))}
    return tiktoken.Encoding("test", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pieces_encode_like_the_whole(encoding):
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice(SIGNS) for _ in range(rng.randrange(60)))
        got = [i for p, space in bpe.safe_pieces(text, 5) for i in bpe._encodings(RANK_FILE, P.PATTERN)[space].encode_ordinary(p)]
        assert got == encoding.encode_ordinary(text)


@pytest.mark.parametrize("text", ["x" + " " * 900, "x" + " " * 900 + "y", "\n" * 700 + " y", "a" * 3000 + " " * 600 + "\t.",
                                  ("ab " * 400_000)])
def test_long_runs(encoding, text):
    assert bpe.encode_text(text, RANK_FILE, P.PATTERN) == encoding.encode_ordinary(text)


def test_space_run_that_the_library_alone_cannot_match():
    ids = bpe.encode_text(" " * 1_000_000 + "x", RANK_FILE, P.PATTERN)
    assert bpe._encodings(RANK_FILE, P.PATTERN)[0].decode(ids) == " " * 1_000_000 + "x"


def test_second_encoding_is_made_for_long_space_alone():
    bpe._encoding.cache_clear()
    bpe.encode_text("a text " * 200, RANK_FILE, P.PATTERN)
    assert bpe._encoding.cache_info().currsize == 1
    bpe.encode_text("x" + " " * 900, RANK_FILE, P.PATTERN)
    assert bpe._encoding.cache_info().currsize == 2


def test_encode_decode_messy(spark, encoding):
    docs = frame(spark, MESSY)
    got = bpe.decode(bpe.encode(docs, RANK_FILE, P.PATTERN), RANK_FILE, P.PATTERN).collect()
    want = Counter((i, tuple(encoding.encode_ordinary(t or "")), (t or "").encode()) for i, t in MESSY)
    assert Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in got) == want
    assert bpe.encode(docs.limit(0), RANK_FILE, P.PATTERN).count() == 0


def test_decoded_beside_the_ids(spark):
    docs = frame(spark, MESSY)
    both = bpe.encode(docs, RANK_FILE, P.PATTERN, decoded_col="decoded")
    apart = bpe.decode(bpe.encode(docs, RANK_FILE, P.PATTERN), RANK_FILE, P.PATTERN)
    assert both.schema == apart.schema
    assert Counter(map(str, both.collect())) == Counter(map(str, apart.collect()))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**40), max_size=300).map(sorted))
def test_elias_fano(values):
    raw = idstore.ef_encode(np.array(values, np.uint64))
    ef = idstore.EliasFano(raw)
    assert ef.all().tolist() == values
    assert [ef.select(i) for i in range(len(values))] == values
    if len(values) > 50:   # about 2 + log2(u / n) bits a value, and the header
        assert len(raw) * 8 <= len(values) * (3 + np.log2((values[-1] + 1) / len(values) + 1)) + 200


def test_unit_encoder_is_the_library():
    library = Tokenizer.from_file(TOKENIZER_FILE)
    encoder = idstore.UnitEncoder(TOKENIZER_FILE, "<u2", cache_units=200)
    rng = random.Random(2)
    for _ in range(60):
        texts = ["".join(rng.choice([*SIGNS, "<|endoftext|>"]) for _ in range(rng.randrange(30))) for _ in range(20)]
        got = [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(texts)]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_unknown_units_share_texts_for_the_library(monkeypatch):
    library = Tokenizer.from_file(TOKENIZER_FILE)
    encoder = idstore.UnitEncoder(TOKENIZER_FILE, "<u2")
    rng, given = random.Random(3), []
    run = encoder._library
    monkeypatch.setattr(encoder, "_library", lambda texts: given.extend(texts) or run(texts))
    word = lambda: "".join(rng.choice("abcé1'.!\n中s") for _ in range(rng.randrange(1, 9))).strip("\n") or "x"
    texts = [" ".join(word() for _ in range(100)) + rng.choice(["", "\n", " "]) for _ in range(30)] + ["", " a", "\n"]
    got = [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    distinct = len({w for t in texts for w in t.split(" ")})
    assert distinct > 1500 and len(given) < distinct / 4


def test_files_messy(spark, monkeypatch):
    library = Tokenizer.from_file(TOKENIZER_FILE)
    docs = frame(spark, MESSY)
    manifest = idstore.write(docs, TOKENIZER_FILE, partitions=3)
    got = sorted(map(tuple, idstore.read_index(spark, manifest).collect()), key=lambda r: r[1])
    start, want = 0, []
    for i, t in sorted(MESSY, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want
    file = idstore.TokenFile(manifest.orderBy("part", "seq").first()["file"])
    assert file.document(0).tolist() == library.encode(MESSY[0][1], add_special_tokens=False).ids + [0]
    empty = idstore.write(docs.filter(F.lit(False)), TOKENIZER_FILE, partitions=2)
    assert idstore.read_index(spark, empty).count() == 0
