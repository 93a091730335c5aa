"""Alignment of two tokenizations against brute force; the fragments' monoid."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lamina.llm import tokenalign as ta
from tests.llm.helpers import MESSY, frame

A_FILE = public_tokenizers.path("byte_bpe_50k.json")
B_FILE = public_tokenizers.path("piece_bpe_32k.model")
A, B = ta._sides(A_FILE, B_FILE)

TEXTS = [
    *MESSY, (20, "literal ▁ mark"), (21, "  two  blanks   and\ttabs\r\n\r\nends  "), (22, "<|endoftext|> and <s> </s> <unk>"),
    (23, "ünïcödé wörds, 日本語 ☕☕ é́ 😀 " * 30), (24, "x" * 5000), (25, " "), (26, "\n"), (27, "日本語テキスト" * 400),
    (28, "a1 b2 c3. D'accord, isn't it? " * 60), (29, " \n \n x"),
]


def whole_tokens(text):
    """Of a whole text, by the libraries alone."""
    raw = (" " + text).encode() if text else b""
    a = A.model.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
    b = B.model.encode(text) if text else []
    if not raw or any(b"".join(s.token_bytes[i] for i in x) != raw for s, x in ((A, a), (B, b))):
        return [], [], [], []
    return a, np.cumsum([len(A.token_bytes[i]) for i in a]).tolist(), b, np.cumsum([len(B.token_bytes[i]) for i in b]).tolist()


def brute(texts):
    docs, corpus = [], Counter()
    for doc_id, text in texts:
        a, a_ends, b, b_ends = whole_tokens(text)
        groups, i, j = [], 0, 0
        for e in sorted(set(a_ends) & set(b_ends)):
            x, y = a_ends.index(e, i) + 1, b_ends.index(e, j) + 1
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            i, j = x, y
        # a byte's pair of tokens, counted once a stretch
        of_a = np.repeat(np.arange(len(a)), np.diff([0, *a_ends]))
        of_b = np.repeat(np.arange(len(b)), np.diff([0, *b_ends]))
        links = [(a[x], b[y]) for x, y in sorted(set(zip(of_a.tolist(), of_b.tolist())))]
        corpus.update(links)
        docs.append((doc_id, a, b, groups, links))
    most = defaultdict(int)
    for (_, y), n in corpus.items():
        most[y] = max(most[y], n)
    return sorted(((i, len(a), len(b), len(g), len(li), sum(corpus[p] == most[p[1]] for p in li),
                    sum(corpus[p] for p in li), ";".join(g)) for i, a, b, g, li in docs), key=str)


def collected(df):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r["groups"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("chunk", [1 << 15, 300])
def test_align(spark, chunk):
    aligned = ta.align(frame(spark, TEXTS), A_FILE, B_FILE, chunk_bytes=chunk)
    got = collected(ta.link_scores(aligned, ta.pair_counts(aligned, B.size)))
    assert got == brute(TEXTS)
    assert aligned.select("row").distinct().count() == len(TEXTS)


def test_digest_and_empty_table(spark):
    docs = frame(spark, TEXTS)
    plain = {r.row: r["groups"] for r in ta.align(docs, A_FILE, B_FILE, chunk_bytes=500).collect()}
    for r in ta.align(docs, A_FILE, B_FILE, chunk_bytes=500, digest=True).collect():
        said = plain[r.row]
        assert r["groups"] == (hashlib.sha256(said.encode()).hexdigest() if said else "")
    none = ta.align(docs.limit(0), A_FILE, B_FILE)
    assert ta.link_scores(none, ta.pair_counts(none, B.size)).collect() == []


def test_byte_tables():
    assert len(ta.byte_alphabet()) == 256 and set(ta.byte_alphabet().values()) == set(range(256))
    assert A.token_bytes[A.model.token_to_id("Ġthe")] == b" the"
    assert B.token_bytes[B.model.piece_to_id("▁the")] == b" the" and B.token_bytes[B.model.piece_to_id("<0x0A>")] == b"\n"
    assert B.cut is not None and A.cut is not None


@pytest.mark.parametrize("side", [A, B])
def test_cut_places_are_safe(side):
    rng = random.Random(3)
    signs = ["a", "Z", "9", " ", "  ", "\n", "\t", "é", "中", "'", "s", "'s", ".", "-", "😀", " ", "the", " of"]
    for _ in range(300):
        text = " " + "".join(rng.choices(signs, k=60))
        at = ta.cuts(text, side.cut, 7)
        parts = [text[x:y] for x, y in zip(at[:-1], at[1:])]
        assert "".join(parts) == text
        got = [i for p in parts if p for i in side.encode([p])[0]]
        assert got == side.encode([text])[0]


@st.composite
def streams(draw):
    """Two tokenizations of a length, each cut into as many runs at places of its own."""
    size, runs = draw(st.integers(1, 40)), draw(st.integers(1, 5))
    out = []
    for width in (50, 60):
        ends = sorted(draw(st.sets(st.integers(1, size), max_size=12)) | {size})
        ids = [draw(st.integers(0, width - 1)) for _ in ends]
        cut = sorted(draw(st.lists(st.integers(0, len(ends)), min_size=runs - 1, max_size=runs - 1)))
        out.append((ids, ends, [0, *cut, len(ends)]))
    (a, a_ends, a_cut), (b, b_ends, b_cut) = out
    parts = [[np.array(x[p[k]:p[k + 1]], np.int64) for x, p in ((a, a_cut), (a_ends, a_cut), (b, b_cut), (b_ends, b_cut))]
             for k in range(runs)]
    return [ta.Tokens(*p) for p in parts]


def same(x, y):
    assert (x.closed, x.groups, x.n_groups, x.n_a, x.n_b) == (y.closed, y.groups, y.n_groups, y.n_a, y.n_b)
    assert x.keys.tolist() == y.keys.tolist() and x.counts.tolist() == y.counts.tolist()
    for p in ("head", "tail"):
        for n in ("a", "a_ends", "b", "b_ends"):
            assert getattr(getattr(x, p), n).tolist() == getattr(getattr(y, p), n).tolist()


@settings(max_examples=300, deadline=None)
@given(streams(), st.randoms())
def test_fragments_compose_in_any_order(parts, rng):
    whole = ta.no_tokens()
    for p in parts:
        whole = whole + p
    fragments = [ta.scan(p, A, B) for p in parts]
    while len(fragments) > 1:
        i = rng.randrange(len(fragments) - 1)
        fragments[i:i + 2] = [ta.compose(fragments[i], fragments[i + 1], A, B)]
    same(fragments[0], ta.scan(whole, A, B))
    same(ta.compose(ta.EMPTY, fragments[0], A, B), fragments[0])
    same(ta.compose(fragments[0], ta.EMPTY, A, B), fragments[0])
