"""Alignment of two tokenizations of the same bytes.

Both tokenizers encode a blank and the text (A, a byte-level BPE, is given the
blank; B, a SentencePiece model, adds it). Byte offsets where a token of each ends
cut the tokens into groups. A pair of token occurrences is linked where their byte
ranges overlap, and a pair of ids counts as often as links hold it in the corpus.

A text of up to ``CHUNK_BYTES`` is aligned where it is read. A longer one is cut
into chunks that tasks of their own encode: each tokenizer's stream is cut at the
first place behind a multiple of the chunk's size that no token of *this*
tokenizer can cross, so that the two streams of a chunk need not begin or end
together. What a chunk knows is a ``Fragment``: a head that is open on the left (up
to its first common end), closed groups, and a tail that is open on the right.
Fragments compose associatively (``compose``; ``EMPTY`` is the identity), and
rounds of grouped Spark tasks reduce them as a tree, some neighbours a task.

Safe places. A: between an ASCII letter or digit and a blank before something else
than a blank; its split pattern never crosses them. B: between a character that
isn't a blank and a blank before something else than one, as no piece of the model
holds the mark of a blank behind another character (checked when the model is
loaded; a model with such a piece is not cut).
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import ship_package, write_and_read
from lamina.plans.joins import sized_broadcast

#: Longer texts are cut; also the bytes that one numpy pass aligns.
CHUNK_BYTES = 1 << 15
PASS_BYTES = 1 << 19
#: Neighbouring fragments that one task composes in a round.
FAN_IN = 8
#: Units that a worker remembers, and that it learns at once.
CACHE_UNITS = 200_000
LEARN_UNITS = 8192
#: Bytes of a decimal id and the sign behind it.
SIGN_WIDTH = 8
MARK = "▁"
#: Signs at a unit's end that are tokens of their own behind letters.
SIGNS = ".,;:!?"

_CUT_A = re.compile(r"[0-9A-Za-z](?= [^ ])")
_CUT_B = re.compile(rf"[^ {MARK}](?= [^ {MARK}])")
_OTHER_SPACE = re.compile(r"[^\S \n]")
_UNIT = re.compile(r" [^ \n]+|\n+[^ \n]*")
_BYTE_PIECE = re.compile(r"<0x([0-9A-Fa-f]{2})>")


# --- tokenizers -----------------------------------------------------------------

def byte_alphabet() -> dict[str, int]:
    """The sign that stands for each byte in a byte-level vocabulary: printable
    Latin-1 characters stand for themselves, the others follow from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    signs = {chr(b): b for b in own}
    signs.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if chr(b) not in signs)})
    return signs


class Side:
    """One tokenizer: ids of texts, the bytes of every id, and the decimal ids with the
    sign behind them, inside a group and (``size`` further) at its end."""

    def __init__(self, token_bytes: list[bytes], cut: re.Pattern | None, ends: str):
        self.token_bytes, self.cut, self.size = token_bytes, cut, len(token_bytes)
        self.lengths = np.array([len(t) for t in token_bytes], np.int64)
        self.signs = np.array([f"{i}{sign}" for sign in (",", ends) for i in range(self.size)], f"S{SIGN_WIDTH}")
        if self.size > 10 ** (SIGN_WIDTH - 1):
            raise ValueError("the vocabulary is too large")

    def faithful(self, ids: list[int], raw: bytes) -> bool:
        return b"".join(map(self.token_bytes.__getitem__, ids)) == raw

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that are whole or begin at a safe place, with a blank or, behind
        another character than a blank, with a line feed."""
        raise NotImplementedError


class ByteLevelSide(Side):
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True      # their strings are plain text
        self.model = tokenizer
        byte = byte_alphabet()
        added = {i: t.content for i, t in tokenizer.get_added_tokens_decoder().items()}
        entries = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]
        super().__init__([t.encode() if i in added else bytes(byte[c] for c in t)
                          for i, t in enumerate(entries)], _CUT_A, "|")

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]


class PieceSide(Side):
    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        known = [b"" if self.model.is_control(i) or self.model.is_unknown(i)
                 else bytes([int(m.group(1), 16)]) if (m := _BYTE_PIECE.fullmatch(p)) and self.model.is_byte(i)
                 else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        crossing = any(re.search(f"[^{MARK}]{MARK}|.\n|\n.", p) for p in pieces)
        super().__init__(known, None if crossing else _CUT_B, ";")
        self.mark = self.model.piece_to_id(MARK)
        #: signs that no piece holds behind a letter
        self.apart = {c for c in SIGNS if not any(c in p[1:] and p[p.index(c, 1) - 1].isalpha() for p in pieces)}

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The model adds a blank in front; it is a token alone before a line feed."""
        out = self.model.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
        for i, t in enumerate(texts):
            if t[0] != " ":
                if out[i][0] != self.mark:
                    raise ValueError("no piece of its own for a blank")
                out[i] = out[i][1:]
        return out


@functools.lru_cache(maxsize=2)
def _sides(path_a: str, path_b: str) -> tuple[ByteLevelSide, PieceSide]:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    return ByteLevelSide(path_a), PieceSide(path_b)


@functools.lru_cache(maxsize=2)
def _units(path_a: str, path_b: str) -> Units:
    """A Python worker's units: what it has learned serves its next tasks, too."""
    return Units(*_sides(path_a, path_b))


def vocabulary_size(piece_file: str) -> int:
    """Ids of B, which a pair's number is made with."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_file).vocab_size()


# --- fragments ------------------------------------------------------------------

@dataclass
class Tokens:
    """Tokens of both streams and where in the text their bytes end."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray

    def __len__(self) -> int:
        return len(self.a) + len(self.b)

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(*(np.concatenate((getattr(self, n), getattr(other, n))) for n in ("a", "a_ends", "b", "b_ends")))

    def until(self, end: int) -> tuple[Tokens, Tokens]:
        """Those that end at ``end`` or before it, and the others."""
        i, j = np.searchsorted(self.a_ends, end, "right"), np.searchsorted(self.b_ends, end, "right")
        return (Tokens(self.a[:i], self.a_ends[:i], self.b[:j], self.b_ends[:j]),
                Tokens(self.a[i:], self.a_ends[i:], self.b[j:], self.b_ends[j:]))


def no_tokens() -> Tokens:
    return Tokens(*(np.zeros(0, np.int64) for _ in range(4)))


class Ends:
    """Where tokens end, as marks on the bytes that they span: every question about
    places is then a look-up in a running count."""

    def __init__(self, t: Tokens):
        tops = [x[-1] for x in (t.a_ends, t.b_ends) if len(x)]
        self.base = min((x[0] for x in (t.a_ends, t.b_ends) if len(x)), default=0)
        marks = np.zeros(max(tops, default=-1) - self.base + 1, np.uint8)
        marks[t.a_ends - self.base] = 1
        marks[t.b_ends - self.base] += 2
        self.marks = marks

    def common(self) -> np.ndarray:
        return np.flatnonzero(self.marks == 3) + self.base

    def all(self) -> np.ndarray:
        return np.flatnonzero(self.marks) + self.base

    def before(self, hit: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How many marks of ``hit`` lie before each end."""
        at = ends - self.base
        return np.cumsum(hit, dtype=np.int32)[at] - hit[at]


def group_texts(t: Tokens, ends: Ends, a: Side, b: Side, splits: np.ndarray) -> list[bytes]:
    """The groups `a1,a2|b1;` of tokens that begin and end at common ends, one text
    for each part that ends at one of ``splits`` (some of the common ends)."""
    both = ends.marks == 3
    group_a, group_b = ends.before(both, t.a_ends), ends.before(both, t.b_ends)
    a_last, b_last = both[t.a_ends - ends.base], both[t.b_ends - ends.base]
    a_of, b_of = (np.concatenate(([0], np.flatnonzero(x) + 1)) for x in (a_last, b_last))   # tokens before a group
    out = np.empty(len(t), a.signs.dtype)
    out[np.arange(len(t.a)) + b_of[group_a]] = a.signs[t.a + a_last * a.size]
    out[np.arange(len(t.b)) + a_of[group_b + 1]] = b.signs[t.b + b_last * b.size]
    flat = out.view(np.uint8)
    signs = np.flatnonzero(flat)
    raw = flat[signs].tobytes()
    group = ends.before(both, splits) + 1
    cuts = np.searchsorted(signs, (a_of[group] + b_of[group]) * SIGN_WIDTH)
    return [raw[x:y] for x, y in zip([0, *cuts[:-1].tolist()], cuts.tolist())]


def linked(t: Tokens, ends: Ends, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Every link as a * width + b, and where its overlap ends: the stretch between two
    neighbouring ends of either stream lies in one token of each."""
    at = ends.all()
    return (t.a[ends.before(ends.marks & 1, at)] * width + t.b[ends.before(ends.marks >> 1, at)]), at


@dataclass
class Fragment:
    """What consecutive chunks of a document know. Without a common end (``closed``)
    all tokens are the head's."""

    head: Tokens = field(default_factory=no_tokens)
    closed: bool = False
    groups: str = ""                     # the closed groups' text, each ending in ';'
    n_groups: int = 0
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))     # their links
    counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    n_a: int = 0                         # tokens of the closed groups
    n_b: int = 0
    tail: Tokens = field(default_factory=no_tokens)

    def close(self, t: Tokens, a: Side, b: Side) -> Fragment:
        """Behind the closed groups, tokens that begin and end at common ends."""
        if not len(t):
            return self
        ends = Ends(t)
        common = ends.common()
        self._add(*np.unique(linked(t, ends, b.size)[0], return_counts=True))
        self.groups += group_texts(t, ends, a, b, common[-1:])[0].decode()
        self.n_groups += len(common)
        self.n_a, self.n_b = self.n_a + len(t.a), self.n_b + len(t.b)
        return self

    def _add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys, at = np.unique(np.concatenate((self.keys, keys)), return_inverse=True)
        self.counts = np.bincount(at, np.concatenate((self.counts, counts)), len(self.keys)).astype(np.int64)

    def follow(self, other: Fragment) -> Fragment:
        """Behind the closed groups, those of another fragment."""
        self._add(other.keys, other.counts)
        self.groups += other.groups
        self.n_groups += other.n_groups
        self.n_a, self.n_b = self.n_a + other.n_a, self.n_b + other.n_b
        return self


EMPTY = Fragment()


def scan(t: Tokens, a: Side, b: Side) -> Fragment:
    """The fragment of tokens of which nothing else is known."""
    ends = Ends(t).common()
    if not len(ends):
        return Fragment(head=t)
    head, rest = t.until(ends[0])
    inner, tail = rest.until(ends[-1])
    return Fragment(head=head, closed=True, tail=tail).close(inner, a, b)


def compose(left: Fragment, right: Fragment, a: Side, b: Side) -> Fragment:
    """The fragment of both. Only their open parts are looked at again: what is left
    of the right one's first common end and right of the left one's last."""
    middle = scan((left.tail if left.closed else left.head) + right.head, a, b)
    if left.closed:
        out = Fragment(head=left.head, closed=True).follow(left)
        if not middle.closed:
            out.tail = middle.head
            return out
        out.close(middle.head, a, b)
    else:
        out = Fragment(head=middle.head, closed=middle.closed)
        if not middle.closed:
            return out
    out.follow(middle)
    if right.closed:
        out.follow(right)
    out.tail = right.tail if right.closed else middle.tail
    return out


# --- texts ----------------------------------------------------------------------

ALIGNED = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
           "pairs array<struct<pair:bigint,n:int>>")
_PAIRS = pa.struct([("pair", pa.int64()), ("n", pa.int32())])


def _batch(rows, doc_ids, n_a, n_b, n_groups, n_links, groups, lengths, keys, counts) -> pa.RecordBatch:
    offsets = np.concatenate(([0], np.cumsum(np.asarray(lengths, np.int64)))).astype(np.int32)
    pairs = pa.StructArray.from_arrays([pa.array(keys, pa.int64()), pa.array(counts, pa.int32())], fields=list(_PAIRS))
    return pa.RecordBatch.from_arrays(
        [pa.array(rows, pa.int64()), pa.array(doc_ids, pa.int64()), *(pa.array(x, pa.int64())
         for x in (n_a, n_b, n_groups, n_links)), pa.array(groups, pa.string()), pa.ListArray.from_arrays(offsets, pairs)],
        names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs"])


def _said(groups: bytes, digest: bool) -> str:
    return hashlib.sha256(groups).hexdigest() if digest else groups.decode()


class Units:
    """Aligns each distinct unit once. A unit is a blank and the word behind it, or line
    feeds and what follows them, up to the next blank or line feed; where both
    neighbours of a blank aren't white space (nor B's mark of a blank), no token of
    either tokenizer crosses the place before a unit, so that a text's groups are
    those of its units. In the same way a word of letters and a sign behind it fall
    into the two. Units are remembered in two generations of ``most``; the older one is
    dropped when the younger one is full."""

    def __init__(self, a: Side, b: Side, most: int = CACHE_UNITS):
        self.a, self.b, self.most = a, b, most if b.cut is not None else 0
        # unit (without its blank) -> its groups' text, its links as 64-bit integers, its tokens of A
        self.known: dict[str, tuple[bytes, bytes, int]] = {}
        self.older: dict[str, tuple[bytes, bytes, int]] = {}
        self.signs: dict[str, tuple[bytes, bytes, int]] = {}
        if self.most:
            for c in sorted(b.apart):
                (x,), (y,) = a.encode([" a" + c]), b.encode([" a" + c])
                if a.token_bytes[x[-1]] == b.token_bytes[y[-1]] == c.encode():
                    key = np.array([x[-1] * b.size + y[-1]], "<i8")
                    self.signs[c] = f"{x[-1]}|{y[-1]};".encode(), key.tobytes(), 1

    def divides(self, text: str) -> bool:
        """Whether blanks and line feeds divide a text into units."""
        return bool(self.most and text and text[0] not in " \n" and text[-1] != " " and "  " not in text
                    and " \n" not in text and "\n " not in text and MARK not in text
                    and (text.replace("\n", " ").isprintable() or not _OTHER_SPACE.search(text)))

    @staticmethod
    def divided(text: str) -> list[str]:
        if "\n\n" in text:
            return [u.removeprefix(" ") for u in _UNIT.findall(" " + text)]
        return text.replace("\n", " \n").split(" ")

    def learn(self, words: set[str]) -> None:
        if len(self.known) + len(words) > self.most:
            self.older, self.known = self.known, {}
        ended = {w for w in words if w[-1] in self.signs and w[:-1].lstrip("\n").isalpha()}
        need = ((words - ended) | {w[:-1] for w in ended}) - self.known.keys()
        seen = need & self.older.keys()
        self.known.update(zip(seen, map(self.older.__getitem__, seen)))
        new = list(need - seen)
        for at in range(0, len(new), LEARN_UNITS):
            lot = new[at:at + LEARN_UNITS]
            good, t, splits = encoded([w if w[0] == "\n" else " " + w for w in lot], self.a, self.b)
            if len(good) < len(lot):
                raise ValueError("a unit's tokens aren't its bytes")
            ends = Ends(t)
            keys, places = linked(t, ends, self.b.size)
            raw = keys.astype("<i8").tobytes()
            cut = (np.searchsorted(places, splits, "right") * 8).tolist()
            n_a = np.diff(np.searchsorted(t.a_ends, splits, "right"), prepend=0).tolist()
            for w, said, x, y, n in zip(lot, group_texts(t, ends, self.a, self.b, splits), [0, *cut[:-1]], cut, n_a):
                self.known[w] = said, raw[x:y], n
        for w in ended:
            self.known[w] = tuple(x + y for x, y in zip(self.known[w[:-1]], self.signs[w[-1]]))

    def look_up(self, texts: list[list[str]]) -> list[list[tuple[bytes, bytes, int]]]:
        """The units of texts, given as their words."""
        get = self.known.get
        got = [list(map(get, words)) for words in texts]
        missing = {w for words, own in zip(texts, got) if None in own for w, x in zip(words, own) if x is None}
        if missing:
            self.learn(missing)
            get = self.known.__getitem__
            got = [own if None not in own else [get(w) if x is None else x for w, x in zip(words, own)]
                   for words, own in zip(texts, got)]
        return got


def encoded(whole: list[str], a: Side, b: Side) -> tuple[list[int], Tokens, np.ndarray]:
    """Texts with their blank in front: those whose tokens' bytes they are, these
    tokens one text after another, and where the texts end."""
    good = list(range(len(whole)))
    both = []
    reach = np.cumsum([len(t.encode()) for t in whole])
    raw = "".join(whole).encode()
    for side in (a, b):
        ids = side.encode(whole)
        flat = list(itertools.chain.from_iterable(ids))
        n = np.array([len(x) for x in ids], np.int64)
        ends = np.cumsum(side.lengths[flat]) if flat else np.zeros(0, np.int64)
        # all at once, and text by text only where that fails
        if not (np.array_equal(np.concatenate(([0], ends))[np.cumsum(n)], reach) and side.faithful(flat, raw)):
            good = [i for i in good if whole[i] and side.faithful(ids[i], whole[i].encode())]
        both.append((ids, flat, n))
    if not good:
        return good, no_tokens(), np.zeros(0, np.int64)
    streams = []
    for side, (ids, flat, n) in zip((a, b), both):
        flat = np.array(flat if len(good) == len(whole) else
                        list(itertools.chain.from_iterable(ids[i] for i in good)), np.int64)
        streams += [flat, np.cumsum(side.lengths[flat])]
    t = Tokens(*streams)
    return good, t, t.a_ends[np.cumsum(both[0][2][good]) - 1]


def align_texts(texts: list[str | None], units: Units):
    """Of whole texts: per text four counts and the groups' text, and the links of
    all of them, as (text, pair, how often) in ascending order."""
    a, b = units.a, units.b
    counts = np.zeros((4, len(texts)), np.int64)
    groups = [b""] * len(texts)
    keys, doc = [], []
    plain = [i for i, t in enumerate(texts) if t and units.divides(t)]
    for i, own in zip(plain, units.look_up([units.divided(texts[i]) for i in plain])):
        said, raw, n_a = zip(*own)
        groups[i] = b"".join(said)[:-1]
        links = np.frombuffer(b"".join(raw), "<i8")
        n_groups = groups[i].count(b";") + 1
        # neighbouring ends of either stream: as many as all ends less the common ones
        counts[:, i] = sum(n_a), len(links) + n_groups - sum(n_a), n_groups, len(links)
        keys.append(links)
        doc.append(i)
    others = [i for i in range(len(texts)) if texts[i] and not groups[i]]
    good, t, splits = encoded([" " + texts[i] for i in others], a, b)
    if good:
        ends = Ends(t)
        links, at = linked(t, ends, b.size)
        cut = np.searchsorted(at, splits, "right")
        n_a = np.diff(np.searchsorted(t.a_ends, splits, "right"), prepend=0)
        n_b = np.diff(np.searchsorted(t.b_ends, splits, "right"), prepend=0)
        for j, (i, said) in enumerate(zip([others[g] for g in good], group_texts(t, ends, a, b, splits))):
            groups[i] = said[:-1]
            own = links[cut[j - 1] if j else 0:cut[j]]
            counts[:, i] = n_a[j], n_b[j], n_a[j] + n_b[j] - len(own), len(own)
            keys.append(own)
            doc.append(i)
    if not keys:
        return counts, groups, *(np.zeros(0, np.int64) for _ in range(3))
    # one number a link, its text before its pair; wide enough, as a pass is short
    bits = (a.size * b.size - 1).bit_length()
    of = np.repeat(np.array(doc, np.int64), [len(x) for x in keys])
    both, n = np.unique((of << bits) | np.concatenate(keys), return_counts=True)
    return counts, groups, both >> bits, both & ((1 << bits) - 1), n


def _whole(docs: DataFrame, path_a: str, path_b: str, digest: bool) -> DataFrame:
    """The texts that no one needs to cut."""
    def run(batches):
        row = TaskContext.get().partitionId() << 33
        units = _units(path_a, path_b)
        for batch in batches:
            for lot in _lots(batch.column(1).to_pylist()):
                doc_ids = batch.column(0)[lot.start:lot.stop]
                texts = batch.column(1)[lot.start:lot.stop].to_pylist()
                counts, groups, doc, keys, n = align_texts(texts, units)
                said = [_said(g, digest) if g else "" for g in groups]
                yield _batch(np.arange(row, row + len(texts)), doc_ids, *counts, said,
                             np.bincount(doc, minlength=len(texts)), keys, n)
                row += len(texts)

    return docs.mapInArrow(run, ALIGNED)


def _lots(texts: list[str | None]) -> Iterator[range]:
    first = held = 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= PASS_BYTES or i + 1 == len(texts):
            yield range(first, i + 1)
            first, held = i + 1, 0


def cuts(text: str, cut: re.Pattern | None, chunk: int) -> list[int]:
    """Where the chunks of one stream begin, and the end; chunks may be empty."""
    n = max(1, -(-len(text) // chunk))
    out = [0]
    for k in range(1, n):
        if out[-1] > k * chunk:
            out.append(out[-1])
            continue
        m = cut.search(text, k * chunk) if cut else None
        out.append(m.end() if m else len(text))
    return [*out, len(text)]


CHUNKS = "row long, doc_id long, k long, chunks long, a_at long, a string, b_at long, b string"


def _chunks(docs: DataFrame, path_a: str, path_b: str, chunk: int) -> DataFrame:
    """The chunks of the long texts; ``a_at`` and ``b_at`` are byte offsets."""
    def run(batches):
        a, b = _sides(path_a, path_b)
        for batch in batches:
            for i in range(batch.num_rows):
                row, doc_id, text = (c[i].as_py() for c in batch.columns)
                text = " " + text
                at = {}
                for name, side in (("a", a), ("b", b)):
                    begins = cuts(text, side.cut, chunk)
                    parts = [text[x:y] for x, y in zip(begins[:-1], begins[1:])]
                    at[name] = parts, np.concatenate(([0], np.cumsum([len(p.encode()) for p in parts])))
                n = len(at["a"][0])
                for k in range(n):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row]), pa.array([doc_id], pa.int64()), pa.array([k]), pa.array([n]),
                         pa.array([at["a"][1][k]]), pa.array([at["a"][0][k]]),
                         pa.array([at["b"][1][k]]), pa.array([at["b"][0][k]])],
                        names=["row", "doc_id", "k", "chunks", "a_at", "a", "b_at", "b"])

    rows = docs.select((-F.monotonically_increasing_id() - 1).alias("row"), "doc_id", "text")
    return rows.mapInArrow(run, CHUNKS)


_TOKENS = ("a", "a_ends", "b", "b_ends")
_LISTS = [*(f"head_{n}" for n in _TOKENS), "keys", "counts", *(f"tail_{n}" for n in _TOKENS)]
FRAGMENTS = ("row long, doc_id long, k long, faithful boolean, closed boolean, groups string, n_groups long, "
             "n_a long, n_b long, " + ", ".join(f"{n} array<long>" for n in _LISTS))


def _packed(row: int, doc_id: int | None, k: int, faithful: bool, f: Fragment) -> dict:
    own = {f"{part}_{n}": getattr(getattr(f, part), n) for part in ("head", "tail") for n in _TOKENS}
    return {"row": row, "doc_id": doc_id, "k": k, "faithful": faithful, "closed": f.closed, "groups": f.groups,
            "n_groups": f.n_groups, "n_a": f.n_a, "n_b": f.n_b, "keys": f.keys, "counts": f.counts, **own}


def _table(rows: list[dict]) -> dict[str, list]:
    return {n: [r[n] for r in rows] for n in rows[0]}


def _unpacked(r: dict) -> Fragment:
    part = {p: Tokens(*(np.array(r[f"{p}_{n}"], np.int64) for n in _TOKENS)) for p in ("head", "tail")}
    return Fragment(part["head"], r["closed"], r["groups"], r["n_groups"], np.array(r["keys"], np.int64),
                    np.array(r["counts"], np.int64), r["n_a"], r["n_b"], part["tail"])


def chunk_fragment(a_text: str, a_at: int, b_text: str, b_at: int, units: Units) -> Fragment | None:
    """The fragment of a chunk's two streams; None where tokens aren't their bytes.

    What both streams hold is divided into units where blanks allow it: their product
    is made of remembered closed groups. In front of it is what only B's stream holds
    (it is cut at more places, so that it begins no later), behind it what only A's
    does; both are safe places of either tokenizer then.
    """
    a, b = units.a, units.b
    raw_a, raw_b = a_text.encode(), b_text.encode()
    begin, end = a_at - b_at, b_at + len(raw_b) - a_at
    shared = raw_a[:end].decode(errors="replace") if begin >= 0 and 0 < end <= len(raw_a) else ""
    behind = raw_a[end:].decode() if shared else ""
    if not (shared and shared[0] == " " and units.divides(shared[1:]) and not (behind and shared[-1].isspace())
            and not behind[1:2].isspace()):
        return _scanned(a_text, a_at, b_text, b_at, a, b)
    first, *words = units.divided(shared[1:])
    parts = [_scanned("", a_at, raw_b[:begin].decode(), b_at, a, b),
             _scanned(" " + first, a_at, " " + first, a_at, a, b),
             _scanned(behind, a_at + end, "", a_at + end, a, b)]
    if None in parts:
        return None
    out = compose(parts[0], parts[1], a, b)
    if words:
        own, = units.look_up([words])
        said, raw, n_a = zip(*own)
        keys, counts = np.unique(np.frombuffer(b"".join(raw), "<i8"), return_counts=True)
        text = b"".join(said).decode()
        n = text.count(";")
        out.follow(Fragment(closed=True, groups=text, n_groups=n, keys=keys, counts=counts, n_a=sum(n_a),
                            n_b=int(counts.sum()) + n - sum(n_a)))
    return compose(out, parts[2], a, b)


def _scanned(a_text: str, a_at: int, b_text: str, b_at: int, a: Side, b: Side) -> Fragment | None:
    own = []
    for side, text, at in ((a, a_text, a_at), (b, b_text, b_at)):
        ids = side.encode([text])[0] if text else []
        if not side.faithful(ids, text.encode()):
            return None
        ids = np.array(ids, np.int64)
        own += [ids, np.cumsum(side.lengths[ids]) + at]
    return scan(Tokens(*own), a, b)


def _fragments(chunks: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Each chunk's fragment."""
    def run(batches):
        units = _units(path_a, path_b)
        for batch in batches:
            for c in batch.to_pylist():
                f = chunk_fragment(c["a"], c["a_at"], c["b"], c["b_at"], units)
                yield pa.RecordBatch.from_pydict(_table([_packed(
                    c["row"], c["doc_id"], c["k"], f is not None, f or EMPTY)]), schema=_schema())

    return chunks.mapInArrow(run, FRAGMENTS)


def _schema() -> pa.Schema:
    kinds = {"faithful": pa.bool_(), "closed": pa.bool_(), "groups": pa.string()}
    names = [part.split(" ")[0] for part in FRAGMENTS.split(", ")]
    return pa.schema([(n, pa.list_(pa.int64()) if n in _LISTS else kinds.get(n, pa.int64())) for n in names])


def _reduced(fragments: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One round: FAN_IN neighbours become one."""
    def run(table: pa.Table) -> pa.Table:
        a, b = _sides(path_a, path_b)
        rows = sorted(table.to_pylist(), key=lambda r: r["k"])
        good = all(r["faithful"] for r in rows)
        f = EMPTY
        for r in rows if good else ():
            f = compose(f, _unpacked(r), a, b)
        first = rows[0]
        return pa.Table.from_pydict(
            _table([_packed(first["row"], first["doc_id"], first["k"] // FAN_IN, good, f)]), schema=_schema())

    return fragments.withColumn("__lot", F.floor(F.col("k") / FAN_IN)).groupBy("row", "__lot").applyInArrow(
        lambda table: run(table.drop_columns(["__lot"])), FRAGMENTS)


def _finished(fragments: DataFrame, path_a: str, path_b: str, digest: bool) -> DataFrame:
    """A document's one fragment has nothing on its left: its head is a group."""
    def run(batches):
        a, b = _sides(path_a, path_b)
        for batch in batches:
            for r in batch.to_pylist():
                f = Fragment()
                if r["faithful"]:
                    own = _unpacked(r)
                    f.close(own.head, a, b).follow(own)
                said = _said(f.groups[:-1].encode(), digest) if f.groups else ""
                yield _batch([r["row"]], [r["doc_id"]], [f.n_a], [f.n_b], [f.n_groups], [f.counts.sum()], [said],
                             [len(f.keys)], f.keys, f.counts)

    return fragments.mapInArrow(run, ALIGNED)


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
          chunk_bytes: int = CHUNK_BYTES, digest: bool = False) -> DataFrame:
    """One row per document: row (unique), doc_id, n_a, n_b, n_groups, n_links, groups
    (`a1,a2|b1;a3|b2,b3`, or with ``digest`` its SHA-256 in hex; empty without tokens)
    and pairs (a * size of B + b, and how many links hold it). Written below
    spark.checkpoint.dir.

    Null and empty texts, and those whose tokens' bytes aren't a blank and the text
    (a text that holds the mark of a blank itself), have no tokens: counts of 0. Null
    and repeated ids keep their rows; no documents, no rows; other columns aren't
    read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = F.octet_length(F.coalesce("text", F.lit("")))
    short = _whole(rows.filter(size <= chunk_bytes), path_a, path_b, digest)
    chunks = write_and_read(_chunks(rows.filter(size > chunk_bytes), path_a, path_b, chunk_bytes), "align-chunks")
    most = chunks.agg(F.max("chunks")).first()[0]
    if most is None:
        return write_and_read(short, "aligned")
    fragments = _fragments(chunks.repartition("row", "k"), path_a, path_b)
    while most > 1:
        fragments, most = _reduced(fragments, path_a, path_b), -(-most // FAN_IN)
    return write_and_read(short.unionByName(_finished(fragments, path_a, path_b, digest)), "aligned")


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """The corpus's id pairs: pair, count, and best (no pair of the same id of B counts
    more). Written below spark.checkpoint.dir."""
    counts = write_and_read(aligned.select(F.explode("pairs").alias("p")).groupBy("p.pair").agg(
        F.sum("p.n").alias("count")), "pair-counts")
    counts = counts.withColumn("b", F.pmod("pair", F.lit(size_b)))
    best = sized_broadcast(counts.groupBy("b").agg(F.max("count").alias("most")), derived=True)  # a row an id of B
    return write_and_read(counts.join(best, "b").select(
        "pair", "count", (F.col("count") == F.col("most")).alias("best")), "pairs")


def link_scores(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """``aligned`` less its pairs, with n_best (links whose pair is its B id's best) and
    count_sum (of the pairs' counts over the links). The pairs of a document meet the
    corpus's counts by a join, broadcast where those are small, and are summed in the
    task that holds them."""
    links = aligned.select("row", F.explode("pairs").alias("p")).select("row", "p.pair", "p.n")
    sums = links.join(sized_broadcast(counts), "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("count")).alias("count_sum"))
    return (aligned.drop("pairs").join(sums, "row", "left")
            .withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_best", "count_sum")}))
