"""Fixtures and brute-force versions for the corpus operators."""

import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = ("doc_id long, text string, lang string, source string, n_chars long, ids string, score string, "
        "component_id string, class string, bucket string, kind string, spans string, copy string, doc string, decoded string")


def frame(spark, rows, lang="en"):
    """documents with columns whose names clash with those of the operators."""
    full = [(i, t, lang, "s", None if t is None else len(t), *["x"] * 10) for i, t in rows]
    return spark.createDataFrame(full, DOCS)


LONG = "word " * 30_000 + "x" * 20_000 + " " * 3_000 + "\n" + "end"

MESSY = [
    (None, "a document without an id, but with words in it, some of them twice, some of them once"),
    (None, "a document without an id, but with words in it, some of them twice, some of them once"),
    (1, None), (2, ""), (3, " \n\t "), (4, "ONE"), (5, "Zwei Wörter"), (6, "naïve café ☕ 中文字 — dash 😀"),
    (7, LONG), (8, "the same text again and again, the same text again and again, and then an end of it"),
    (9, "the same text again and again, the same text again and again, and then an end of it"),
    (9, "the same text again and again, the same text again and again, and then an end of it"),
    (9, "another text with the same id as the one above it, which is not the same text at all"),
    (-5, "a negative id\r\nwith line ends\r\n\r\nand a tab\there"), (10, "\x00\x01 control \x1f signs \x7f"),
]


def words13(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def shingles(text, k=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
