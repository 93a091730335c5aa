"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training sums n-gram counts by (language, bucket) over all training rows: each
task adds up its rows in numpy and emits one row per bucket it has seen, Spark
adds the tasks' rows. The log-probability matrix has ``buckets`` x languages
cells, whatever the corpus' size; it is checked against ``MAX_CELLS`` before it
is broadcast. Scoring looks up the n-grams of a batch of whole texts in numpy.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm.common import ship_package, text_chunks

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
UNKNOWN = "und"
#: At most so many cells of the broadcast matrix (64 MB of doubles).
MAX_CELLS = 1 << 23
_BLANK = 32


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point to its lower-case letter; everything else to a blank."""
    table = np.full(0x110000, _BLANK, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def _letter_codes(chunk) -> tuple[np.ndarray, np.ndarray]:
    """Letters and blanks of a chunk, and where each row's begin; a blank before
    and after each row, runs of blanks made one."""
    raw = chunk.data
    starts_char = (raw & 0xC0) != 0x80
    at = np.concatenate(([0], np.cumsum(starts_char)))[chunk.offsets]
    codes = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    codes = _letters()[codes]
    # one blank is put before each row, and one after the last
    n = len(codes) + chunk.rows + 1
    put = at + np.arange(len(at))
    out = np.empty(n, np.uint32)
    keep = np.ones(n, bool)
    keep[put] = False
    out[put] = _BLANK
    out[keep] = codes
    blank = out == _BLANK
    stay = ~blank
    stay[0] = True
    stay[1:] |= ~blank[:-1]
    stay[put] = True          # a row's own blank stays, so that rows never share an n-gram
    begin = np.concatenate(([0], np.cumsum(stay)))[put]
    return out[stay], begin


def _grams(codes: np.ndarray, order: int, buckets: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each position; -1 where it is all
    blank or would run over a row's end."""
    n = len(codes) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    h = np.full(n, order * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
    for k in range(order):
        h = (h ^ codes[k:n + k]) * np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
    h = (h * np.uint32(0xC2B2AE35)) >> np.uint32(16)
    out = (h % np.uint32(buckets)).astype(np.int64)
    if order == 1:
        out[codes[:n] == _BLANK] = -1
    else:
        # an n-gram may begin or end with a blank, not hold one inside
        for k in range(1, order - 1):
            out[codes[k:n + k] == _BLANK] = -1
        out[(codes[:n] == _BLANK) & (codes[order - 1:] == _BLANK)] = -1
    return out


@dataclass
class LanguageModel:
    languages: list[str]
    log_prob: np.ndarray      # buckets x languages
    log_prior: np.ndarray


def train(docs: DataFrame, where: Column | None = None, text_col: str = "text",
          lang_col: str = "lang", buckets: int = BUCKETS, orders: tuple[int, ...] = ORDERS,
          smoothing: float = SMOOTHING) -> LanguageModel:
    """Fit on the rows that ``where`` keeps, with non-null text and language.

    Every such row counts with its whole text. Empty texts and texts without
    letters count for the prior alone. No training rows: a model without
    languages, which predicts ``und`` everywhere.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs if where is None else docs.filter(where)
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    rows = rows.dropna()

    def count(batches):
        names: dict[str, int] = {}
        sums = np.zeros((0, buckets + 1), np.int64)  # the last column counts documents
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for lang in langs:
                if lang not in names:
                    names[lang] = len(names)
                    sums = np.vstack([sums, np.zeros((1, buckets + 1), np.int64)])
            index = np.array([names[x] for x in langs], np.int64)
            sums[:, buckets] += np.bincount(index, minlength=len(names))
            for chunk in text_chunks(batch.column(1)):
                codes, begin = _letter_codes(chunk)
                own = index[chunk.first:chunk.first + chunk.rows]
                of = np.repeat(own, np.diff(begin)).astype(np.int64)
                for order in orders:
                    g = _grams(codes, order, buckets)
                    m = min(len(g), len(of))
                    g, o = g[:m], of[:m]
                    ok = g >= 0
                    got = np.bincount(o[ok] * buckets + g[ok], minlength=len(names) * buckets)
                    sums[:, :buckets] += got.reshape(len(names), buckets)
        for lang, i in names.items():
            b = np.flatnonzero(sums[i])
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(b), pa.string()), pa.array(b, pa.int32()),
                 pa.array(sums[i][b], pa.int64())], names=["lang", "bucket", "n"])

    counts = (rows.mapInArrow(count, "lang string, bucket int, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    packed = counts.groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("cells"))  # buckets + 1 at most
    found = packed.limit(MAX_CELLS // (buckets + 1) + 1).collect()
    if len(found) * buckets > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS // buckets} languages: lower buckets")
    found.sort(key=lambda r: r["lang"])
    languages = [r["lang"] for r in found]
    table = np.zeros((len(found), buckets + 1))
    for i, r in enumerate(found):
        cells = np.array([(c["bucket"], c["n"]) for c in r["cells"]], np.int64)
        table[i, cells[:, 0]] = cells[:, 1]
    grams = table[:, :buckets] + smoothing
    log_prob = np.log(grams / grams.sum(axis=1, keepdims=True)).T.copy() if languages else np.zeros((buckets, 0))
    docs_per = table[:, buckets] + 1.0
    return LanguageModel(languages, log_prob, np.log(docs_per / docs_per.sum()))


def predict(docs: DataFrame, model: LanguageModel, id_cols: list[str] = ("doc_id",),
            text_col: str = "text", orders: tuple[int, ...] = ORDERS,
            pred_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """``id_cols`` (the text may be one), and ``pred_col``, ``score_col``: the predicted
    language and its posterior.

    A null text, one without letters, or a model without languages gives ``und``
    with score 0. A tie goes to the language that sorts first.
    """
    spark = docs.sparkSession
    ship_package(spark)
    if model.log_prob.size > MAX_CELLS:
        raise ValueError("the model is larger than its broadcast bound")
    shared = spark.sparkContext.broadcast(model)
    keep = list(id_cols)
    read = keep if text_col in keep else [*keep, text_col]
    text_at = read.index(text_col)

    def score(batches):
        m: LanguageModel = shared.value
        buckets, k = m.log_prob.shape
        columns = [np.ascontiguousarray(m.log_prob[:, j]) for j in range(k)]
        for batch in batches:
            preds, scores = [], []
            for chunk in text_chunks(batch.column(text_at)):
                codes, begin = _letter_codes(chunk)
                letters = np.concatenate(([0], np.cumsum(codes != _BLANK)))
                some = letters[begin[1:]] > letters[begin[:-1]]
                total = np.tile(m.log_prior, (chunk.rows, 1))
                for order in orders:
                    g = _grams(codes, order, buckets)
                    of = np.minimum(begin, len(g))
                    ok = g >= 0
                    kept = np.concatenate(([0], np.cumsum(ok)))[of]
                    g = g[ok]
                    for j in range(k):
                        sums = np.concatenate(([0.0], np.cumsum(columns[j][g])))
                        total[:, j] += sums[kept[1:]] - sums[kept[:-1]]
                if k == 0:
                    preds += [UNKNOWN] * chunk.rows
                    scores += [0.0] * chunk.rows
                    continue
                best = total.argmax(axis=1)
                top = total[np.arange(chunk.rows), best]
                prob = 1.0 / np.exp(total - top[:, None]).sum(axis=1)
                preds += [m.languages[b] if s else UNKNOWN for b, s in zip(best, some)]
                scores += np.where(some, prob, 0.0).tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array(preds, pa.string()),
                 pa.array(scores, pa.float64())], names=[*keep, pred_col, score_col])

    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField(pred_col, T.StringType()),
                           T.StructField(score_col, T.DoubleType())])
    return docs.select(*read).mapInArrow(score, schema)
