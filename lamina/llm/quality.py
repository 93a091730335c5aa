"""Quality classifier on document statistics.

Random Fourier features approximate a Gaussian kernel over standardised
statistics of a whole text. Ridge weights solve normal equations that each task
sums over its rows and Spark sums over the tasks, one row of the matrix per
record; their size is ``dimension`` squared, whatever the corpus' size. An
isotonic step, fitted on labelled rows that the ridge step did not see, turns
the ridge score into a probability.
"""

from __future__ import annotations

import functools
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import ship_package, text_chunks

DIMENSION = 256
RIDGE = 1e-3
SEED = 42
#: Ridge scores are rounded to this grid before the isotonic step (bounded cells).
GRID = 2000
#: Partial sums of one matrix row meet in so many groups before the last one.
LANES = 32

STATISTICS = ("log_bytes", "log_words", "word_length", "letters", "upper", "digits", "blanks",
              "lines", "marks", "symbols", "repeated_marks", "upper_words", "distinct_words",
              "distinct_lines", "top_word", "word_entropy", "byte_entropy", "deflated",
              "short_words", "long_words")

_LETTER, _UPPER, _DIGIT, _SPACE, _LINE, _MARK, _SYMBOL = range(7)


@functools.lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of each byte; bytes above 127 are parts of letters."""
    table = np.full(256, _SYMBOL, np.uint8)
    table[128:] = _LETTER
    for ch in range(128):
        c = chr(ch)
        if c.isalpha():
            table[ch] = _UPPER if c.isupper() else _LETTER
        elif c.isdigit():
            table[ch] = _DIGIT
        elif c == "\n":
            table[ch] = _LINE
        elif c.isspace():
            table[ch] = _SPACE
        elif c in ".,;:!?'\"()-":
            table[ch] = _MARK
    return table


def _share(part, whole):
    return part / np.maximum(whole, 1)


def _entropy(counts: np.ndarray) -> float:
    p = counts / counts.sum()
    return float(-(p * np.log2(p)).sum())


def text_statistics(chunk) -> np.ndarray:
    """rows x STATISTICS of a chunk's whole texts; an empty text has zeros."""
    data, offs, n = chunk.data, chunk.offsets, chunk.rows
    size = np.diff(offs).astype(float)
    kind = _classes()[data]

    def counts(flag: np.ndarray) -> np.ndarray:
        c = np.concatenate(([0], np.cumsum(flag)))
        return (c[offs[1:]] - c[offs[:-1]]).astype(float)

    letters, upper = counts(kind == _LETTER), counts(kind == _UPPER)
    marks, symbols = counts(kind == _MARK), counts(kind == _SYMBOL)
    blanks, lines = counts(kind == _SPACE), counts(kind == _LINE)
    repeated = np.zeros(len(data), bool)
    if len(data) > 1:
        repeated[1:] = (data[1:] == data[:-1]) & (kind[1:] >= _MARK)
    out = np.zeros((n, len(STATISTICS)))
    for i in range(n):
        if size[i] == 0:
            continue
        raw = data[offs[i]:offs[i + 1]].tobytes()
        words = raw.split()
        rows = [x for x in raw.split(b"\n") if x.strip()]
        if words:
            length = np.fromiter(map(len, words), np.int64, len(words))
            seen: dict[bytes, int] = {}
            for w in words:
                seen[w] = seen.get(w, 0) + 1
            freq = np.fromiter(seen.values(), float, len(seen))
            out[i, 2] = length.mean()
            out[i, 11] = sum(map(bytes.isupper, words)) / len(words)
            out[i, 12] = len(seen) / len(words)
            out[i, 14] = freq.max() / len(words)
            out[i, 15] = _entropy(freq)
            out[i, 18] = (length <= 2).mean()
            out[i, 19] = (length >= 16).mean()
            out[i, 1] = np.log1p(len(words))
        out[i, 13] = len(set(rows)) / len(rows) if rows else 0.0
        hist = np.bincount(data[offs[i]:offs[i + 1]], minlength=256)
        out[i, 16] = _entropy(hist[hist > 0].astype(float))
        out[i, 17] = len(zlib.compress(raw, 1)) / len(raw)
    out[:, 0] = np.log1p(size)
    out[:, 3] = _share(letters + upper, size)
    out[:, 4] = _share(upper, letters + upper)
    out[:, 5] = _share(counts(kind == _DIGIT), size)
    out[:, 6] = _share(blanks, size)
    out[:, 7] = _share(lines, size)
    out[:, 8] = _share(marks, size)
    out[:, 9] = _share(symbols, size)
    out[:, 10] = _share(counts(repeated), size)
    return out


def statistics(docs: DataFrame, id_cols: list[str] = ("doc_id",),
               text_col: str = "text") -> DataFrame:
    """``id_cols`` and ``stats`` (array of double, in the order of STATISTICS) of
    every whole text. A null text counts as empty: all zeros. No shuffle."""
    ship_package(docs.sparkSession)
    keep = list(id_cols)

    def run(batches):
        for batch in batches:
            for chunk in text_chunks(batch.column(len(keep))):
                x = text_statistics(chunk)
                stats = pa.ListArray.from_arrays(
                    pa.array(np.arange(chunk.rows + 1, dtype=np.int32) * x.shape[1]),
                    pa.array(x.ravel()))
                ids = [c.slice(chunk.first, chunk.rows) for c in batch.columns[:len(keep)]]
                yield pa.RecordBatch.from_arrays([*ids, stats], names=[*keep, "stats"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, text_col).mapInArrow(run, f"{kinds}, stats array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), float).reshape(len(column), -1)


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray    # statistics x dimension
    phases: np.ndarray
    weights: np.ndarray       # dimension + 1, the last one is the intercept
    steps: np.ndarray         # ridge scores, ascending
    levels: np.ndarray        # probability at each step

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = (stats - self.mean) / self.scale
        f = np.cos(z @ self.directions + self.phases) * np.sqrt(2.0 / len(self.phases))
        return np.hstack([f, np.ones((len(f), 1))])

    def score(self, stats: np.ndarray) -> np.ndarray:
        raw = self.features(stats) @ self.weights
        if len(self.steps) == 0:
            return np.clip(raw, 0.0, 1.0)
        return np.interp(raw, self.steps, self.levels)


def isotonic(values: np.ndarray, target: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the non-decreasing fit to ``target`` by ``values``' order."""
    level, mass, size = [], [], []
    for y, w in zip(target[np.argsort(values, kind="stable")], weight[np.argsort(values, kind="stable")]):
        level.append(float(y))
        mass.append(float(w))
        size.append(1)
        while len(level) > 1 and level[-2] >= level[-1]:
            y1, w1, s1 = level.pop(), mass.pop(), size.pop()
            level[-1] = (level[-1] * mass[-1] + y1 * w1) / (mass[-1] + w1)
            mass[-1] += w1
            size[-1] += s1
    return np.repeat(level, size)


def fit(labelled: DataFrame, calibrate: Column, label_col: str = "label",
        dimension: int = DIMENSION, ridge: float = RIDGE, seed: int = SEED) -> QualityModel:
    """Fit on rows with ``stats`` and a 0/1 label; ``calibrate`` picks the rows of
    the isotonic step, the others give the ridge weights.

    Rows whose label is null are left out. All labelled rows take part. Without
    any row for the ridge step the model scores 0.5 everywhere.
    """
    spark = labelled.sparkSession
    ship_package(spark)
    k = len(STATISTICS)
    rows = labelled.filter(F.col(label_col).isNotNull()).select(
        "stats", F.col(label_col).cast("double").alias("label"),
        F.coalesce(calibrate, F.lit(False)).alias("late"))
    part = rows.filter(~F.col("late"))
    moments = part.agg(F.count("*").alias("n"), *[
        f(F.col("stats")[i]).alias(f"{name}{i}") for i in range(k)
        for name, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    rng = np.random.Generator(np.random.PCG64(seed))
    directions = rng.normal(size=(k, dimension)) / np.sqrt(k)
    phases = rng.uniform(0, 2 * np.pi, dimension)
    none = np.zeros(0)
    if not moments["n"]:
        weights = np.zeros(dimension + 1)
        weights[-1] = 0.5
        return QualityModel(np.zeros(k), np.ones(k), directions, phases, weights, none, none)
    mean = np.array([moments[f"m{i}"] for i in range(k)])
    scale = np.array([moments[f"s{i}"] or 1.0 for i in range(k)])
    model = QualityModel(mean, scale, directions, phases, np.zeros(dimension + 1), none, none)
    bare = spark.sparkContext.broadcast(model)     # a few hundred KB, fixed by the parameters

    def equations(batches):
        total = np.zeros((dimension + 1, dimension + 2))
        for batch in batches:
            if batch.num_rows:
                f = bare.value.features(_matrix(batch.column(0)))
                y = np.asarray(batch.column(1), float)
                total += f.T @ np.hstack([f, y[:, None]])
        lane = TaskContext.get().partitionId() % LANES
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total)), pa.int32()), pa.array([lane] * len(total), pa.int32()),
             pa.array(total.tolist(), pa.list_(pa.float64()))], names=["i", "lane", "row"])

    def add(table: pa.Table) -> pa.Table:
        total = _matrix(table.column("row").combine_chunks()).sum(axis=0)
        return table.slice(0, 1).set_column(2, "row", pa.array([total.tolist()], pa.list_(pa.float64())))

    shape = "i int, lane int, row array<double>"
    sums = part.select("stats", "label").mapInArrow(equations, shape)
    for keys in (("i", "lane"), ("i",)):       # tasks to lanes, lanes to one
        sums = sums.groupBy(*keys).applyInArrow(add, shape)
    sums = sums.collect()                      # dimension + 1 rows
    system = np.zeros((dimension + 1, dimension + 2))
    for r in sums:
        system[r["i"]] = r["row"]
    gram, right = system[:, :-1], system[:, -1]
    penalty = np.full(dimension + 1, ridge * moments["n"])
    penalty[-1] = 0.0
    weights = np.linalg.solve(gram + np.diag(penalty + 1e-9), right)
    model = QualityModel(mean, scale, directions, phases, weights, none, none)

    late = rows.filter("late")
    cells = (raw_scores(late, model, ["label"])
             .groupBy(F.round(F.col("raw") * GRID).cast("int").alias("cell"))
             .agg(F.count("*").alias("n"), F.avg("label").alias("y"))
             .filter(F.abs("cell") <= 4 * GRID).collect())      # scores lie near 0 to 1
    if cells:
        x = np.array([r["cell"] for r in cells], float) / GRID
        order = np.argsort(x)
        x = x[order]
        y = np.array([r["y"] for r in cells])[order]
        w = np.array([r["n"] for r in cells], float)[order]
        model = QualityModel(mean, scale, directions, phases, weights, x, isotonic(x, y, w))
    return model


def raw_scores(rows: DataFrame, model: QualityModel, id_cols: list[str]) -> DataFrame:
    """``id_cols`` and the ridge score ``raw`` before the isotonic step."""
    return _apply(rows, model, id_cols, "raw", lambda m, x: m.features(x) @ m.weights)


def score(rows: DataFrame, model: QualityModel, id_cols: list[str] = ("doc_id",)) -> DataFrame:
    """``id_cols`` and ``score``, 0 to 1, of rows with ``stats``."""
    return _apply(rows, model, id_cols, "score", lambda m, x: np.clip(m.score(x), 0.0, 1.0))


def _apply(rows, model, id_cols, name, function):
    spark = rows.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)
    keep = list(id_cols)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                got = function(shared.value, _matrix(batch.column(len(keep))))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:len(keep)], pa.array(got, pa.float64())], names=[*keep, name])

    kinds = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in keep)
    return rows.select(*keep, "stats").mapInArrow(run, f"{kinds}{name} double")
