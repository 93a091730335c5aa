"""Reproducible sampling, splitting and fold assignment from a hash of the id.

A row's fate depends only on (id, salt): no shuffle, no global ordering, the
same on every rerun and on any cluster size. Sampling, splitting and folds use
different salts so they are independent of each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina import fixed
from lamina.plans.joins import sized_broadcast

TWO_32 = 4294967296.0
SAMPLE_SALT = f"|sample{fixed.SEED}"
SPLIT_SALT = f"|split{fixed.SEED}"
FOLD_SALT = f"|fold{fixed.SEED}"

TRAIN, VALIDATION, TEST = "train", "validation", "test"


def hash_u32(id_col: str | Column, salt: str) -> Column:
    """First 32 bits of md5(id || salt) as a non-negative bigint."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    hexed = F.substring(F.md5(F.concat(c.cast("string"), F.lit(salt))), 1, 8)
    return F.conv(hexed, 16, 10).cast("bigint")


def hash_bucket(id_col: str | Column, salt: str, buckets: int = 100) -> Column:
    return hash_u32(id_col, salt) % buckets


def sample_stratified_hash(df: DataFrame, label: str, fractions: dict, id_col: str,
                           salt: str = SAMPLE_SALT) -> DataFrame:
    """Keep a row of class c when its hash falls below fractions[c] * 2^32.
    Rows of other classes (including a null label) are dropped, as in a
    stratified sampler keyed on the listed classes."""
    u = hash_u32(id_col, salt)
    cond = None
    for cls, frac in fractions.items():
        c = (F.col(label) == F.lit(cls)) & (u < F.lit(float(frac) * TWO_32))
        cond = c if cond is None else cond | c
    return df.filter(cond)


def sample_to_target(df: DataFrame, label: str, classes: Sequence, id_col: str,
                     target_rows: int = fixed.SAMPLE_TARGET_ROWS,
                     salt: str = SAMPLE_SALT) -> DataFrame:
    """Sample down to about ``target_rows`` with the same fraction per class,
    only when the frame is larger (the count is one scalar job)."""
    total = df.count()
    if total <= target_rows:
        return df
    frac = float(target_rows) / total
    return sample_stratified_hash(df, label, {c: frac for c in classes}, id_col, salt)


def sample_bernoulli(df: DataFrame, label: str, fractions: dict,
                     seed: int = fixed.SEED) -> DataFrame:
    """Spark's own stratified Bernoulli sampler (partition-dependent)."""
    return df.sampleBy(label, fractions=fractions, seed=seed)


def split_hash(df: DataFrame, id_col: str, train_pct: int = fixed.TRAIN_PCT,
               valid_pct: int = fixed.VALIDATION_PCT,
               salt: str = SPLIT_SALT, split_col: str = "split") -> DataFrame:
    """Bucket 0..99 of the hash: [0, train) train, then validation, rest test.
    Stratified in expectation (the hash ignores the label)."""
    b = hash_bucket(id_col, salt)
    return df.withColumn(split_col,
                         F.when(b < train_pct, F.lit(TRAIN))
                         .when(b < train_pct + valid_pct, F.lit(VALIDATION))
                         .otherwise(F.lit(TEST)))


def fold_id(id_col: str, k: int = fixed.ENCODER_FOLDS, salt: str = FOLD_SALT) -> Column:
    return (hash_u32(id_col, salt) % k).cast("int")


def exact_rank(df: DataFrame, part: str, id_col: str, salt: str = SPLIT_SALT,
               bucket_bits: int = 20, rank_col: str = "rank",
               size_col: str = "part_size") -> DataFrame:
    """0-based rank of every row inside its ``part`` (e.g. class) ordered by
    (hash, id), computed without a single-task global window.

    Rows go to 2^bucket_bits hash buckets; per (part, bucket) counts are tiny
    and their running sums give each bucket's offset; the rank inside a bucket
    is a window over that bucket alone. The hash is uniform, so buckets are
    even whatever the skew of the data. With 2^20 buckets the offset table is
    at most 2^20 rows per part (broadcast) and at 10^12 rows a bucket window
    holds about 5 * 10^5 rows.
    """
    u = hash_u32(id_col, salt)
    shift = 32 - bucket_bits
    keyed = df.withColumns({"__u": u, "__b": F.shiftright(u, shift)})
    counts = keyed.groupBy(part, "__b").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(part).orderBy("__b")
    offsets = counts.select(
        part, "__b",
        (F.sum("__n").over(w) - F.col("__n")).alias("__off"),
        F.sum("__n").over(Window.partitionBy(part)).alias(size_col))
    inner = Window.partitionBy(part, "__b").orderBy("__u", id_col)
    ranked = keyed.join(sized_broadcast(offsets, derived=True),
                        [part, "__b"], "left")
    return (ranked.withColumn(rank_col, F.col("__off") + F.row_number().over(inner) - 1)
            .drop("__u", "__b", "__off"))


def boundary_rows(df: DataFrame, part: str, id_col: str, percents: Sequence[int], salt: str = SPLIT_SALT,
                  bucket_bits: int = 20) -> DataFrame:
    """(part, i, u, id): the (hash, id) of the first row behind each of the cut points
    floor(n * percent / 100) of every part; none where the cut is the part's end.

    Counts per hash bucket tell which bucket holds a cut; only its rows are ranked.
    """
    u = hash_u32(id_col, salt)
    keyed = df.select(F.col(part).alias("part"), F.col(id_col).alias("id"), u.alias("u"),
                      F.shiftright(u, 32 - bucket_bits).alias("b"))
    counts = keyed.groupBy("part", "b").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("part").orderBy("b")                    # at most 2^bucket_bits rows a part
    offsets = counts.select("part", "b", "n", (F.sum("n").over(w) - F.col("n")).alias("off"),
                            F.sum("n").over(Window.partitionBy("part")).alias("size"))
    cuts = F.array(*[F.struct(F.lit(i).alias("i"), F.floor(F.col("size") * p / 100).alias("at"))
                     for i, p in enumerate(percents)])
    held = (offsets.select("part", "b", "n", "off", F.explode(cuts).alias("c"))
            .where((F.col("off") <= F.col("c.at")) & (F.col("c.at") < F.col("off") + F.col("n")))
            .select("part", "b", F.col("c.i").alias("i"), (F.col("c.at") - F.col("off")).alias("r")))
    inner = Window.partitionBy("part", "b", "i").orderBy("u", "id")
    ranked = (keyed.join(sized_broadcast(held, derived=True), ["part", "b"])
              .withColumn("rank", F.row_number().over(inner) - 1))
    return ranked.where(F.col("rank") == F.col("r")).select("part", "i", "u", "id")


def split_exact(df: DataFrame, label: str, id_col: str, train_pct: int = fixed.TRAIN_PCT,
                valid_pct: int = fixed.VALIDATION_PCT, salt: str = SPLIT_SALT,
                split_col: str = "split", bucket_bits: int = 20) -> DataFrame:
    """Exact per-class proportions: in class c of size n, rank < floor(n*70/100)
    is train, rank < floor(n*85/100) validation, the rest test (integer
    percentages keep the cut points exact). Ids are unique.

    A row is compared with its class's two boundary rows; the rows aren't shuffled.
    """
    rows = boundary_rows(df, label, id_col, [train_pct, train_pct + valid_pct], salt, bucket_bits)
    cut = rows.groupBy("part").agg(*[
        F.max(F.when(F.col("i") == i, F.struct("u", "id"))).alias(f"__cut{i}") for i in range(2)])
    cut = cut.withColumnRenamed("part", "__part")
    own = F.struct(hash_u32(id_col, salt).alias("u"), F.col(id_col).alias("id"))
    out = df.join(sized_broadcast(cut, derived=True), F.col(label).eqNullSafe(F.col("__part")), "left")

    def before(c: str):
        return F.col(c).isNull() | (own < F.col(c))

    return out.withColumn(split_col, F.when(before("__cut0"), F.lit(TRAIN)).when(before("__cut1"), F.lit(VALIDATION))
                          .otherwise(F.lit(TEST))).drop("__part", "__cut0", "__cut1")
