"""One registered query per operator: the operator over its whole table, and the
digest columns that its contract asks for."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import (balltree, bpe, decontam, idstore, langid, paritysketch, pii, quality, sharding, substrings,
                        tokenalign, topk, urls)
from lamina.llm.common import fold, write_and_read
from lamina.llm.oracles import ORACLE  # noqa: F401
from lamina.sources.tables import read_table

RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER_FILE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_FILE = public_tokenizers.path("piece_bpe_32k.model")
QUALITY_FROM = 0.7
SHARDS = 24
#: Rules of the URL filter, by its contract.
URL_RULES = (urls.Rule("block", "net", "/"), urls.Rule("allow", "example.net", "/en/"),
             urls.Rule("block", "example.com", "/de/"), urls.Rule("allow", "org", "/fr/"))
#: The key of the pseudonyms; a deployment passes its own to the operator.
PII_KEY = "corpus-pseudonym-key"


def held_out(id_col: str = "doc_id"):
    """A row without an id is never learned from."""
    return F.coalesce(fold(id_col) == 2, F.lit(True))


def q_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontam.hits(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    listed = F.array_join(F.sort_array(F.col("items").cast("array<string>")), ",")
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(listed.cast("binary"), 256).alias("items_sha256"),
        decontam.contaminated().alias("contaminated"))


def q_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
    return found.withColumnRenamed("id", "vec_id")


def q_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, PII_KEY, count_col="n_replaced")


def q_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.dedup(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def q_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(read_table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def q_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = paritysketch.join(read_table(spark, sf_dir, "documents"))
    return joined.select("doc_id", "n_shingles", "component_id")


def q_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    encoded = bpe.encode(docs, RANK_FILE, public_tokenizers.PATTERN)
    decoded = bpe.decode(encoded, RANK_FILE, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def q_idstore(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return idstore.read_index(spark, idstore.write(docs, TOKENIZER_FILE))


def q_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = langid.train(docs, ~held_out())
    return langid.predict(docs, model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")


def quality_scores(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics of all documents, one model from the labelled ones, all scores."""
    stats = write_and_read(quality.statistics(docs), "quality-stats")
    learn = stats.filter(~held_out()).join(
        labels.filter(~held_out()).select("doc_id", F.col("quality").alias("label")), "doc_id")
    model = quality.fit(learn.select("stats", "label", fold().alias("fold")), F.col("fold") == 3)
    return quality.score(stats, model)


def q_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality_scores(spark, read_table(spark, sf_dir, "documents"),
                            read_table(spark, sf_dir, "labels"))
    return scores.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= QUALITY_FROM).cast("int").alias("predicted"))


def q_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.rank(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def q_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = tokenalign.align(read_table(spark, sf_dir, "documents"), TOKENIZER_FILE, PIECE_FILE, digest=True)
    counts = tokenalign.pair_counts(aligned, tokenalign.vocabulary_size(PIECE_FILE))
    return tokenalign.link_scores(aligned, counts).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


def q_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(read_table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


QUERIES = {
    "op1_decontamination": q_decontam,
    "op2_topk": q_topk,
    "op3_pii": q_pii,
    "op4_byte_bpe": q_bpe,
    "op5_token_ids": q_idstore,
    "op6_substring_dedup": q_substrings,
    "op7_language_id": q_langid,
    "op8_url_filter": q_urls,
    "op9_jaccard_join": q_join,
    "op10_quality": q_quality,
    "op11_ranked_search": q_ranked,
    "op12_token_alignment": q_align,
    "op13_sharding": q_sharding,
}
