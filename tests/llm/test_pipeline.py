"""Each stage on its own input, and the whole."""

import public_tokenizers as P
from pyspark.sql import functions as F

import corpus_pipeline as cp
from lamina.llm import bpe
from lamina.llm.queries import QUERIES, RANK_FILE
from tests.conftest import SF_SMALL
from tests.llm.helpers import MESSY, frame, shingles, words13


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_language_stage(spark):
    docs = frame(spark, MESSY)
    got = cp.language(spark, docs, SF_SMALL)
    assert got.columns == docs.columns
    kept = docs.filter(F.coalesce("text", F.lit("")).rlike(r"\p{L}"))
    assert rows_of(got) == rows_of(kept)
    assert cp.language(spark, docs.limit(0), SF_SMALL).count() == 0


def test_language_stage_keeps_what_has_letters(spark):
    """Without a known language, and where several languages are about equally likely."""
    docs = frame(spark, MESSY).withColumn("lang", F.lit(None).cast("string"))
    kept = rows_of(docs.filter(F.coalesce("text", F.lit("")).rlike(r"\p{L}")))
    assert kept and rows_of(cp.language(spark, docs, SF_SMALL)) == kept
    many = frame(spark, [(i, "one and the same text") for i in range(60)] + [(100, "12 345")])
    many = many.withColumn("lang", F.concat(F.lit("l"), (F.col("doc_id") % 6).cast("string")))
    assert cp.language(spark, many, SF_SMALL).count() == 60


def test_near_duplicate_stage(spark):
    copy = MESSY[9][1]
    docs = frame(spark, [*MESSY, (20, copy), (3, "a b c d e f")])
    got = cp.near_duplicates(spark, docs, SF_SMALL)
    assert got.columns == docs.columns
    ids = [r.doc_id for r in got.collect()]
    # the copies under 9 and 20 go with 8's; the other text under id 9 goes with its id
    assert 8 in ids and 20 not in ids and ids.count(None) == 2 and {1, 2, 3} <= set(ids)
    assert cp.near_duplicates(spark, docs.limit(0), SF_SMALL).count() == 0


def test_near_duplicates_are_five_words_and_four_fifths(spark):
    """Against brute force, with pairs between this threshold and op9's."""
    def edited(words, n):
        step = len(words) // n
        return [f"new{i}" if i % step == step // 2 and i // step < n else w for i, w in enumerate(words)]

    rows = []
    for k, (n, edits) in enumerate([(200, 4), (95, 2), (470, 10), (200, 5), (95, 3), (300, 1)]):
        words = [f"w{k}x{i}" for i in range(n)]
        rows += [(10 * k, " ".join(words)), (10 * k + 1, " ".join(edited(words, edits)))]

    def jaccard(a, b, k):
        a, b = shingles(a, k), shingles(b, k)
        return len(a & b) / len(a | b)

    assert all(jaccard(rows[i][1], rows[i + 1][1], 5) >= 0.8 and jaccard(rows[i][1], rows[i + 1][1], 4) < 0.85 for i in (0, 2, 4))
    expected = [i for i, t in rows if not any(j < i and jaccard(t, u, 5) >= 0.8 for j, u in rows)]
    got = cp.near_duplicates(spark, frame(spark, rows), SF_SMALL)
    assert sorted(r.doc_id for r in got.collect()) == expected == [0, 10, 20, 30, 31, 40, 41, 50]


def test_near_duplicates_of_repeated_ids(spark):
    """Rows that share an id stay or go by their own texts."""
    base = " ".join(f"w{i}" for i in range(200))
    near = base.replace("w100 ", "new ")
    distinct, other = (" ".join(f"{c}{i}" for i in range(50)) for c in "uv")
    rows = [(1, base), (2, near), (2, distinct), (3, other), (3, other), (3, other + " end"), (4, ""), (4, None), (None, base)]
    got = [(r.doc_id, r.text) for r in cp.near_duplicates(spark, frame(spark, rows), SF_SMALL).collect()]
    assert len(got) == 6 and {(1, base), (2, distinct), (4, ""), (4, None), (None, base)} <= set(got)
    assert len({(3, other), (3, other + " end")} & set(got)) == 1


def test_decontamination_stage(spark):
    item = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").filter(F.length("text") > 150).first().text
    docs = frame(spark, [*MESSY, (30, item), (None, item), (31, "clean " * 50), (32, item + " other" * 2000)])
    got = cp.decontaminate(spark, docs, SF_SMALL)
    assert got.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in got.collect()]
    assert (30, item) not in kept and (None, item) not in kept and len(words13(item)) * 20 < 2000
    assert len(kept) == len(MESSY) + 2
    assert cp.decontaminate(spark, docs.limit(0), SF_SMALL).count() == 0


def test_pseudonym_stage(spark):
    docs = frame(spark, [*MESSY, (40, "ip 70.123.182.155 here")])
    got = cp.pseudonyms(spark, docs, SF_SMALL)
    assert got.schema == docs.schema
    changed = got.filter("doc_id = 40").first()
    assert "70.123" not in changed.text and changed.n_chars == len(changed.text)
    assert rows_of(got.filter("doc_id IS NULL OR doc_id != 40")) == rows_of(docs.filter("doc_id IS NULL OR doc_id != 40"))


def test_token_stage(spark):
    got = cp.tokens(spark, frame(spark, MESSY), SF_SMALL).collect()
    assert len(got) == len(MESSY) and all(r.round_trip for r in got)
    assert sorted(r.n_tokens for r in got) == sorted(len(bpe.encode_text(t or "", RANK_FILE, P.PATTERN)) for _, t in MESSY)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tokens_run_one_python_worker_a_core(spark):
    assert plan_of(cp.tokens(spark, frame(spark, MESSY), SF_SMALL)).count("MapInArrow") == 1


def test_test_terms_need_no_python_worker(spark):
    """A list's DataFrame is read by Python workers of their own kind, which then stay."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = plan_of(cp.decontaminate(spark, docs, SF_SMALL))
    assert "LocalTableScan" in plan and "ExistingRDD" not in plan


def test_whole_pipeline(spark):
    assert [n for n, _ in cp.STAGES] == ["language", "near_duplicates", "decontaminate", "pseudonyms", "tokens"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = {r.doc_id: r for r in cp.run(spark, SF_SMALL).collect()}
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()
    grams = {tuple(words13(b.text)[i:i + 13]) for b in bench for i in range(max(1, len(words13(b.text)) - 12))}
    kept = {}
    for d in sorted(docs, key=lambda d: d.doc_id):
        s = shingles(d.text)
        if not any(c.isalpha() for c in d.text or ""):
            continue
        if any(100 * len(s & t) >= 85 * len(s | t) for t in kept.values()):
            assert d.doc_id not in got
            continue
        kept[d.doc_id] = s
        w, hit = words13(d.text), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in grams:
                    hit.update(range(i, i + n))
        assert (d.doc_id in got) == (not hit or 20 * len(hit) < len(w)), d.doc_id
    assert all(r.round_trip for r in got.values())


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
