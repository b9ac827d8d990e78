"""The operators applied to the test tables: each query takes (spark, sf_dir).

The queries derive the columns of the results agreed for them; the operators keep their own
outputs. Tokenizer files are found by the public_tokenizers package.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketspark.llm import collocations, conversations, embedding_dups, licenses, line_dedup, packing, piecewise, quality_rules, secrets, sentencepieces, simhash, substring, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark, sf_dir):
    found = quality_rules.quality_rules(_table(spark, sf_dir, "documents"))
    return found.withColumn("host_rate", F.round("host_rate", 6))


def op2_simhash(spark, sf_dir):
    return simhash.simhash_near_dups(_table(spark, sf_dir, "documents"), shingle_words=3, max_distance=2)


def op3_embedding_dups(spark, sf_dir):
    return embedding_dups.embedding_near_dups(_table(spark, sf_dir, "embeddings"), threshold=0.93)


def op4_license_scan(spark, sf_dir):
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op5_secret_scan(spark, sf_dir):
    found = secrets.scan_secrets(_table(spark, sf_dir, "documents"))
    kinds = [k for k, *_ in secrets.STRONG]
    count = lambda kind: F.size(secrets.of_kinds(F.col("spans"), [kind])).cast("long").alias(f"n_{kind}")
    base = F.sha2(secrets.listed(secrets.of_kinds(F.col("spans"), kinds)), 256)
    return found.select("doc_id", *[count(k) for k in kinds], base.alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"))


def op6_substring_dedup(spark, sf_dir):
    return substring.dedup_substrings(_table(spark, sf_dir, "documents"), window=35)


def op7_packing(spark, sf_dir):
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op8_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.fit_chain(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, chain)
    return scored.select("doc_id", "p_low_quality", "p_toxic", F.col("is_toxic").alias("toxic"), (~F.col("is_toxic")).alias("kept"))


def op9_sentencepiece(spark, sf_dir):
    return sentencepieces.encode_digests(_table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op10_line_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.dedup_lines(docs, min_chars=20, min_docs=3)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op11_conversation_repair(spark, sf_dir):
    rows = _table(spark, sf_dir, "conversations")
    found = conversations.repair_conversations(conversations.damage(rows)).withColumnRenamed("conv_id", "c")
    every = rows.select("conv_id").distinct()  # a conversation may have lost all of its rows
    out = every.join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    counts = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    sha = F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), sha)


def op12_collocations(spark, sf_dir):
    return collocations.mine_phrases(_table(spark, sf_dir, "documents"), max_words=3, min_count=10, covered_percent=50, top=2000)


def op13_fingerprints(spark, sf_dir):
    return piecewise.edited_neighbours(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_simhash, op3_embedding_dups, op4_license_scan, op5_secret_scan,
        op6_substring_dedup, op7_packing, op8_toxicity, op9_sentencepiece, op10_line_dedup,
        op11_conversation_repair, op12_collocations, op13_fingerprints,
    )
}
