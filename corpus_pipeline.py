"""A corpus pipeline of five stages over ``documents``: toxic documents go, lines shared by
many documents go, one document of each SimHash group stays, secrets are blanked, and what is
left is packed into sequences.

Each stage is a function of (spark, docs, sf_dir) and calls one operator of basketspark.llm;
its result is written as Parquet and reread as the next stage's docs. All but the last return
the columns of documents; n_chars follows the text. Null ids and texts pass; of rows equal in
doc_id and text the near-duplicate stage leaves one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketspark.llm import line_dedup, packing, secrets, simhash, toxicity
from basketspark.llm.queries import tokenizer_file
from basketspark.llm.text import text_keys
from basketspark.runtime import materialize

#: No SQL expresses the trained classifier chain of the first stage.
ORACLE_SQL = None


def _recounted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else docs


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(docs, min_chars=20, min_docs=3, counts=("__lines", "__dropped"))
    return _recounted(out.drop("__lines", "__dropped"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Id and text name a row: rows with an id come first, so a group's smallest id stays, and a
    # group without any id keeps one of its rows, too.
    name = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), *text_keys(F.col("text")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), name.alias("__name"))
    found = simhash.simhash_near_dups(rows.select("__name", F.col("__row.text").alias("text")), shingle_words=3, max_distance=2, doc_id="__name")
    gone = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("__gone")).distinct()
    left = rows.join(gone, F.col("__name") == F.col("__gone"), "left_anti").dropDuplicates(["__name"])
    return left.select(*[F.col("__row")[c].alias(c) for c in docs.columns])


def blank_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(secrets.redact_secrets(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_common_lines),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("secret_scan", blank_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}", dealt=False)
    return docs
