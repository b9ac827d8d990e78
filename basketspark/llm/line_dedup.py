"""Line deduplication across documents (operator 10), DataFrame functions only.

Normalised lines are exploded and hashed; distinct documents are counted per hash; lines over
the threshold are dropped everywhere but in the largest doc_id that holds them, and the
documents are put together again by position.

A line's key is the line with spaces and U+0009 to U+000D stripped at both ends and A-Z
lower-cased, taken as two independent 64-bit hashes. Keys are made distinct inside a document
before they are exploded, so the counts need one row per line and document and are summed
before they are shuffled; a line that a third of the documents share is one row per task.

Defined cases: a null or empty text is one empty line; each row is a document, so repeated
rows count as documents of their own and, being ties for the largest doc_id, all keep the
line; a null doc_id counts as a document and is never the largest while another holds the
line; if only null ids hold it, all keep it; an empty table gives an empty result; other
columns are kept by ``dedup_lines`` and ignored by the digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketspark.llm.text import pinned, text_keys

#: The characters stripped from a line's ends.
BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else unchanged: lower() where the text has ASCII only."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def line_keys(text: Column) -> Column:
    """The keys of the text's lines in order."""
    return F.transform(F.split(lower_ascii(text), "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)))


def _hashed(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key).alias("h2"))


def common_lines(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """(h1, h2, holder): keys of ``min_chars`` code points or more found in ``min_docs``
    documents or more, with the largest doc_id that holds them. docs: _doc, _text."""
    keys = F.filter(F.array_distinct(line_keys(F.col("_text"))), lambda k: F.length(k) >= min_chars)
    rows = docs.select("_doc", F.explode(F.transform(keys, _hashed)).alias("h"))
    counted = rows.groupBy("h.h1", "h.h2").agg(F.count(F.lit(1)).alias("n"), F.max("_doc").alias("holder"))
    return pinned(counted.where(F.col("n") >= min_docs).select("h1", "h2", "holder"), "common-lines")


def dropped_positions(docs: DataFrame, common: DataFrame, min_chars: int) -> DataFrame:
    """(_doc, _k1, _k2, drop): the positions that each document loses, all in one array."""
    lines = docs.select("_doc", "_k1", "_k2", F.posexplode(line_keys(F.col("_text"))).alias("pos", "key"))
    lines = lines.where(F.length("key") >= min_chars).select("_doc", "_k1", "_k2", "pos", _hashed(F.col("key")).alias("h"))
    lines = lines.select("_doc", "_k1", "_k2", "pos", "h.h1", "h.h2")
    lost = lines.join(common, ["h1", "h2"]).where(~F.col("_doc").eqNullSafe(F.col("holder")))
    # A document has a bounded number of lines; repeated rows give the same positions.
    return lost.groupBy("_doc", "_k1", "_k2").agg(F.collect_set("pos").alias("drop"))


def dedup_lines(
    docs: DataFrame, min_chars: int = 20, min_docs: int = 3, doc_id="doc_id", text="text", counts=("n_lines", "n_dropped")
) -> DataFrame:
    """The documents with all their columns, ``text`` being what stays, and under the names in
    ``counts`` the lines before dropping and the lines dropped."""
    k1, k2 = text_keys(F.col(f"`{text}`"))
    keyed = docs.select(F.col(f"`{doc_id}`").alias("_doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"), k1.alias("_k1"), k2.alias("_k2"))
    common = common_lines(keyed, min_chars, min_docs)
    drop = pinned(dropped_positions(keyed, common, min_chars), "dropped-lines")
    side = drop.select(F.struct("_doc", "_k1", "_k2", "drop").alias("__lost"))
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), k1.alias("__k1"), k2.alias("__k2"))
    same = F.col("__row")[doc_id].eqNullSafe(F.col("__lost._doc")) & (F.col("__k1") == F.col("__lost._k1")) & (F.col("__k2") == F.col("__lost._k2"))
    joined = own.join(side, same, "left")
    old, gone = F.col("__row")[text], F.col("__lost.drop")
    lines = F.split(F.coalesce(old, F.lit("")), "\n", -1)
    stays = F.filter(lines, lambda x, i: ~F.array_contains(gone, i))
    new = F.when(gone.isNull(), old).otherwise(F.array_join(stays, "\n"))
    columns = [new.alias(c) if c == text else F.col("__row")[c].alias(c) for c in docs.columns]
    return joined.select(*columns, F.size(lines).cast("long").alias(counts[0]), F.coalesce(F.size(gone), F.lit(0)).cast("long").alias(counts[1]))
