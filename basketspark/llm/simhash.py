"""SimHash near-duplicates by multi-index hashing (operator 2).

A fingerprint has bit b set if b is set in over half of the XXH64 values (seed 42) of the
text's word shingles. Fingerprints link at ``max_distance`` or fewer differing bits.

Search: a fingerprint has two segments of 32 bits, and a table per segment holds all fingerprints
under the value of their segment. Two fingerprints within ``d`` bits differ by ``d // 2`` or fewer in
one segment at least (at even ``d``: in the first, or by one less in the second), so all values in
that small Hamming ball of a segment are looked up in its table, and the complete distance of every
match is verified. A segment value that more than ``CROWD`` fingerprints share is split by the other
segment, not capped: both sides enumerate half of the distance around the other segment and meet
there, so one key holds few fingerprints whatever the data.

Defined cases: a null or word-less text has fingerprint zero, linked like any other; a text
of fewer words than a shingle is one shingle; exact copies and repeated rows share one
fingerprint and one probe; a null doc_id never names a component (a component of null ids
only has a null component_id); an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketspark.llm.components import connected_components
from basketspark.llm.text import pinned, renamed, slices

SEED = 42
_BITS_AT_ONCE = 1 << 16
#: Bits of a segment, and the fingerprints of one segment value from which on it is split.
SEGMENT_BITS = 32
CROWD = 256


def fingerprint(text: bytes, shingle_words: int = 3) -> int:
    """The unsigned 64-bit fingerprint of one text (UTF-8)."""
    joined = b" ".join(text.lower().split())  # bytes.lower() changes A-Z only
    if not joined:
        return 0
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    begin = [0, *(gaps + 1).tolist()]
    end = [*gaps.tolist(), len(joined)][shingle_words - 1 :] or [len(joined)]
    digest = xxhash.xxh64_intdigest
    values = np.array([digest(joined[a:b], SEED) for a, b in zip(begin, end)], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(values), _BITS_AT_ONCE):
        part = values[at : at + _BITS_AT_ONCE].astype("<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(sum(1 << b for b in np.flatnonzero(2 * counts > len(values)).tolist()))


def fingerprints(docs: DataFrame, shingle_words: int = 3, doc_id="doc_id", text="text") -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long. Written once."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, texts in slices(batch, "text"):
                fps = np.array([fingerprint(t, shingle_words) for t in texts], np.uint64)
                ids = batch.column("doc_id").slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([ids, pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    src = renamed(docs, {doc_id: "doc_id", text: "text"})
    return pinned(src.mapInArrow(rows, f"doc_id {dict(src.dtypes)['doc_id']}, fp long"), "fingerprints")


def _segment(fp: Column, number: int) -> Column:
    return F.shiftrightunsigned(fp, SEGMENT_BITS * number).bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1).cast("long"))


def _ball(value: Column, radius: int) -> Column:
    """All values of a segment within ``radius`` flipped bits, the value itself first."""
    if radius == 0:
        return F.array(value)
    once = F.array(value, *[value.bitwiseXOR(F.lit(1 << b).cast("long")) for b in range(SEGMENT_BITS)])
    return once if radius == 1 else F.array_distinct(F.flatten(F.transform(once, lambda x: _ball(x, radius - 1))))


def radii(max_distance: int) -> dict[int, int]:
    """The radius to search in each segment's table (a segment without one isn't searched)."""
    each, more = divmod(max_distance, 2)
    return {0: each} | ({1: each} if more else {1: each - 1} if each else {})


def fingerprint_links(fps: DataFrame, max_distance: int = 2) -> DataFrame:
    """Links (a, b) between distinct fingerprints within ``max_distance``, each once."""
    if not 0 <= max_distance <= 3:
        raise ValueError("max_distance must be 0 to 3: larger balls need more memory than they save")
    fp = F.col("fp")

    def keyed(number: int, radius: int) -> Column:
        rest = _segment(fp, 1 - number)
        return F.transform(_ball(_segment(fp, number), radius), lambda v: F.struct(F.lit(number).alias("segment"), v.alias("value"), rest.alias("rest")))

    searched = radii(max_distance)
    table = fps.select(fp.alias("b"), F.explode(F.concat(*[keyed(s, 0) for s in searched])).alias("t")).select("b", "t.*")
    probe = fps.select(fp.alias("a"), F.explode(F.concat(*[keyed(s, r) for s, r in searched.items()])).alias("t")).select("a", "t.*")
    key = ["segment", "value"]
    crowded = pinned(table.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWD).select(*key), "crowded-segments")

    def met(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
        right = right.select("b", *[F.col(c).alias(f"t_{c}") for c in on])
        same = [F.col(c) == F.col(f"t_{c}") for c in on]
        near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
        return left.join(right, [*same, F.col("a") < F.col("b"), near]).select("a", "b")

    def around(rows: DataFrame, radius: int) -> DataFrame:
        split = rows.join(crowded, key, "left_semi")
        return split.withColumn("rest", F.explode(_ball(F.col("rest"), radius)))

    plain = met(probe.join(crowded, key, "left_anti"), table, key)
    split = met(around(probe, (max_distance + 1) // 2), around(table, max_distance // 2), [*key, "rest"])
    return plain.unionByName(split).distinct()


def simhash_near_dups(docs: DataFrame, shingle_words: int = 3, max_distance: int = 2, doc_id="doc_id", text="text") -> DataFrame:
    """One row per document row: doc_id, fingerprint (16 hex digits), component_id (smallest
    doc_id reachable over links, itself included), n_copies (rows with the same fingerprint)."""
    prints = fingerprints(docs, shingle_words, doc_id, text)
    distinct = pinned(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n_copies")), "distinct-prints")
    roots = connected_components(fingerprint_links(distinct, max_distance), "a", "b")
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = pinned(rooted, "rooted")
    # Written, so that the root of a very large component is a plain skewed key of the join.
    named = pinned(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "component-names")
    members = rooted.join(named, "root").select("fp", "component_id", "n_copies")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return prints.join(members, "fp").select("doc_id", hexed, "component_id", "n_copies")
