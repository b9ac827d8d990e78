"""Substring deduplication by level-wise doubling (operator 6).

Short windows of words are looked at first; a long window goes on only if one that it holds occurs
elsewhere, and is then looked at by windows of twice the length, and so on, the asked length at
last (``levels``), until no candidates survive.

A long window is looked at by its smallest window of a level's length (by hash, leftmost if
equal), which equal long windows share, so on the first level about two short windows in every
half of a long one are compared, and later levels hash only what is left. Windows longer than the
asked length would not change which words are covered, so the doubling ends there.

On every level the windows' hashes are compared without a row per window: documents are
gathered in chunks, each chunk sends its distinct hashes as sorted runs to ranges of the hash
space, and gets back one bit per hash. A passage that a third of all documents share is one
entry per chunk. Texts are shuffled once, to meet the results of the first level. Windows are
told by 128 bits: two independent hashes of words, joined pairwise while the length doubles.

Defined cases: a null text has no words; a text shorter than the window loses nothing; texts of
any length are worked on whole; repeated rows and copies repeat each other's windows wholly; null
and repeated ids are allowed, the text identifies the work; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketspark.llm.text import CHUNK_BYTES, joined_keys, package_path, pinned, slices, text_keys, word_keys

#: Hashes that one range of the hash space holds on average, and ranges at least.
RANGE_HASHES = 500_000
MIN_RANGES = 64
#: The first level's windows have between so many words and half as many more than that.
FIRST_WORDS = 8


def levels(window: int) -> list[int]:
    """The window lengths looked at, shortest first: each is half of the next (rounded up), the
    last is the asked length."""
    out = [window]
    while out[0] >= 2 * FIRST_WORDS:
        out.insert(0, (out[0] + 1) // 2)
    return out


def _starts(first: np.ndarray, length: int) -> np.ndarray:
    """Word numbers at which a window of ``length`` words of one text begins."""
    begin, count = first[:-1], np.maximum(0, np.diff(first) - length + 1)
    return np.repeat(begin - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())


def window_keys(words: list[np.ndarray], length: int) -> np.ndarray:
    """Two hashes of the ``length`` words from each word on (n + 1 rows; those at which no such
    window begins mean nothing)."""
    n = len(words[0])
    out = np.zeros((n + 1, 2), np.uint64)
    for lane, w in enumerate(words):
        h, size = w, 1
        while 2 * size <= length:
            h, size = joined_keys(h[: max(0, len(h) - size)], h[size:], lane), 2 * size
        if size < length:  # two windows that overlap and cover all words
            rest = length - size
            h = joined_keys(h[: max(0, len(h) - rest)], h[rest:], lane)
        out[: len(h), lane] = h
    return out


def smallest_windows(keys: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """For each start the place of the smallest of ``width`` windows from there on, by their
    first hash, leftmost if equal."""
    first = keys[:, 0]
    # By doubling the span compared.
    span, best, at = 1, np.arange(len(first)), np.arange(len(first))
    better = lambda a, b: np.where(first[b] < first[a], b, a)
    while 2 * span <= width:
        best = better(best, best[np.minimum(at + span, len(first) - 1)])
        span *= 2
    return better(best[starts], best[starts + width - span])


def distinct_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct rows in order, the row's number for each row, how often each occurs)."""
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    ranked = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return ranked[new], number, np.diff(np.append(np.flatnonzero(new), len(keys)))


def _keys_of(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint64).reshape(-1, 2)


def _runs(ranges: int):
    """For each chunk its distinct hashes, sorted, cut at the ranges, with a bit for those
    that occur twice inside the chunk."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for chunk, raw in zip(pdf["chunk"], pdf["hashes"]):
                h, _, n = distinct_keys(_keys_of(raw))
                cuts = np.searchsorted(((h[:, 0] >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32), np.arange(ranges + 1))
                some = np.flatnonzero(np.diff(cuts))
                yield pd.DataFrame({
                    "bucket": some.astype(np.int32), "chunk": chunk,
                    "run": [h[cuts[b] : cuts[b + 1]].tobytes() for b in some],
                    "twice": [np.packbits(n[cuts[b] : cuts[b + 1]] > 1).tobytes() for b in some],
                })

    return rows


def _marks(pdf: pd.DataFrame) -> pd.DataFrame:
    runs = [_keys_of(r) for r in pdf["run"]]
    twice = [np.unpackbits(np.frombuffer(t, np.uint8), count=len(r)) for t, r in zip(pdf["twice"], runs)]
    _, where, _ = distinct_keys(np.concatenate(runs))
    count = np.bincount(where, 1.0 + np.concatenate(twice))
    marks = np.split(count[where] > 1, np.cumsum([len(r) for r in runs])[:-1])
    return pd.DataFrame({"chunk": pdf["chunk"], "bucket": pdf["bucket"], "n": [len(r) for r in runs], "marks": [np.packbits(m).tobytes() for m in marks]})


def repeated_hashes(chunks: DataFrame, total: int) -> DataFrame:
    """(chunk, marks): for each chunk (chunk, hashes: binary, two uint64 each) which of its
    distinct hashes, sorted, occur twice or more over all chunks. total: hashes in all, about."""
    ranges = max(MIN_RANGES, -(-total // RANGE_HASHES))
    runs = chunks.mapInPandas(_runs(ranges), "bucket int, chunk long, run binary, twice binary")
    marks = runs.groupBy("bucket").applyInPandas(_marks, "chunk long, bucket int, n int, marks binary")
    return marks.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("bucket", "n", "marks"))).alias("marks"))


def _is_repeated(hashes: np.ndarray, marks: list[dict]) -> np.ndarray:
    if not len(hashes):
        return np.zeros(0, bool)
    bits = np.concatenate([np.unpackbits(np.frombuffer(m["marks"], np.uint8), count=m["n"]) for m in marks]).astype(bool)
    return bits[distinct_keys(hashes)[1]]


def _chunk_ids() -> Iterator[int]:
    task = TaskContext.get()
    n = (task.partitionId() if task else 0) << 32
    while True:
        yield n
        n += 1


def _each(batch: pa.RecordBatch, *columns: str) -> Iterator[tuple]:
    """The values of the columns, row by row: one chunk at a time becomes Python objects."""
    for i in range(batch.num_rows):
        yield tuple(batch.column(c)[i].as_py() for c in columns)


_DOC = "struct<doc_id:{}, k1:long, k2:long, n_words:long, sha:string>"


def _level_one(src: DataFrame, window: int) -> DataFrame:
    """Chunks of documents with the hashes and places of their short windows. Written once."""
    kind = dict(src.dtypes)["doc_id"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _chunk_ids()
        for batch in batches:
            for begin, end, texts in slices(batch, "text"):
                words, first = word_keys(texts)
                length = levels(window)[0]
                keys = window_keys(words, length)
                at = np.unique(smallest_windows(keys, _starts(first, window), window - length + 1))
                part = batch.slice(begin, end - begin)
                sha = [hashlib.sha256(b" ".join(t.split())).hexdigest() for t in texts]
                docs = pa.StructArray.from_arrays(
                    [part.column("doc_id"), part.column("k1"), part.column("k2"), pa.array(np.diff(first), pa.int64()), pa.array(sha)],
                    names=["doc_id", "k1", "k2", "n_words", "sha"],
                )
                columns = [pa.array([next(ids)], pa.int64()), pa.ListArray.from_arrays([0, len(docs)], docs), pa.array([keys[at].tobytes()]), pa.array([at.astype(np.int32).tobytes()])]
                yield pa.RecordBatch.from_arrays(columns, names=["chunk", "docs", "hashes", "places"])

    schema = f"chunk long, docs array<{_DOC.format(kind)}>, hashes binary, places binary"
    return pinned(src.mapInArrow(rows, schema), "short-windows")


def _survivors(chunks: DataFrame, kind: str) -> DataFrame:
    """(k1, k2, doc_id, places): documents with repeated short windows and where they begin."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for docs, hashes, places, marks in _each(batch, "docs", "hashes", "places", "marks"):
                at = np.frombuffer(places, np.int32)[_is_repeated(_keys_of(hashes), marks)]
                first = np.concatenate([[0], np.cumsum([d["n_words"] for d in docs])])
                cuts = np.searchsorted(at, first)
                out += [(d["k1"], d["k2"], d["doc_id"], (at[a:b] - f).astype(np.int32).tobytes()) for d, a, b, f in zip(docs, cuts, cuts[1:], first) if a < b]
            kinds = [pa.int64(), pa.int64(), batch.column("docs").type.value_type.field("doc_id").type, pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)], names=["k1", "k2", "doc_id", "places"])

    return chunks.mapInArrow(rows, f"k1 long, k2 long, doc_id {kind}, places binary")


def _candidate_texts(texts: DataFrame) -> DataFrame:
    """Chunks of candidate texts (chunk, k1, k2, texts, places: arrays). Written once."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _chunk_ids()
        for batch in batches:
            for begin, end, found in slices(batch, "text", CHUNK_BYTES // 2):
                part = batch.slice(begin, end - begin)
                lists = [pa.array([part.column(c).to_pylist()], pa.list_(t)) for c, t in (("k1", pa.int64()), ("k2", pa.int64()), ("places", pa.binary()))]
                yield pa.RecordBatch.from_arrays([pa.array([next(ids)], pa.int64()), *lists, pa.array([found], pa.list_(pa.binary()))], names=["chunk", "k1", "k2", "places", "texts"])

    return pinned(texts.mapInArrow(rows, "chunk long, k1 array<long>, k2 array<long>, places array<binary>, texts array<binary>"), "candidate-texts")


def _first_starts(words: list[np.ndarray], first: np.ndarray, places: list[bytes], window: int) -> np.ndarray:
    """Beginnings of the long windows whose smallest first-level window repeats."""
    length = levels(window)[0]
    starts = _starts(first, window)
    able = np.zeros(len(words[0]) + 1, bool)
    for p, f in zip(places, first):
        able[np.frombuffer(p, np.int32) + f] = True
    return starts[able[smallest_windows(window_keys(words, length), starts, window - length + 1)]]


def _seen_at(texts: list[bytes], places: list[bytes], starts: bytes | None, length: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of the distinct windows of ``length`` words by which the long windows are seen,
    beginnings of the long windows, which of the hashes each one has)."""
    words, first = word_keys(texts)
    begin = _first_starts(words, first, places, window) if starts is None else np.frombuffer(starts, np.int32).astype(np.int64)
    keys = window_keys(words, length)
    at, which = np.unique(smallest_windows(keys, begin, window - length + 1), return_inverse=True)
    return keys[at], begin, which


def _level_hashes(length: int, window: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, texts, places, starts in _each(batch, "chunk", "texts", "places", "starts"):
                hashes = _seen_at(texts, places, starts, length, window)[0]
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([hashes.tobytes()])], names=["chunk", "hashes"])

    return rows


def _level_survivors(length: int, window: int):
    """(chunk, starts): the long windows that are left, per chunk that has any."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, texts, places, starts, marks in _each(batch, "chunk", "texts", "places", "starts", "marks"):
                hashes, begin, which = _seen_at(texts, places, starts, length, window)
                left = begin[_is_repeated(hashes, marks)[which]]
                if len(left):
                    yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([left.astype(np.int32).tobytes()])], names=["chunk", "starts"])

    return rows


def _cut(window: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for texts, raw, k1, k2 in _each(batch, "texts", "starts", "k1", "k2"):
                starts = np.frombuffer(raw, np.int32)
                split = [t.split() for t in texts]
                first = np.concatenate([[0], np.cumsum([len(w) for w in split])]).astype(np.int64)
                edge = np.zeros(first[-1] + window + 1, np.int64)
                edge[starts] += 1
                edge[starts + window] -= 1
                gone = np.cumsum(edge)[: first[-1]] > 0
                for i, words in enumerate(split):
                    lost = gone[first[i] : first[i + 1]]
                    if lost.any():
                        kept = b" ".join(w for w, x in zip(words, lost.tolist()) if not x)
                        out.append((k1[i], k2[i], int(lost.sum()), hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)], names=["k1", "k2", "n_removed", "kept_sha256", "kept"])

    return rows


def _surviving_windows(two: DataFrame, window: int, n_words: int) -> DataFrame | None:
    """(chunk, starts) after the levels that follow the first, or None if no candidates survive."""
    alive = None
    for n, length in enumerate(levels(window)[1:] or [window]):
        held = two.withColumn("starts", F.lit(None).cast("binary")) if alive is None else two.join(alive, "chunk")
        hashes = held.mapInArrow(_level_hashes(length, window), "chunk long, hashes binary")
        marks = repeated_hashes(hashes, n_words // (4 if length == window else window // 2))
        alive = pinned(held.join(marks, "chunk").mapInArrow(_level_survivors(length, window), "chunk long, starts binary"), f"windows-{n}")
        if alive.isEmpty():
            return None
    return alive


def dedup_substrings(docs: DataFrame, window: int = 35, doc_id="doc_id", text="text", with_text: bool = False) -> DataFrame:
    """One row per document row: doc_id, n_words, n_removed, kept_sha256 (of the kept words
    joined by a space); with_text adds kept_text of the documents that lost words (null for
    the others, whose text is unchanged)."""
    if window < 2:
        raise ValueError("a window has two words or more")
    k1, k2 = text_keys(F.col(f"`{text}`"))
    src = package_path(docs).select(F.col(f"`{doc_id}`").alias("doc_id"), k1, k2, F.col(f"`{text}`").alias("text"))
    kind = dict(src.dtypes)["doc_id"]
    one = _level_one(src, window)
    base = one.select(F.explode("docs").alias("d")).select("d.*")
    hashes_of = lambda df: df.agg(F.sum(F.octet_length("hashes"))).first()[0] or 0
    marked = one.join(repeated_hashes(one.select("chunk", "hashes"), hashes_of(one) // 16), "chunk")
    found = _survivors(marked.select("docs", "hashes", "places", "marks"), kind)
    # One row per text: of copies the one with the smallest id stands for all of them.
    reps = found.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.first("places").alias("places"))
    reps = pinned(reps.select(F.col("k1").alias("a"), F.col("k2").alias("b"), "rep", "places"), "repeated-windows")
    same = (F.col("k1") == F.col("a")) & (F.col("k2") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("rep"))
    two = _candidate_texts(src.join(reps, same).select("k1", "k2", "places", "text"))
    alive, lost = None, None
    if not two.isEmpty():
        alive = _surviving_windows(two, window, base.agg(F.sum("n_words")).first()[0] or 0)
    if alive is not None:
        cut = two.join(alive, "chunk").mapInArrow(_cut(window), "k1 long, k2 long, n_removed long, kept_sha256 string, kept binary")
        cut = cut if with_text else cut.drop("kept")
        # Rows repeated with the same id and text were cut alike.
        lost = pinned(cut.dropDuplicates(["k1", "k2"]), "cut-texts")
    copies = base.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("copies"))
    if lost is None:
        lost = copies.sparkSession.createDataFrame([], "k1 long, k2 long, n_removed long, kept_sha256 string, kept binary")
    # Written, so that a text with very many copies is a plain skewed key of the next join.
    texts = pinned(copies.join(lost, ["k1", "k2"], "left"), "text-results")
    out = base.join(texts, ["k1", "k2"], "left")
    whole = (F.col("copies") > 1) & (F.col("n_words") >= window)
    removed = F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
    sha = F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha"))
    columns = [F.col("doc_id"), F.col("n_words"), removed.cast("long").alias("n_removed"), sha.alias("kept_sha256")]
    if with_text:
        columns.append(F.when(whole, F.lit("")).otherwise(F.col("kept").cast("string")).alias("kept_text"))
    return out.select(*columns)
