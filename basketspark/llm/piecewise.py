"""Document fingerprints by context-triggered piecewise hashing (operator 13).

A rolling hash over the last eight bytes of the UTF-8 text sets boundaries wherever its low
``k`` bits are zero, so a boundary depends on its surroundings only and edits elsewhere leave it
in place; where no boundary comes within ``8 * 2**k`` bytes, one is set there (text that repeats
one short pattern has the same few windows throughout). ``k``, the block size, is the smallest
that cuts the whole text into at most 64 pieces. A signature is one 18-bit hash per piece, written
as three characters; a fingerprint ``k:signature:signature`` has those at ``k`` and ``k + 1``.

Two fingerprints are alike by the edit distance of their signatures at a common block size:
1 - distance / length of the longer one, the better of two common sizes, 0 without any.

Neighbours in a table: rows are range-partitioned and sorted by id; each task goes through its
rows in order, holding one text and the next, and only the first and the last text of a
partition travel on. Texts are shuffled once.

Defined cases: a null text is empty and an empty text has no piece (``0::``): alike 1 to another
empty one and 0 to any other; texts of any length are cut whole; null ids come first, rows of one
id in the order of a hash of their texts; repeated rows are neighbours of each other; the last row
is followed by the first, a single row by itself; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType
from pyspark.sql.window import Window

from basketspark.llm.text import package_path, pinned, renamed, text_keys

WINDOW = 8
MOST_PIECES = 64
LONGEST = 8  # pieces are at most so many block sizes long
SYMBOL = 3  # characters of a piece in a signature
_FACTOR = 0x01000193
_SHIFTS = np.array([12, 6, 0], np.uint32)
_ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)


def rolling_hashes(data: np.ndarray) -> np.ndarray:
    """Hash (uint32) of the window of ``WINDOW`` bytes that ends at each byte; bytes before the
    first count as nothing."""
    h = (data.astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    step, factor = 1, _FACTOR
    while step < WINDOW:  # windows of 2, 4 and 8 bytes from halves
        whole = h.copy()
        whole[step:] += h[:-step] * np.uint32(factor)
        h, step, factor = whole, 2 * step, factor * factor & 0xFFFFFFFF
    h ^= h >> np.uint32(16)
    h *= np.uint32(0x85EBCA6B)
    return h ^ (h >> np.uint32(13))


def boundaries(hashes: np.ndarray, k: int, known: np.ndarray | None = None) -> np.ndarray:
    """Where the window before has ``k`` low zero bits, of all places or the known ones."""
    zeros = np.uint32((1 << min(k, 32)) - 1)
    if known is None:
        return np.flatnonzero((hashes[:-1] & zeros) == 0) + 1
    return known[(hashes[known - 1] & zeros) == 0]


def piece_ends(natural: np.ndarray, size: int, k: int) -> np.ndarray:
    """Where the pieces of a text of ``size`` bytes end, with its boundaries at block size ``2**k``."""
    longest = LONGEST << k
    ends = np.concatenate([natural, [size]])
    gaps = ends.copy()
    gaps[1:] -= ends[:-1]
    if gaps.max() <= longest:
        return ends
    parts = -(-gaps // longest)
    number = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts) + 1
    return np.minimum(np.repeat(ends - gaps, parts) + number * longest, np.repeat(ends, parts))


def _signature(raw: bytes, ends: np.ndarray) -> str:
    cuts = [0, *ends.tolist()]
    h = np.array([xxhash.xxh32_intdigest(raw[a:b]) for a, b in zip(cuts, cuts[1:])], np.uint32)
    return _ALPHABET[(h[:, None] >> _SHIFTS) & np.uint32(63)].tobytes().decode()


def fingerprint(raw: bytes) -> str:
    """The fingerprint of one text (UTF-8)."""
    if not raw:
        return "0::"
    hashes, size = rolling_hashes(np.frombuffer(raw, np.uint8)), len(raw)
    k = 0
    while size > MOST_PIECES * (LONGEST << k):  # below that no block size can do
        k += 1
    natural = boundaries(hashes, k)
    while len(natural) >= MOST_PIECES or len(ends := piece_ends(natural, size, k)) > MOST_PIECES:
        k += 1
        natural = boundaries(hashes, k, natural)
    coarser = piece_ends(boundaries(hashes, k + 1, natural), size, k + 1)
    return f"{k}:{_signature(raw, ends)}:{_signature(raw, coarser)}"


def _symbols(signature: str) -> list[str]:
    return [signature[i : i + SYMBOL] for i in range(0, len(signature), SYMBOL)]


def edit_distance(a: list[str], b: list[str]) -> int:
    """Insertions, deletions and replacements between two lists of symbols; the columns of the
    table of distances are bits of integers."""
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    a, b = a[same:], b[same:]
    if not a or not b:
        return len(a) + len(b)
    places: dict[str, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    every, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    more, less, distance = every, 0, len(a)
    for y in b:
        match = places.get(y, 0)
        down = match | less
        across = (((match & more) + more) ^ more) | match
        up = less | (~(across | more) & every)
        low = more & across
        distance += (up & last > 0) - (low & last > 0)
        up = (up << 1 | 1) & every
        more = (low << 1 & every) | (~(down | up) & every)
        less = up & down
    return distance


def likeness(one: str, other: str) -> float:
    """How alike two fingerprints are, 0 to 1."""
    if one == other:
        return 1.0
    found = 0.0
    (ka, *sa), (kb, *sb) = one.split(":"), other.split(":")
    for i in range(2):
        j = int(ka) + i - int(kb)
        if 0 <= j < 2 and sa[i] and sb[j]:
            a, b = _symbols(sa[i]), _symbols(sb[j])
            found = max(found, 1 - edit_distance(a, b) / max(len(a), len(b)))
    return found


def fingerprint_texts(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """(doc_id, fingerprint) per document row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(raw or b"") for (raw,) in _each(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints, pa.string())], names=["doc_id", "fingerprint"])

    src = renamed(docs, {doc_id: "doc_id", text: "text"}).withColumn("text", F.col("text").cast("binary"))
    return src.mapInArrow(rows, f"doc_id {dict(src.dtypes)['doc_id']}, fingerprint string")


def compare_fingerprints(pairs: DataFrame, left="left", right="right", name="likeness") -> DataFrame:
    """Adds ``name``: the likeness of the fingerprints in two columns (null if one is null)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [None if a is None or b is None else likeness(a, b) for a, b in _each(batch, left, right)]
            yield batch.append_column(name, pa.array(values, pa.float64()))

    src = package_path(pairs)
    return src.mapInArrow(rows, StructType([*src.schema.fields, StructField(name, DoubleType())]))


def _each(batch: pa.RecordBatch, *columns: str) -> Iterator[tuple]:
    """The values of the columns row by row, so that one text at a time is a Python object."""
    for i in range(batch.num_rows):
        yield tuple(batch.column(c)[i].as_py() for c in columns)


def _places(raw: bytes, n: int) -> int:
    """Bytes that the first n code points of a text take (all of them if there are fewer)."""
    data = np.frombuffer(raw, np.uint8)
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    return int(starts[n]) if n < len(starts) else len(raw)


def edited(raw: bytes, following: bytes, share: int = 4) -> tuple[int, bytes]:
    """(code points of the text, the text with its last n // share code points replaced by the
    first as many of the following one)."""
    n = int(np.count_nonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))
    return n, raw[: _places(raw, n - n // share)] + following[: _places(following, n // share)]


def _compared(raw: bytes, own: str, following: bytes, next_print: str) -> tuple:
    n, changed = edited(raw, following)
    changed_print = fingerprint(changed)
    return n, hashlib.sha256(changed).hexdigest(), own, changed_print, likeness(own, changed_print), likeness(own, next_print)


_FIELDS = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_TYPES = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_NAMES = [f.split()[0] for f in _FIELDS.split(", ")]


def _columns(out: list[tuple], at: int = 0) -> list[pa.Array]:
    return [pa.array([o[at + i] for o in out], t) for i, t in enumerate(_TYPES)]


def edited_neighbours(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """One row per document row: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next. The edited text has its last quarter replaced by
    the beginning of the next document in the order of ids; near_edited and near_next are the
    likeness of the document's fingerprint to the edited text's and to the next document's."""
    src = renamed(docs, {doc_id: "doc_id", text: "text"}).select("doc_id", *text_keys(F.col("text")), F.col("text").cast("binary").alias("text"))
    order = [F.col(c).asc_nulls_first() for c in ("doc_id", "k1", "k2")]
    ranged = src.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = dict(src.dtypes)["doc_id"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held = None  # (id, text, its fingerprint, the text once more if it's the partition's first)
        typed = None
        for batch in batches:
            typed = batch.column("doc_id").type
            out = []
            for d, raw in _each(batch, "doc_id", "text"):
                raw = raw or b""
                own = fingerprint(raw)
                if held:
                    out.append((held[0], held[3], None, *_compared(held[1], held[2], raw, own)))
                held = d, raw, own, None if held else raw
            if out:
                yield record(part, out, typed)
        if held:
            yield record(part, [(held[0], held[3], held[1], None, None, held[2], None, None, None)], typed)

    def record(part: int, out: list[tuple], typed: pa.DataType) -> pa.RecordBatch:
        own = [pa.array([o[0] for o in out], typed), pa.array([part] * len(out), pa.int32())]
        ends = [pa.array([o[i] for o in out], pa.binary()) for i in (1, 2)]
        return pa.RecordBatch.from_arrays([*own, *ends, *_columns(out, 3)], names=["doc_id", "part", "head", "tail", *_NAMES])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_compared(raw, own, after, fingerprint(after)) for raw, own, after in _each(batch, "tail", "fingerprint", "head")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *_columns(out)], names=["doc_id", *_NAMES])

    done = pinned(ranged.mapInArrow(rows, f"doc_id {kind}, part int, head binary, tail binary, {_FIELDS}"), "neighbours")
    # One row per range partition: the part after it, the first one after the last.
    heads = done.where("head is not null").select("part", "head")
    parts = heads.select("part", F.lit(0).alias("all"))
    whole = Window.partitionBy("all").orderBy("part")
    first = F.min("part").over(Window.partitionBy("all"))
    after = parts.select("part", F.coalesce(F.lead("part").over(whole), first).alias("next"))
    ends = done.where("tail is not null").select("doc_id", "part", "tail", "fingerprint")
    met = ends.join(after, "part").join(heads.withColumnRenamed("part", "next"), "next").select("doc_id", "tail", "fingerprint", "head")
    return done.where("tail is null").select("doc_id", *_NAMES).unionByName(met.mapInArrow(finish, f"doc_id {kind}, {_FIELDS}"))
