"""Small helpers shared by the text operators: row keys, Arrow slices, word hashes.

A word is a maximal run of characters other than space and U+0009 to U+000D. On UTF-8 bytes
that is exactly ``bytes.split()``, so words are always taken from the encoded text.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketspark.runtime import materialize

#: Bytes of text that one in-memory step works on at a time (one document at least), and of the
#: Arrow batches between Spark and its Python workers.
CHUNK_BYTES = 2 << 20
BATCH_BYTES = "16m"


def text_keys(text: Column) -> list[Column]:
    """Two independent 64-bit hashes: together a 128-bit identity of a text (null as empty)."""
    t = F.coalesce(text, F.lit(""))
    return [F.xxhash64(t).alias("k1"), F.xxhash64(F.lit(7), t).alias("k2")]


def package_path(df: DataFrame) -> DataFrame:
    """Lets Python workers import this package from where the driver has it (as installed, or
    on a path that they share), whatever folder they are started in."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = df.sparkSession.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return df


def renamed(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Only the asked columns under new names, so that extra columns cannot clash."""
    return package_path(df).select(*[F.col(f"`{c}`").alias(n) for c, n in columns.items()])


def pinned(df: DataFrame, name: str) -> DataFrame:
    """``materialize`` with batches to Python workers of ``BATCH_BYTES``, which bounds their memory."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = conf.get(key)
    conf.set(key, BATCH_BYTES)
    try:
        return materialize(df, name, dealt=False)
    finally:
        conf.set(key, before)


def slices(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """Runs of rows (begin, end, their texts as UTF-8) of about ``limit`` bytes; null is empty."""
    values = batch.column(column).cast(pa.large_binary())
    begin, size, texts = 0, 0, []
    for i in range(len(values)):
        t = values[i].as_py() or b""
        if texts and size + len(t) > limit:
            yield begin, i, texts
            begin, size, texts = i, 0, []
        texts.append(t)
        size += len(t)
    if texts:
        yield begin, begin + len(texts), texts


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective, every input bit reaches every output bit)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = n + n // 8
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def range_hashes(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of ``values[begin:end]`` for many ranges at once: a polynomial modulo 2**64 over
    the values (uint64), read off one running sum, then mixed. Long regular ranges can collide, so
    it serves as a feature number only; identities are told by ``range_keys``."""
    n = len(values) + 1
    up, down = _powers(n)
    total = np.zeros(n, np.uint64)
    np.cumsum(values * down[: n - 1], out=total[1:])
    return mix((total[end] - total[begin]) * up[begin])


_LANES = ((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93), (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_MASKS = np.array([(1 << 8 * r) - 1 for r in range(9)], np.uint64)
#: Ranges of more bytes than this are hashed one by one by the xxhash library.
_LONG_RANGE = 512


def range_keys(data: np.ndarray, begin: np.ndarray, end: np.ndarray, lanes: int = 1) -> list[np.ndarray]:
    """One or two independent 64-bit hashes of ``data[begin:end]`` (bytes) for many ranges at
    once: all ranges take in their next eight bytes and are mixed, step by step."""
    size = end - begin
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    blocks = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from each place
    out = [mix(size.astype(np.uint64) * np.uint64(a) + np.uint64(b)) for a, b in _LANES[:lanes]]
    left = np.flatnonzero((size > 0) & (size <= _LONG_RANGE))
    done = 0
    while len(left):
        block = blocks[begin[left] + done] & _MASKS[np.minimum(size[left] - done, 8)]
        for h, (a, b) in zip(out, _LANES):
            h[left] = mix(h[left] * np.uint64(b) + block * np.uint64(a))
        done += 8
        left = left[size[left] > done]
    for i in np.flatnonzero(size > _LONG_RANGE).tolist():
        raw = data[begin[i] : end[i]].tobytes()
        for lane, h in enumerate(out):
            h[i] = xxhash.xxh64_intdigest(raw, lane)
    return out


def head_keys(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the first eight bytes (or all) of many ranges of ``data`` at once."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    blocks = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from each place
    return mix(blocks[begin] & _MASKS[np.minimum(end - begin, 8)])


def joined_keys(a: np.ndarray, b: np.ndarray, lane: int) -> np.ndarray:
    """Hash of two parts in order from their hashes of the same lane."""
    k, m = _LANES[lane]
    return mix(a * np.uint64(k) + b * np.uint64(m))


def word_keys(texts: list[bytes], lanes: int = 2) -> tuple[list[np.ndarray], np.ndarray]:
    """(hashes of each word, index of each text's first word and, at last, the word count)."""
    joined = [b" ".join(t.split()) for t in texts]
    counts = np.array([j.count(b" ") + 1 if j else 0 for j in joined], np.int64)
    first = np.concatenate([[0], np.cumsum(counts)])
    data = np.frombuffer(b" ".join(j for j in joined if j), np.uint8)
    if not len(data):
        return [np.zeros(0, np.uint64)] * lanes, first
    gaps = np.flatnonzero(data == 32)
    begin = np.concatenate([[0], gaps + 1])
    end = np.concatenate([gaps, [len(data)]])
    return range_keys(data, begin, end, lanes), first
