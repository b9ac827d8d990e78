"""Embedding near-duplicates by PCA-ordered tiled comparison (operator 3).

Vectors of one label are turned into the axes of the corpus' principal components, most
variance first, cut into blocks along the first component, and every pair of blocks that can
hold a link is compared as a tile: products are accumulated over the leading dimensions
first, the rest is bounded by the product of the suffix norms (Cauchy-Schwarz), and rows,
columns or the whole tile are given up once no cosine can reach the threshold. Cosines near
the threshold are taken again from the original components in double precision.

A tile emits counts per vector and one spanning link per vector and tile component, never its
pairs, so a dense group costs arithmetic but no rows. The axes only order the work; any
orthogonal basis gives the same links.

Defined cases: vectors link only at equal, non-null labels and equal lengths; null, empty or
zero vectors, and those with null or non-finite components, link with nothing; equal vectors
of a label are compared once and count each other; a null vec_id counts as a vector but never
names a component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketspark.llm.components import connected_components
from basketspark.llm.text import pinned, renamed

BLOCK_ROWS = 1024
#: Vectors from which the principal axes are fitted, at most about so many.
AXES_ROWS = 100_000
#: Computed cosines this near to the threshold are taken again from the original components.
NEAR = 1e-9


def _checked(src: DataFrame) -> DataFrame:
    """vec_id, label, dim, key (digest of a usable vector, else null), unit (float64 bytes)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, dims, raws = [], [], []
            labels, vectors = batch.column("label").to_pylist(), batch.column("vector")
            for label, v in zip(labels, vectors):
                a = np.array([], float) if not v.is_valid or v.values.null_count else v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                usable = label is not None and len(a) and np.isfinite(a).all() and a.any()
                raw = (a + 0.0).tobytes() if usable else None
                keys.append(hashlib.blake2b(f"{label}|".encode() + raw, digest_size=16).digest() if usable else None)
                dims.append(len(a))
                raws.append(raw)
            columns = [batch.column("vec_id"), batch.column("label"), pa.array(dims, pa.int32()), pa.array(keys, pa.binary()), pa.array(raws, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "dim", "key", "raw"])

    kinds = dict(src.dtypes)
    return src.mapInArrow(rows, f"vec_id {kinds['vec_id']}, label {kinds['label']}, dim int, key binary, raw binary")


def _unit(raw: list[bytes]) -> np.ndarray:
    """Scaled by the largest component first, so that squares neither overflow nor vanish."""
    a = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    a = a / np.abs(a).max(1, keepdims=True)
    return a / np.sqrt((a * a).sum(1, keepdims=True))


def principal_axes(vectors: DataFrame, sample_rows: int = AXES_ROWS) -> dict[int, np.ndarray]:
    """For each vector length the principal axes (columns, most variance first), from the
    second moments of about ``sample_rows`` unit vectors picked by a hash of their key. The
    axes order the comparison only, so the sample never changes a link."""

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                u = _unit(part["raw"].tolist())
                total[dim] = total.get(dim, 0) + u.T @ u
        yield pd.DataFrame({"dim": list(total), "m": [m.tobytes() for m in total.values()]})

    share = min(1.0, sample_rows / max(1, vectors.count()))
    sample = vectors.where(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    found = {row.dim: np.eye(row.dim) for row in vectors.select("dim").distinct().collect()}  # one row a length
    for row in sample.select("dim", "raw").coalesce(8).mapInPandas(moments, "dim int, m binary").collect():
        found[row.dim] = found[row.dim] + np.frombuffer(row.m, np.float64).reshape(row.dim, row.dim)
    return {dim: np.linalg.eigh(m)[1][:, ::-1] for dim, m in found.items()}


def _blocks(vectors: DataFrame, axes: dict[int, np.ndarray], block_rows: int) -> DataFrame:
    """Distinct vectors ranged by (label, dim, first component) and cut into blocks: label,
    dim, block, first, key, n, raw. Written once, which pins the blocks."""

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["first"] = 0.0
            for dim, at in pdf.groupby("dim").groups.items():
                pdf.loc[at, "first"] = _unit(pdf.loc[at, "raw"].tolist()) @ axes[dim][:, 0]
            yield pdf

    kind = dict(vectors.dtypes)["label"]
    ranged = (
        vectors.mapInPandas(project, f"label {kind}, dim int, key binary, n long, raw binary, first double")
        .repartitionByRange("label", "dim", "first", "key")
        .sortWithinPartitions("label", "dim", "first", "key")
        .withColumn("row", F.monotonically_increasing_id())
    )
    # A block is a run of one range partition's rows; label and dim are part of its key.
    return pinned(ranged.withColumn("block", (F.col("row") / block_rows).cast("long")).drop("row"), "blocks")


def _spanning(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For the links a-b among n nodes: the smallest node of each node's component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def tile_links(x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers with cosine >= threshold. x, y: unit vectors; px, py: the same
    in principal axes."""
    dim = x.shape[1]
    cuts = sorted({min(dim, max(1, dim // 8)), min(dim, max(1, dim // 2)), dim})
    rows, cols = np.arange(len(x)), np.arange(len(y))
    total, done = np.zeros((len(x), len(y))), 0
    for cut in cuts:
        total += px[rows, done:cut] @ py[cols, done:cut].T
        done = cut
        rest_x = np.sqrt((px[rows, cut:] ** 2).sum(1))
        rest_y = np.sqrt((py[cols, cut:] ** 2).sum(1))
        able = total + np.outer(rest_x, rest_y) >= threshold - NEAR
        r, c = able.any(1), able.any(0)
        rows, cols, total = rows[r], cols[c], total[np.ix_(r, c)]
        if not len(rows):
            return rows, cols
    i, j = np.nonzero(total >= threshold - NEAR)
    value = total[i, j]
    near = np.abs(value - threshold) < NEAR
    value[near] = (x[rows[i[near]]] * y[cols[j[near]]]).sum(1)
    return rows[i[value >= threshold]], cols[j[value >= threshold]]


def _compare(axes: dict[int, np.ndarray], threshold: float):
    def tile(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["block", "key"], kind="stable")
        left = (pdf["block"] == pdf["a"]).to_numpy()
        u = _unit(pdf["raw"].tolist())
        p = u @ axes[int(pdf["dim"].iloc[0])]
        at_x, at_y = np.flatnonzero(left), np.flatnonzero(~left) if not left.all() else np.flatnonzero(left)
        i, j = tile_links(u[at_x], u[at_y], p[at_x], p[at_y], threshold)
        i, j = at_x[i], at_y[j]
        if left.all():
            i, j = i[i < j], j[i < j]
        n = pdf["n"].to_numpy()
        linked = np.bincount(i, n[j], len(pdf)) + np.bincount(j, n[i], len(pdf))
        root = _spanning(i, j, len(pdf))
        some = linked > 0
        keys = pdf["key"].to_numpy()
        return pd.DataFrame({"key": keys[some], "links": linked[some].astype(np.int64), "root": keys[root[some]]})

    return tile


def embedding_near_dups(
    vectors: DataFrame, threshold: float = 0.93, vec_id="vec_id", embedding="embedding", label="label", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """One row per vector row: vec_id, n_links (other vectors linked directly), component_id
    (smallest vec_id reachable, itself included), kept (vec_id is the component_id)."""
    src = renamed(vectors, {vec_id: "vec_id", label: "label", embedding: "vector"})
    checked = pinned(_checked(src), "vectors")
    usable = checked.where("key is not null")
    distinct = pinned(
        usable.groupBy("key").agg(
            F.first("label").alias("label"), F.first("dim").alias("dim"), F.count(F.lit(1)).alias("n"), F.first("raw").alias("raw"), F.min("vec_id").alias("least")
        ),
        "distinct-vectors",
    )
    axes = principal_axes(distinct)
    blocks = _blocks(distinct.select("label", "dim", "key", "n", "raw"), axes, block_rows)
    ends = blocks.groupBy("label", "dim", "block").agg(F.min("first").alias("low"), F.max("first").alias("high"))
    # Unit vectors with cosine >= t are no further apart than sqrt(2 - 2t) along any axis.
    apart = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-9
    one = ends.select("label", "dim", F.col("block").alias("a"), F.col("low").alias("low_a"), F.col("high").alias("high_a"))
    two = ends.select("label", "dim", F.col("block").alias("b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"))
    tiles = one.join(two, ["label", "dim"]).where((F.col("a") <= F.col("b")) & (F.col("low_b") <= F.col("high_a") + apart) & (F.col("low_a") <= F.col("high_b") + apart))
    ends_of = F.when(F.col("a") == F.col("b"), F.array("a")).otherwise(F.array("a", "b"))
    tiles = tiles.select("label", "dim", "a", "b", F.explode(ends_of).alias("block"))
    rows = blocks.join(tiles, ["label", "dim", "block"]).select("label", "dim", "a", "b", "block", "key", "n", "raw")
    found = rows.groupBy("label", "dim", "a", "b").applyInPandas(_compare(axes, threshold), "key binary, links long, root binary")
    found = pinned(found, "tile-links")
    roots = connected_components(found, "key", "root")
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    members = distinct.select("key", "n", "least").join(links, "key", "left").join(roots.withColumnRenamed("node", "key"), "key", "left")
    members = pinned(members.withColumn("root", F.coalesce("root", "key")), "members")
    # Written, so that the root of a very large component is a plain skewed key of the join.
    named = pinned(members.groupBy("root").agg(F.min("least").alias("component")), "component-names")
    members = members.join(named, "root").select("key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component")
    joined = checked.select("vec_id", "key").join(members, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.cast("long").alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
