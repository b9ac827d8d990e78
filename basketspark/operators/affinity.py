"""Pair statistics of product groups co-viewed in a basket (support, confidence, lift).

Input contract: ``basket_key``, ``coupon`` (group name) and ``coupon_key`` (integer key,
one per name), plus optional ``by`` columns that split the input into independent runs
(e.g. ``perm_id`` for permutations). Rows with a null basket or group key are ignored.

Four physical forms with equal results:

* ``blocks`` (default): the distinct (basket, group) rows are written once (``pin``) and pruned to
  the groups above the threshold. A basket's groups are cut into blocks of about
  ``BLOCK_GROUPS``, blocks meet in the upper triangle of block pairs, one row per block pair, and
  the pairs of a row are made in one task with ``x < y``. Each pair of a basket is made once and
  nothing is joined with itself; a basket of very many groups is as many rows as it has block
  pairs, dealt over all tasks by their hash, with or without adaptive execution.
* ``dense``: for large baskets. The groups, not the baskets, are dealt to parts; two parts meet in
  one task with all their baskets, which counts their pairs by blocks of ``DENSE_GROUPS`` groups.
  Nothing is shuffled per pair.
* ``half``: the pruned rows meet themselves on the basket with ``x < y``.
* ``join``: the original form - distinct (group, basket) rows, a self-join on the basket
  with ``key_X != key_Y``, and a distinct count per pair. Kept as the reference form.

``confident_pairs_pushed`` takes the minimum confidence into the counting.

Scalars (basket total, percentile threshold) stay on the cluster: scalar subqueries when
``by`` is empty, otherwise one row per ``by`` group joined back.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketspark.config import RARE_GROUP_PERCENTILE
from basketspark.functions.columns import confidence, lift, support
from basketspark.runtime import materialize

MATRIX_COLUMNS = (
    "coupon_key_X",
    "coupon_X",
    "coupon_key_Y",
    "coupon_Y",
    "basket_count_X",
    "basket_count_Y",
    "basket_count_XY",
    "confidence",
    "lift",
    "support",
)


#: Groups of a basket in one block, about; larger baskets have several blocks.
BLOCK_GROUPS = 64
#: Groups in one block of groups of the dense form, and baskets of a group sent, or multiplied, at once.
DENSE_GROUPS = 2048
_DENSE_BASKETS = 4096
#: Parts that the groups of the dense form are dealt to while a part has fewer rows than this, about.
_DENSE_PARTS = 24
_DENSE_ROWS = 2_000_000
#: Rows that a task of the self-join's shuffles holds, about; their number of tasks follows from it.
_JOIN_ROWS = 250_000
_DENSE_SENT = 1 << 14  # pairs that a task returns at once
_DENSE_MET = 1 << 22  # pairs that it counts at once, about
_SALTS = 16


@dataclasses.dataclass(frozen=True)
class Affinity:
    counts: DataFrame  # by, coupon_key, coupon, basket_count  (all groups)
    frequent: DataFrame  # same columns, groups above the threshold
    totals: DataFrame  # by, total_basket_count
    thresholds: DataFrame  # by, basket_threshold
    matrix: DataFrame  # by, MATRIX_COLUMNS


def _threshold_expr(t: float) -> Column:
    # Exact linear-interpolated percentile (numpy's default), at least 1. Group counts are
    # integers, so the aggregation buffer holds one entry per distinct count value.
    return F.greatest(F.percentile("basket_count", F.lit(t / 100.0)), F.lit(1.0)).alias("basket_threshold")


def _attach(df: DataFrame, values: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Attach a per-run scalar: a scalar subquery without ``by``, else a join on ``by``."""
    if not by:
        return df.withColumn(name, values.select(name).scalar())
    return df.join(values, list(by), "inner")  # one row per run: Spark picks the join by its size


def _clean(baskets: DataFrame, by: Sequence[str]) -> DataFrame:
    return baskets.select(*by, "basket_key", "coupon_key", "coupon").where(
        F.col("basket_key").isNotNull() & F.col("coupon_key").isNotNull()
    )


def pair_matrix(
    baskets: DataFrame,
    t: float = RARE_GROUP_PERCENTILE,
    by: Sequence[str] = (),
    method: str = "blocks",
    pin: bool = True,
) -> Affinity:
    by = list(by)
    rows = _clean(baskets, by)
    if method in ("blocks", "half"):
        return _half_pairs(rows, t, by, pin, method)
    if method == "join":
        return _pairs_from_join(rows, t, by, pin)
    if method == "dense":
        if by:
            raise ValueError("the dense form has no runs")
        return _dense_pairs(_groups(rows, t, by, pin), None)
    raise ValueError(f"unknown method {method!r}")


def _frequent(counts: DataFrame, t: float, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """Percentile threshold per run and the groups strictly above it."""
    thresholds = counts.groupBy(*by).agg(_threshold_expr(t)) if by else counts.agg(_threshold_expr(t))
    frequent = (
        _attach(counts, thresholds, by, "basket_threshold")
        .where(F.col("basket_count") > F.col("basket_threshold"))
        .drop("basket_threshold")
    )
    return thresholds, frequent


def _side(frequent: DataFrame, by: list[str], tag: str) -> DataFrame:
    return frequent.select(
        *by,
        F.col("coupon_key").alias(f"coupon_key_{tag}"),
        F.col("coupon").alias(f"coupon_{tag}"),
        F.col("basket_count").alias(f"basket_count_{tag}"),
    )


def _assemble(counts, thresholds, frequent, totals, pair_counts, by: list[str], mirrored: bool) -> Affinity:
    """Mirror half pairs, attach names and counts of both groups, add the metrics."""
    pairs = pair_counts.join(_side(frequent, by, "X"), [*by, "coupon_key_X"], "inner").join(
        _side(frequent, by, "Y"), [*by, "coupon_key_Y"], "inner"
    )
    if mirrored:
        # Both orientations from one row (a generator, not a union of two plans), once the names
        # and counts are there: half as many rows are dealt for them.
        named = ("coupon_key", "coupon", "basket_count")
        turned = lambda a, b: F.struct(*[F.col(f"{c}_{t}").alias(f"{c}_{u}") for t, u in ((a, "X"), (b, "Y")) for c in named])
        pairs = pairs.select(*by, "basket_count_XY", F.inline(F.array(turned("X", "Y"), turned("Y", "X"))))
    return _measured(counts, thresholds, frequent, totals, pairs, by)


def _measured(counts, thresholds, frequent, totals, pairs, by: list[str]) -> Affinity:
    """Add the metrics to named and counted pairs."""
    matrix = _attach(pairs, totals, by, "total_basket_count")
    matrix = (
        matrix.withColumn("confidence", confidence("basket_count_XY", "basket_count_X"))
        .withColumns(
            {
                "lift": lift("confidence", "basket_count_Y", "total_basket_count"),
                "support": support("basket_count_XY", "total_basket_count"),
            }
        )
        .select(*by, *MATRIX_COLUMNS)
    )
    return Affinity(counts=counts, frequent=frequent, totals=totals, thresholds=thresholds, matrix=matrix)


@dataclasses.dataclass(frozen=True)
class _Groups:
    rows: DataFrame  # by, basket_key, coupon_key, coupon, distinct
    counts: DataFrame
    frequent: DataFrame
    totals: DataFrame
    thresholds: DataFrame
    side: DataFrame  # by, basket_key, coupon_key of the frequent groups


def _groups(rows: DataFrame, t: float, by: list[str], pin: bool) -> _Groups:
    rows = rows.distinct()
    if pin:  # read by the group counts, the total and both sides of the pairs
        rows = materialize(rows, "basket-groups")
    counts = rows.groupBy(*by, "coupon_key", "coupon").agg(F.count(F.lit(1)).alias("basket_count"))
    if pin:  # one row per group: read by the threshold, the pruning and the matrix
        counts = materialize(counts, "group-counts")
    totals = (rows.groupBy(*by) if by else rows).agg(F.count_distinct("basket_key").alias("total_basket_count"))
    thresholds, frequent = _frequent(counts, t, by)
    side = rows.join(frequent.select(*by, "coupon_key"), [*by, "coupon_key"], "left_semi").select(*by, "basket_key", "coupon_key")
    return _Groups(rows, counts, frequent, totals, thresholds, side)


def _half_pairs(rows: DataFrame, t: float, by: list[str], pin: bool, method: str) -> Affinity:
    g = _groups(rows, t, by, pin)
    pairs = block_pairs(g.side, by, pin) if method == "blocks" else _joined_pairs(g.side, by)
    half = pairs.groupBy(*by, "coupon_key_X", "coupon_key_Y").agg(F.count(F.lit(1)).alias("basket_count_XY"))
    return _assemble(g.counts, g.thresholds, g.frequent, g.totals, half, by, mirrored=True)


def held_pair_matrix(held: DataFrame, names: DataFrame, totals: DataFrame, t: float = RARE_GROUP_PERCENTILE, by: Sequence[str] = (), pin: bool = True) -> Affinity:
    """The pair matrix of baskets that are held in blocks already (``pairs_of_blocks``); ``names`` has
    the name of each key.

    The groups are counted from the blocks, and rare ones leave with the join that brings the names
    and counts: they are in few baskets, so it does not pay to deal all rows by group and back by
    basket to take them out before.
    """
    by = list(by)
    counts = held.select(*by, F.explode("held").alias("coupon_key")).groupBy(*by, "coupon_key").agg(F.count(F.lit(1)).alias("basket_count"))
    counts = counts.join(names, ["coupon_key"]).select(*by, "coupon_key", "coupon", "basket_count")
    if pin:  # one row per group: read by the threshold and the matrix
        counts = materialize(counts, "group-counts")
    thresholds, frequent = _frequent(counts, t, by)
    half = pairs_of_blocks(held, by).groupBy(*by, "coupon_key_X", "coupon_key_Y").agg(F.count(F.lit(1)).alias("basket_count_XY"))
    return _assemble(counts, thresholds, frequent, totals, half, by, mirrored=True)


def whole_blocks(baskets: DataFrame, max_groups: int) -> DataFrame:
    """Baskets of ``clicks.hold_baskets`` as blocks: those of at most ``BLOCK_GROUPS`` groups are one
    block; if a basket may have more, its groups are dealt to blocks by their hash."""
    groups = F.array_sort(F.array_distinct("items.coupon_key"))
    if max_groups <= BLOCK_GROUPS:
        return baskets.select("basket_key", F.lit(1).alias("blocks"), F.lit(0).alias("block"), groups.alias("held"))
    blocks = F.ceil(F.size(groups) / BLOCK_GROUPS).cast("int")
    each = baskets.select("basket_key", blocks.alias("blocks"), groups.alias("groups")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    held = F.filter("groups", lambda g: F.pmod(F.xxhash64(F.lit(1), g), F.col("blocks")) == F.col("block"))
    return each.select("basket_key", "blocks", "block", held.alias("held")).where(F.size("held") > 0)


def _dense_counter(min_confidence: float):
    """Counts all pairs between two parts of the groups (or inside one) in all their baskets, block by
    block. All rows of a group are in the task, so its number of baskets and the confidence are known there."""
    import pyarrow as pa

    least, width, step, sent, most = min_confidence, DENSE_GROUPS, _DENSE_BASKETS, _DENSE_SENT, _DENSE_MET
    names = ["coupon_key_X", "coupon_X", "coupon_key_Y", "coupon_Y", "basket_count_X", "basket_count_Y", "basket_count_XY"]

    def count(batches):
        import numpy as np
        import pyarrow as pa

        def runs(start, n):
            """The positions start, start + 1, ... of each run of n."""
            ends = np.cumsum(n)
            return np.repeat(start - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)

        def product(found, x, y, nx, ny):
            """Adds the pairs of baskets that hold many of the groups, as a product of 0/1 matrices."""
            for lo in range(0, len(x[0]), step):

                def side(start, n, place, groups):
                    made = np.zeros((step, groups), np.float32)
                    n = n[lo : lo + step]
                    made[np.repeat(np.arange(len(n)), n), place[runs(start[lo : lo + step], n)]] = 1.0
                    return made

                found += (side(*x, nx).T @ side(*y, ny)).astype(np.int64)  # whole numbers up to ``step``: exact

        def met(found, x, y, ny):
            """Adds the pairs of the other baskets one by one."""
            (xs, nx, px), (ys, n_y, py) = x, y
            row, n, start = runs(xs, nx), np.repeat(n_y, nx), np.repeat(ys, nx)
            done = np.cumsum(n)
            lo = 0
            while lo < len(row):
                hi = max(lo + 1, int(np.searchsorted(done, (done[lo - 1] if lo else 0) + most, "right")))
                cells = np.repeat(px[row[lo:hi]] * ny, n[lo:hi]) + py[runs(start[lo:hi], n[lo:hi])]
                found += np.bincount(cells, minlength=len(found))
                lo = hi

        rows = pa.Table.from_batches(list(batches))
        i, j = rows["i"][0].as_py(), rows["j"][0].as_py()
        lists = rows["baskets"].combine_chunks()
        n = np.diff(lists.offsets.to_numpy())
        keys, first, at = np.unique(rows["coupon_key"].to_numpy(), return_index=True, return_inverse=True)
        named, own = rows["coupon"].combine_chunks().take(pa.array(first)), rows["own"].to_numpy()[first]
        size = np.bincount(at, n, len(keys)).astype(np.int64)  # whole numbers: exact
        # Groups by part and block, and each block's (basket, place of the group), sorted.
        place, block, blocks = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64), []
        for part in (i,) if i == j else (i, j):
            mine = np.flatnonzero(own == part)
            place[mine], block[mine] = np.arange(len(mine)) % width, np.arange(len(mine)) // width + len(blocks)
            blocks += [(part, mine[lo : lo + width]) for lo in range(0, len(mine), width)]
        of, basket = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        at = np.repeat(at, n)
        code = np.unique((block[at] * len(of) + basket) * width + place[at])
        bounds = np.searchsorted(code, np.arange(len(blocks) + 1) * len(of) * width)
        held = []
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            baskets, start, n = np.unique(code[lo:hi] // width, return_index=True, return_counts=True)
            held.append((baskets % len(of), start, n, code[lo:hi] % width))
        for p, (part, xs) in enumerate(blocks):
            for q, (other, ys) in enumerate(blocks):
                if not (q >= p if i == j else (part, other) == (i, j)):
                    continue
                _, a, b = np.intersect1d(held[p][0], held[q][0], assume_unique=True, return_indices=True)
                found = np.zeros(len(xs) * len(ys), np.int64)
                many = held[p][2][a] * held[q][2][b] * 256 > len(found)
                take = lambda k, which: (held[k][1][which], held[k][2][which], held[k][3])
                met(found, take(p, a[~many]), take(q, b[~many]), len(ys))
                if many.any():
                    product(found.reshape(len(xs), len(ys)), take(p, a[many]), take(q, b[many]), len(xs), len(ys))
                if p == q:
                    found[:: len(ys) + 1] = 0  # a group with itself
                low = np.ceil(least * min(size[xs].min(), size[ys].min()) * (1 - 1e-9))
                some = np.flatnonzero(found >= max(1, low))
                n_xy, u = found[some], some // len(ys)
                u, v = xs[u], ys[some - u * len(ys)]
                for x, y in ((u, v),) if p == q else ((u, v), (v, u)):
                    enough = n_xy / size[x] >= least
                    n, x, y = (n_xy, x, y) if enough.all() else (n_xy[enough], x[enough], y[enough])
                    for lo in range(0, len(n), sent):
                        x_, y_ = x[lo : lo + sent], y[lo : lo + sent]
                        columns = [keys[x_], named.take(pa.array(x_)), keys[y_], named.take(pa.array(y_)), size[x_], size[y_], n[lo : lo + sent]]
                        yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

    count.__annotations__ = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return count


def _dense_pairs(g: _Groups, keys: DataFrame | None, min_confidence: float = 0.0, parts: int | None = None) -> Affinity:
    """The pair matrix counted by blocks of groups; ``keys`` limits the groups. A group is sent with its
    baskets as arrays, once to each pair of parts that its own part is in."""
    kept = g.frequent.groupBy("coupon_key").agg(F.sum("basket_count").alias("basket_count"))
    if keys is not None:
        kept = kept.join(keys.select("coupon_key").distinct(), ["coupon_key"], "left_semi")
    parts = parts or _dense_parts(kept)
    piece = F.pmod(F.xxhash64(F.lit(3), "basket_key"), F.ceil(F.col("basket_count") / _DENSE_BASKETS))
    held = g.rows.join(kept, ["coupon_key"]).groupBy("coupon_key", "coupon", piece).agg(F.collect_list("basket_key").alias("baskets"))
    own = F.pmod(F.xxhash64(F.lit(2), "coupon_key"), F.lit(parts)).cast("int")
    sent = held.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    sent = sent.select("baskets", "coupon_key", "coupon", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    key = g.rows.schema["coupon_key"].dataType.simpleString()
    schema = f"coupon_key_X {key}, coupon_X string, coupon_key_Y {key}, coupon_Y string, basket_count_X bigint, basket_count_Y bigint, basket_count_XY bigint"
    # Twice as many tasks as pairs of parts, so that few of them have two.
    pairs = sent.repartition(parts * (parts + 1), "i", "j").groupBy("i", "j").applyInArrow(_dense_counter(min_confidence), schema)
    return _measured(g.counts, g.thresholds, g.frequent, g.totals, pairs, [])


def _dense_parts(kept: DataFrame) -> int:
    """Parts that the groups are dealt to. Every group is sent to all parts, so there are only as many
    as give the cluster's cores work, or as keep a part's rows in bounds."""
    held = kept.agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum("basket_count"), F.lit(0)).alias("rows")).first()
    return max(1, min(-(-held["groups"] // DENSE_GROUPS), _DENSE_PARTS), min(-(-held["rows"] // _DENSE_ROWS), held["groups"]))


def _joined_pairs(side: DataFrame, by: list[str]) -> DataFrame:
    x = side.withColumnRenamed("coupon_key", "coupon_key_X")
    y = side.withColumnRenamed("coupon_key", "coupon_key_Y")
    return x.join(y, [*by, "basket_key"], "inner").where(F.col("coupon_key_X") < F.col("coupon_key_Y"))


def _all_pairs(xs: Column, ys: Column | None = None) -> Column:
    """Every (x, y) of two blocks, or of one with itself once, the smaller first."""
    pair = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    if ys is None:  # sorted
        return F.flatten(F.transform(xs, lambda x, i: F.transform(F.slice(xs, i + 2, F.size(xs)), lambda y: pair(x, y))))
    return F.flatten(F.transform(xs, lambda x: F.transform(ys, lambda y: pair(F.least(x, y), F.greatest(x, y)))))


def block_pairs(side: DataFrame, by: Sequence[str] = (), pin: bool = True, block_groups: int = 0) -> DataFrame:
    """(by, coupon_key_X, coupon_key_Y) of every basket, X < Y, each pair of a basket once.
    side: distinct (by, basket_key, coupon_key)."""
    width = block_groups or BLOCK_GROUPS
    basket = [*by, "basket_key"]
    # The number of blocks is joined to the rows of large baskets only, over salts, so that the
    # rows of one basket are spread before they are dealt to its blocks.
    large = side.groupBy(*basket).agg(F.count(F.lit(1)).alias("groups")).where(F.col("groups") > width)
    sized = large.select(*basket, F.ceil(F.col("groups") / width).cast("int").alias("blocks"), F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    hashed = side.withColumn("salt", F.pmod(F.xxhash64("coupon_key"), F.lit(_SALTS)).cast("int"))
    dealt = hashed.join(sized, [*basket, "salt"], "left")
    block = F.when(F.col("blocks").isNull(), 0).otherwise(F.pmod(F.xxhash64(F.lit(1), "coupon_key"), F.col("blocks"))).cast("int")
    held = dealt.groupBy(*basket, F.coalesce("blocks", F.lit(1)).alias("blocks"), block.alias("block")).agg(F.sort_array(F.collect_list("coupon_key")).alias("held"))
    if pin:  # read for the pairs inside a block and for those between blocks
        held = materialize(held, "basket-blocks")
    return pairs_of_blocks(held, by)


def pairs_of_blocks(held: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The pairs of baskets in blocks. held: by, basket_key, blocks, block, held (sorted distinct keys)."""
    basket = [*by, "basket_key"]
    inside = held.select(*by, F.explode(_all_pairs(F.col("held"))).alias("p"))
    # A block goes to every pair of blocks that it is in: pair (i, j), i < j.
    other = F.explode(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: j != F.col("block"))).alias("other")
    sent = held.where(F.col("blocks") > 1).select(*basket, "block", "held", other)
    ends = [F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")]
    met = sent.groupBy(*basket, *ends).agg(F.collect_list("held").alias("two")).where(F.size("two") == 2)  # a block may be empty
    between = met.select(*by, F.explode(_all_pairs(F.col("two")[0], F.col("two")[1])).alias("p"))
    return inside.unionByName(between).select(*by, F.col("p.x").alias("coupon_key_X"), F.col("p.y").alias("coupon_key_Y"))


def confident_pairs_pushed(
    baskets: DataFrame,
    min_confidence: float,
    kept_keys: DataFrame | None = None,
    t: float = RARE_GROUP_PERCENTILE,
    small_groups: int = 0,
    pin: bool = True,
) -> DataFrame:
    """The rows of the pair matrix with ``confidence >= min_confidence`` (both groups among
    ``kept_keys``, if given), without counting pairs that cannot get there.

    Pairs are counted in the small baskets (up to ``small_groups`` groups). The large baskets, which
    hold the most pairs, can add ``min(large_X, large_Y)`` to a count at most, the baskets among
    them that hold X and those that hold Y. Only pairs that may reach the confidence with that are
    looked up in the large baskets, each from its own two groups; pairs that no small basket holds
    are made there only for groups X which the large baskets alone may carry.
    """
    width = small_groups or BLOCK_GROUPS
    g = _groups(_clean(baskets, []), t, [], pin)
    side = g.side if kept_keys is None else g.side.join(kept_keys.select("coupon_key").distinct(), ["coupon_key"], "left_semi")
    sizes = side.groupBy("basket_key").agg(F.count(F.lit(1)).alias("groups"))
    # Baskets with more pairs than the rows that parts of the groups are sent are counted by those.
    parts = _dense_parts(g.frequent)
    held = sizes.agg(F.sum("groups").alias("rows"), F.sum(F.col("groups").cast("double") * (F.col("groups") - 1) / 2).alias("pairs")).first()
    if held["rows"] and held["pairs"] > held["rows"] * parts:
        matrix = _dense_pairs(g, kept_keys, min_confidence, parts).matrix
        return matrix.where(F.col("confidence") >= min_confidence)
    large = sizes.where(F.col("groups") > width).select("basket_key")
    in_large = side.join(large, ["basket_key"], "left_semi")
    in_small = side.join(large, ["basket_key"], "left_anti")
    if pin:
        in_large = materialize(in_large, "large-baskets")
    per_group = in_large.groupBy("coupon_key").agg(F.count(F.lit(1)).alias("large"))
    groups = side.select("coupon_key").distinct().join(g.frequent, ["coupon_key"]).join(per_group, ["coupon_key"], "left")
    groups = groups.select("coupon_key", "coupon", "basket_count", F.coalesce("large", F.lit(0)).alias("large"))
    if pin:
        groups = materialize(groups, "kept-groups")

    def of(tag: str) -> DataFrame:
        return groups.select(*[F.col(c).alias(f"{c}_{tag}") for c in groups.columns])

    may = lambda known: confidence(known + F.least("large_X", "large_Y"), "basket_count_X") >= min_confidence
    half = block_pairs(in_small, [], pin, width).groupBy("coupon_key_X", "coupon_key_Y").agg(F.count(F.lit(1)).alias("small"))
    both = F.explode(F.array(F.struct("coupon_key_X", "coupon_key_Y"), F.struct(F.col("coupon_key_Y").alias("coupon_key_X"), F.col("coupon_key_X").alias("coupon_key_Y")))).alias("o")
    counted = half.select("small", both).select("o.*", "small").join(of("X"), ["coupon_key_X"]).join(of("Y"), ["coupon_key_Y"])
    counted = counted.where(may(F.col("small")))
    hopeful = counted.select("coupon_key_X", "coupon_key_Y", "small")
    # Groups that the large baskets may carry alone, with the groups they meet there.
    carried = of("X").where(confidence("large_X", "basket_count_X") >= min_confidence)
    x = in_large.withColumnRenamed("coupon_key", "coupon_key_X")
    y = in_large.withColumnRenamed("coupon_key", "coupon_key_Y")
    heavy = x.join(carried.select("coupon_key_X", "basket_count_X", "large_X"), ["coupon_key_X"]).join(y, ["basket_key"]).where(F.col("coupon_key_X") != F.col("coupon_key_Y"))
    heavy = heavy.join(of("Y").select("coupon_key_Y", "large_Y"), ["coupon_key_Y"]).where(may(F.lit(0)))
    heavy = heavy.groupBy("coupon_key_X", "coupon_key_Y").agg(F.count(F.lit(1)).alias("more"))
    light = counted.where(~may(F.lit(0))).select("coupon_key_X", "coupon_key_Y")  # the others are among the heavy ones
    looked = light.join(x, ["coupon_key_X"]).join(y, ["basket_key", "coupon_key_Y"]).groupBy("coupon_key_X", "coupon_key_Y").agg(F.count(F.lit(1)).alias("more"))
    parts = hopeful.select("coupon_key_X", "coupon_key_Y", F.col("small").alias("n")).unionByName(looked.unionByName(heavy).withColumnRenamed("more", "n"))
    full = parts.groupBy("coupon_key_X", "coupon_key_Y").agg(F.sum("n").alias("basket_count_XY"))
    matrix = _assemble(g.counts, g.thresholds, g.frequent, g.totals, full, [], mirrored=False).matrix
    return matrix.where(F.col("confidence") >= min_confidence)


def _pairs_from_join(rows: DataFrame, t: float, by: list[str], pin: bool = True) -> Affinity:
    # The tasks grow in number with the rows, not in what they hold.
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = lambda n: max(least, -(-n // _JOIN_ROWS))
    rows = rows.distinct()
    if pin:  # read by the group counts, the total and both sides of the join
        rows = materialize(rows, "basket-groups")
    counts = rows.groupBy(*by, "coupon_key", "coupon").agg(F.count_distinct("basket_key").alias("basket_count"))
    if pin:  # one row per group: read by the threshold, the pruning and the matrix
        counts = materialize(counts, "group-counts")
    totals = (rows.groupBy(*by) if by else rows).agg(F.count_distinct("basket_key").alias("total_basket_count"))
    thresholds, frequent = _frequent(counts, t, by)
    side = rows.join(frequent.select(*by, "coupon_key"), [*by, "coupon_key"], "left_semi")
    side = side.select(*by, "basket_key", "coupon_key")
    if pin:  # read for its sizes and dealt for the join
        side = materialize(side, "join-side")
    sizes = side.groupBy(*by, "basket_key").agg(F.count(F.lit(1)).alias("g"))
    held = sizes.agg(F.coalesce(F.sum("g"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("g") * (F.col("g") - 1)), F.lit(0)).alias("pairs")).first()
    dealt = side.repartition(tasks(held["rows"]), *by, "basket_key")  # once, for both sides
    x = dealt.withColumnRenamed("coupon_key", "coupon_key_X")
    y = dealt.select(*[F.col(c).alias(f"{c}_Y") for c in by], F.col("basket_key").alias("basket_key_Y"), F.col("coupon_key").alias("coupon_key_Y"))
    cond = [x["basket_key"] == y["basket_key_Y"], x["coupon_key_X"] != y["coupon_key_Y"]]
    cond += [x[c] == y[f"{c}_Y"] for c in by]
    full = (
        x.join(y, cond, "inner")
        .repartition(tasks(held["pairs"]), *by, "coupon_key_X", "coupon_key_Y")
        .groupBy(*by, "coupon_key_X", "coupon_key_Y")
        .agg(F.count_distinct("basket_key").alias("basket_count_XY"))
    )
    return _assemble(counts, thresholds, frequent, totals, full, by, mirrored=False)
