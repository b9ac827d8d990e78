"""Distributed global numbering (row_number / dense_rank without a single partition).

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one task. Here the rows
are range-partitioned on the order, sorted inside each partition and numbered locally;
the offset of each partition is the sum of the sizes of the partitions before it, a window
over one count per partition (bounded by the partition count, not by the data). The ranged rows are written once to the shared checkpoint folder, so partition
ids and local positions are pinned before they are read twice. The order should split
(distinct keys, or tie-breakers): rows with one equal key all land in one range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketspark.runtime import materialize

_PID = "_bs_pid"
_POS = "_bs_pos"
_OFF = "_bs_off"


def _sort_col(c: Column | str) -> Column:
    return F.col(c).asc() if isinstance(c, str) else c


def _by_range(df: DataFrame, keys: list[Column], num_partitions: int | None) -> DataFrame:
    """Range partitions in key order. Without an explicit count AQE sizes them: it only
    merges neighbouring ranges, so partition ids stay in key order."""
    return df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)


def global_index(
    df: DataFrame,
    order: Sequence[Column | str],
    name: str = "idx",
    partition_by: Sequence[str] = (),
    num_partitions: int | None = None,
    counts: dict | None = None,
    keep: Sequence[str] | None = None,
    ranged: bool = False,
) -> DataFrame:
    """Add ``name``: the 1-based position of each row in ``order`` (within ``partition_by``).

    Equal to ``row_number() over (partition by ... order by ...)`` when the order is total;
    on distinct keys it is ``dense_rank``. With ``keep`` only these columns and ``partition_by`` remain;
    the others serve the order and are not written. ``ranged`` rows are in range partitions of the
    first columns of ``order`` already.
    """
    keys = [F.col(c).asc() for c in partition_by] + [_sort_col(c) for c in order]
    pid = F.spark_partition_id()
    dealt = (
        (df if ranged else _by_range(df, keys, num_partitions))
        .sortWithinPartitions(*keys)
        .withColumns({_PID: pid, _POS: F.monotonically_increasing_id() - pid.cast("long") * F.lit(1 << 33)})
    )
    if keep is not None:
        dealt = dealt.select(*partition_by, *keep, _PID, _POS)
    # Pin partition ids and local positions: written once, then read twice.
    dealt = materialize(dealt, "index", counts)

    # Rows of one group are contiguous inside a partition (the sort starts with the group),
    # so a row's position in its group is its local position minus the group's first one
    # in that partition, plus the sizes of the group in earlier partitions: a window over
    # one row per partition (and group).
    sizes = dealt.groupBy(_PID, *partition_by).agg(F.count(F.lit(1)).alias("_n"), F.min(_POS).alias("_first"))
    before = Window.partitionBy(*partition_by).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")
    offsets = sizes.select(_PID, *partition_by, offset.alias(_OFF))
    if not partition_by:  # one row per partition: without the hint the rows are dealt before that is known
        offsets = F.broadcast(offsets)
    return (
        dealt.join(offsets, [_PID, *partition_by], "inner")
        .withColumn(name, F.col(_OFF) + F.col(_POS) + F.lit(1))
        .drop(_PID, _POS, _OFF)
    )


def global_cumsum(
    df: DataFrame, order: Sequence[Column | str], weight: str, name: str = "cum", num_partitions: int | None = None
) -> DataFrame:
    """Add ``name``: the running sum of ``weight`` over the whole frame in ``order`` (inclusive).

    Range partitions on the order, a running sum inside each range partition (a window on
    the partition id: one range partition per task, balanced by the range bounds), and the
    totals of earlier partitions as offsets (a window over one row per partition).
    Meant for distinct keys, e.g. (value, count) pairs; repeated keys would all sit in one
    range partition.
    """
    keys = [_sort_col(c) for c in order]
    ranged = _by_range(df, keys, num_partitions).withColumn(_PID, F.spark_partition_id())
    running = Window.partitionBy(_PID).orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranged = materialize(ranged.withColumn("_bs_local", F.sum(weight).over(running)), "cumsum")
    totals = ranged.groupBy(_PID).agg(F.sum(weight).alias("_t"))
    earlier = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = totals.select(_PID, F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias(_OFF))
    return (
        ranged.join(F.broadcast(offsets), [_PID], "inner")
        .withColumn(name, F.col(_OFF) + F.col("_bs_local"))
        .drop(_PID, _OFF, "_bs_local")
    )


def dense_rank_keys(df: DataFrame, key: str, name: str) -> DataFrame:
    """Distinct values of ``key`` with their dense rank (ascending) in column ``name``."""
    return global_index(df.select(key).distinct(), [key], name=name)
