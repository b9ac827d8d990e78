"""A sliding window kept up to date: days are added and retired instead of the whole window being
worked out again.

* The daily table holds one row per (day, session, SKU, group) of the cleaned clicks, stored by
  day; a window reads the folders of its days only.
* A window's state is the number of baskets, the baskets of each group and the baskets of each
  pair of groups, before any pruning. To move the window, only the sessions with a click on an
  added or retired day are looked at: their pairs in the old window count -1, those in the new
  window +1, and the signed counts are summed into the state. Sessions that stay as they are, most
  of them, are not read.
* Pruning and the pair statistics are worked out from the state, so any percentile may be asked of
  it. The result equals that of the whole window.

A session's basket may become too large or too small by a day, and come back by another; signs
take care of that, too. Rows with a null session never make a basket. A state is three tables of
the run that wrote it; nothing is changed in place, so a run that fails leaves the earlier state.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketspark.config import MAX_GROUPS_PER_BASKET, RARE_GROUP_PERCENTILE
from basketspark.functions.columns import confidence, lift, support
from basketspark.operators.affinity import pairs_of_blocks, whole_blocks
from basketspark.operators.clicks import assign_groups, discontinued_skus, explode_products, hold_baskets, read_group_map
from basketspark.runtime import discard_but, materialize, recorded_scratch, scratch_path

#: Columns of the daily table, besides its day.
DAILY = ("session_key", "prod_id", "coupon")
STATE_MATRIX_COLUMNS = ("coupon_X", "coupon_Y", "basket_count_X", "basket_count_Y", "basket_count_XY", "confidence", "lift", "support")


@dataclasses.dataclass(frozen=True)
class WindowState:
    window: tuple[int, int]  # day keys, half-open
    totals: DataFrame  # n: baskets
    groups: DataFrame  # coupon, n: baskets
    pairs: DataFrame  # coupon_X, coupon_Y (X < Y), n: baskets


def daily_clicks(pulled: DataFrame, products: DataFrame, prod_feature: DataFrame) -> DataFrame:
    """(dt_key, session_key, prod_id, coupon) of pulled hits with their day, distinct."""
    each = explode_products(pulled, dedupe=False, keep=("dt_key",)).where(F.col("session_key").isNotNull())
    active = each.join(discontinued_skus(products), ["prod_id"], "left_anti")
    return assign_groups(active, read_group_map(prod_feature)).select("dt_key", *DAILY).distinct()


def write_days(daily: DataFrame, path: str) -> None:
    """Store days by day. A day that is written again replaces what it had. Rows are dealt by day,
    and adaptive execution splits a day that is too large for one task."""
    dealt = daily.hint("rebalance", "dt_key")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt_key").parquet(path)


def read_days(spark: SparkSession, path: str, window: tuple[int, int]) -> DataFrame:
    """The days of a window; its bounds are partition filters, other folders aren't opened."""
    lo, hi = window
    return spark.read.parquet(path).where((F.col("dt_key") >= lo) & (F.col("dt_key") < hi))


def _baskets(rows: DataFrame, max_groups: int) -> DataFrame:
    """(basket_key, blocks, block, held) of the sessions that make a basket: its groups, held in blocks.
    A session's rows are dealt once."""
    clicks = rows.where(F.col("session_key").isNotNull()).select("session_key", "prod_id", F.col("coupon").alias("coupon_key"), F.lit(1).cast("bigint").alias("n"))
    return whole_blocks(hold_baskets(clicks, max_groups), max_groups)


def _counts(baskets: DataFrame, sign: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signed numbers of baskets: in all, by group and by pair."""
    n = F.sum(sign).alias("n")
    totals = baskets.select("basket_key", sign).distinct().agg(F.coalesce(n, F.lit(0)).alias("n"))
    groups = baskets.select(sign, F.explode("held").alias("coupon")).groupBy("coupon").agg(n)
    pairs = pairs_of_blocks(baskets, [sign]).groupBy(F.col("coupon_key_X").alias("coupon_X"), F.col("coupon_key_Y").alias("coupon_Y")).agg(n)
    return totals, groups, pairs


def build_state(daily: DataFrame, window: tuple[int, int], max_groups: int = MAX_GROUPS_PER_BASKET) -> WindowState:
    """The state of a whole window. ``daily`` may hold more days."""
    lo, hi = window
    rows = daily.where((F.col("dt_key") >= lo) & (F.col("dt_key") < hi))
    with recorded_scratch() as written:
        baskets = materialize(_baskets(rows, max_groups).withColumn("sign", F.lit(1)), "window-baskets")
        return _only(written, _written(window, *_counts(baskets, "sign")))


def _only(written: list[str], state: WindowState) -> WindowState:
    """The state, with what led to it deleted."""
    discard_but(state.pairs.sparkSession, written, state.totals, state.groups, state.pairs)
    return state


def _written(window: tuple[int, int], totals: DataFrame, groups: DataFrame, pairs: DataFrame) -> WindowState:
    some = lambda df, name: materialize(df.where("n != 0"), name)
    return WindowState(window, materialize(totals, "window-total"), some(groups, "window-groups"), some(pairs, "window-pairs"))


def changed_days(old: tuple[int, int], new: tuple[int, int]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(spans of days that the new window adds, spans that it retires)."""

    def left(a: tuple[int, int], b: tuple[int, int]) -> list[tuple[int, int]]:
        if b[0] >= a[1] or b[1] <= a[0]:
            return [a]
        return [s for s in ((a[0], b[0]), (b[1], a[1])) if s[0] < s[1]]

    return left(new, old), left(old, new)


def move_state(state: WindowState, daily: DataFrame, window: tuple[int, int], max_groups: int = MAX_GROUPS_PER_BASKET) -> WindowState:
    """The state of another window from that of an earlier one; ``daily`` holds the days of both."""
    added, retired = changed_days(state.window, window)
    if not added and not retired:
        return state
    day = F.col("dt_key")
    inside = lambda s: (day >= s[0]) & (day < s[1])
    spans = [inside(s) for s in (*added, *retired)]
    changed = spans[0]
    for s in spans[1:]:
        changed = changed | s

    def summed(old: DataFrame, delta: DataFrame, *keys: str) -> DataFrame:
        both = old.select(*keys, "n").unionByName(delta.select(*keys, "n"))
        return (both.groupBy(*keys) if keys else both).agg(F.sum("n").alias("n"))

    with recorded_scratch() as written:
        touched = materialize(daily.where(changed).select("session_key").distinct(), "touched-sessions")
        either = inside(state.window) | inside(window)
        rows = materialize(daily.where(either).join(touched, ["session_key"], "left_semi"), "touched-clicks")
        before = _baskets(rows.where(inside(state.window)), max_groups).withColumn("sign", F.lit(-1))
        after = _baskets(rows.where(inside(window)), max_groups).withColumn("sign", F.lit(1))
        # A group that a session had before and has again is in both; its signs cancel in the sums.
        baskets = materialize(before.unionByName(after), "moved-baskets")
        totals, groups, pairs = _counts(baskets, "sign")
        return _only(written, _written(window, summed(state.totals, totals), summed(state.groups, groups, "coupon"), summed(state.pairs, pairs, "coupon_X", "coupon_Y")))


def state_matrix(state: WindowState, t: float = RARE_GROUP_PERCENTILE) -> DataFrame:
    """The pair statistics of the window, of the groups above the percentile, in both directions."""
    limit = state.groups.agg(F.greatest(F.percentile("n", F.lit(t / 100.0)), F.lit(1.0)).alias("limit")).scalar()
    frequent = state.groups.where(F.col("n") > limit)
    of = lambda tag: frequent.select(F.col("coupon").alias(f"coupon_{tag}"), F.col("n").alias(f"basket_count_{tag}"))
    half = state.pairs.select("coupon_X", "coupon_Y", F.col("n").alias("basket_count_XY")).join(of("X"), ["coupon_X"]).join(of("Y"), ["coupon_Y"])
    # Both directions once the counts are there: half as many rows are dealt for them.
    turned = lambda a, b: F.struct(*[F.col(f"{c}_{t}").alias(f"{c}_{u}") for t, u in ((a, "X"), (b, "Y")) for c in ("coupon", "basket_count")])
    met = half.select("basket_count_XY", F.inline(F.array(turned("X", "Y"), turned("Y", "X"))))
    total = state.totals.select("n").scalar()
    known = met.withColumn("confidence", confidence("basket_count_XY", "basket_count_X"))
    known = known.withColumns({"lift": lift("confidence", "basket_count_Y", total), "support": support("basket_count_XY", total)})
    return known.select(*STATE_MATRIX_COLUMNS)


def store_days(spark: SparkSession, daily: DataFrame, path: str | None = None) -> str:
    """Write the daily table (below the checkpoint root, if no path is given); returns its path."""
    path = path or scratch_path(spark, "daily-clicks")
    write_days(daily, path)
    return path
