"""Click history: raw hits to basket rows.

pull_hits -> explode_products -> drop_discontinued -> assign_groups -> group_keys /
attach_group_keys -> session_stats -> keep_sessions -> to_baskets
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketspark.config import MAX_GROUPS_PER_BASKET
from basketspark.functions.columns import account_no, normalised_list, trimmed
from basketspark.operators.indexing import dense_rank_keys
from basketspark.runtime import discard_but, materialize, recorded_scratch

CLICK_COLUMNS = ("session_key", "visit_id", "visit_number", "time_stamp", "account_no", "prod_id")


def pull_hits(hits: DataFrame, visit_sessions: DataFrame, window: tuple[int, int], keep: tuple[str, ...] = ()) -> DataFrame:
    """Hits of the window with their session, normalised list and account number.

    Filters bind to the raw columns, so they reach the scan. A hit whose raw list has
    the lower-case ``shipping-handling`` marker is dropped whole. The session is a left
    join: hits without a session keep a null ``session_key``. ``keep`` names further columns of
    the hits to carry along.
    """
    lo, hi = window
    acct = account_no("demandbase")
    h = hits.where(
        (F.col("dt_key") < hi)
        & (F.col("dt_key") >= lo)
        & F.col("post_visid_combined").isNotNull()
        & F.col("prod_list").isNotNull()
        & ~F.col("prod_list").contains("shipping-handling")
        & (acct != "")
    ).select(
        "visit_return_count",
        "post_visid_combined",
        normalised_list("prod_list").alias("prod_list"),
        "time_stamp",
        acct.alias("account_no"),
        *keep,
    )
    vs = visit_sessions.select("visit_return_count", "post_visid_combined", F.col("visit_session_key").alias("session_key"))
    # The visitor first: a sort looks at the first key's start before it compares rows.
    return h.join(vs, ["post_visid_combined", "visit_return_count"], "left").select(
        "session_key",
        F.col("post_visid_combined").alias("visit_id"),
        F.col("visit_return_count").alias("visit_number"),
        "prod_list",
        "time_stamp",
        "account_no",
        *keep,
    )


def explode_products(pulled: DataFrame, dedupe: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per product of the comma list, trimmed, empties dropped, rows de-duplicated."""
    rows = (
        pulled.select(
            "session_key",
            "visit_id",
            "visit_number",
            "time_stamp",
            "account_no",
            *keep,
            F.explode(F.split("prod_list", ",")).alias("prod_id"),
        )
        .withColumn("prod_id", trimmed("prod_id"))
        .where(F.col("prod_id").isNotNull() & (F.col("prod_id") != ""))
    )
    return rows.distinct() if dedupe else rows


def parse_hits(hits: DataFrame, visit_sessions: DataFrame, window: tuple[int, int]) -> DataFrame:
    return explode_products(pull_hits(hits, visit_sessions, window))


def discontinued_skus(products: DataFrame) -> DataFrame:
    return products.where(F.col("stk_type_cd") == "D").select(F.col("sku").alias("prod_id"))


def drop_discontinued(clicks: DataFrame, products: DataFrame) -> DataFrame:
    """Anti join on the discontinued SKUs (exact, case-sensitive match)."""
    return clicks.join(discontinued_skus(products), ["prod_id"], "left_anti")


def read_group_map(prod_feature: DataFrame) -> DataFrame:
    """(prod_id, coupon): upper-cased SKU to its product groups; null and 'T' groups dropped."""
    return (
        prod_feature.where(F.col("size_grp").isNotNull() & (F.col("size_grp") != "T"))
        .select(F.upper("sku_nbr").alias("prod_id"), F.col("size_grp").alias("coupon"))
        .distinct()
    )


def assign_groups(clicks: DataFrame, group_map: DataFrame) -> DataFrame:
    """Attach every group of the SKU (a SKU in two groups gives two rows); default = the SKU.

    The map is one row per (SKU, group); Spark broadcasts it when its measured size is
    under the broadcast threshold and shuffles otherwise.
    """
    return clicks.join(group_map, ["prod_id"], "left").withColumn("coupon", F.coalesce("coupon", "prod_id"))


def viewed_skus(grouped: DataFrame) -> DataFrame:
    return grouped.select("prod_id").distinct()


def group_keys(group_map: DataFrame, grouped: DataFrame) -> DataFrame:
    """(prod_id, coupon, coupon_key): all mapped and all viewed pairs; dense key by coupon.

    Groups that are mapped but never viewed still take a key. The dense rank is computed
    by the distributed numbering, not by a window over one partition.
    """
    pairs = (
        group_map.select("prod_id", "coupon")
        .unionByName(grouped.select("prod_id", "coupon"))
        .where(F.col("prod_id").isNotNull())
        .distinct()
    )
    keys = dense_rank_keys(pairs, "coupon", "coupon_key")
    return pairs.join(keys, ["coupon"], "inner").select("prod_id", "coupon", "coupon_key")


def attach_group_keys(grouped: DataFrame, keys: DataFrame) -> DataFrame:
    """The integer key of each click's group (the key is a function of the group)."""
    per_group = keys.select("coupon", "coupon_key").distinct()
    return grouped.join(per_group, ["coupon"], "left")


def session_stats(clicks: DataFrame) -> DataFrame:
    """Distinct SKUs and distinct groups per session, in one aggregation."""
    return clicks.groupBy("session_key").agg(
        F.count_distinct("prod_id").alias("prod_count"),
        F.count_distinct("coupon").alias("coupon_count"),
    )


def keep_sessions(stats: DataFrame, max_groups: int = MAX_GROUPS_PER_BASKET) -> DataFrame:
    """Sessions with 2..max_groups distinct groups and at least 2 distinct SKUs."""
    return stats.where((F.col("coupon_count") <= max_groups) & (F.col("coupon_count") > 1) & (F.col("prod_count") > 1))


def to_baskets(clicks: DataFrame, kept: DataFrame) -> DataFrame:
    """Clicks of kept sessions; the session becomes the basket. Null sessions never match."""
    return clicks.join(kept, ["session_key"], "inner").withColumnRenamed("session_key", "basket_key")


def build_clicks(sources, window: tuple[int, int], max_groups: int = MAX_GROUPS_PER_BASKET, pin: bool = True, counts: dict | None = None):
    """The whole click step. Returns (baskets, viewed SKUs, group keys, keyed clicks, group map).

    With ``pin`` the grouped clicks are written once to the shared checkpoint folder (the
    group numbering, the session statistics and the baskets read them instead of parsing
    the hits again), and so are the baskets (the session statistics run once); ``counts`` then
    takes the rows of the clicks and the baskets, counted as they are written.
    """
    parsed = parse_hits(sources.hits, sources.visit_sessions, window)
    active = drop_discontinued(parsed, sources.products)
    gmap = read_group_map(sources.prod_feature)
    grouped = assign_groups(active, gmap)
    if pin:
        grouped = materialize(grouped, "clicks", counts)
    keys = group_keys(gmap, grouped)
    if pin:  # one row per (SKU, group): read by the clicks and by the sales
        keys = materialize(keys, "group-keys")
    keyed = attach_group_keys(grouped, keys)
    seen = keyed.where(F.col("session_key").isNotNull())  # no session, no basket
    baskets = to_baskets(seen, keep_sessions(session_stats(seen), max_groups))
    if pin:  # read by the pair matrix, the SKU counts and the permutation test
        baskets = materialize(baskets, "baskets", counts)
    return baskets, viewed_skus(grouped), keys, keyed, gmap


@dataclasses.dataclass(frozen=True)
class HeldBaskets:
    """The baskets as one row each, and what the job needs beside them. A basket's click rows are
    its items, each as often as it says; what only tells one click from another is left out."""

    baskets: DataFrame  # basket_key, prod_count, coupon_count, clicks, items: [(prod_id, coupon_key, n)]
    viewed: DataFrame  # prod_id
    keys: DataFrame  # prod_id, coupon, coupon_key
    group_map: DataFrame

    @property
    def names(self) -> DataFrame:
        return self.keys.select("coupon_key", "coupon").distinct()

    def items(self) -> DataFrame:
        """(basket_key, prod_id, coupon_key, n), one row per SKU and group of a basket."""
        return self.baskets.select("basket_key", F.inline("items"))

    def rows(self) -> DataFrame:
        """(basket_key, prod_id, coupon_key, coupon), one row per SKU and group of a basket."""
        return self.items().drop("n").join(self.names, ["coupon_key"])


def visit_skus(hits: DataFrame, visit_sessions: DataFrame, window: tuple[int, int]) -> DataFrame:
    """(session_key, prod_id, n): the parsed clicks of a visit on a SKU, counted. Both steps keep the
    keys of the join with the sessions, so that a shuffled join's partitions serve them."""
    parsed = parse_hits(hits, visit_sessions, window)
    counted = parsed.groupBy("visit_id", "visit_number", "session_key", "prod_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("session_key", "prod_id", "n")


def hold_baskets(clicks: DataFrame, max_groups: int = MAX_GROUPS_PER_BASKET) -> DataFrame:
    """The baskets of (session_key, prod_id, coupon_key, n) rows, one row each.

    A session's rows are dealt once and sorted once: its groups are counted and its items collected
    in that order. Of sessions with more groups than a basket may have, each task sends the rows of
    the first ``max_groups + 1`` only, enough to tell that they are too many.
    """
    in_session = Window.partitionBy("session_key").orderBy("coupon_key")
    few = clicks.withColumn("_g", F.dense_rank().over(in_session)).where(F.col("_g") <= max_groups + 1)
    # Rows of scrapers go before they are collected: their last group is one too many.
    last = F.max("_g").over(in_session.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    counted = few.withColumn("coupon_count", last).where(F.col("coupon_count").between(2, max_groups))
    held = counted.groupBy("session_key").agg(
        F.max("coupon_count").cast("bigint").alias("coupon_count"),
        F.sort_array(F.collect_list(F.struct("prod_id", "coupon_key", "n"))).alias("items"),
    )
    held = held.withColumn("items", _merged(F.col("items")))
    skus = F.size(F.array_distinct("items.prod_id")).cast("bigint")
    clicks_in = F.aggregate("items.n", F.lit(0).cast("bigint"), lambda total, n: total + n)
    named = held.select(F.col("session_key").alias("basket_key"), skus.alias("prod_count"), "coupon_count", clicks_in.alias("clicks"), "items")
    return named.where(F.col("prod_count") > 1)


def _merged(items: Column) -> Column:
    """Sorted items with those of one SKU and group (a session of several visits has them) as one."""
    which = lambda x: F.struct(x["prod_id"].alias("prod_id"), x["coupon_key"].alias("coupon_key"))
    several = F.array_distinct(F.transform(items, which))

    def summed(one):
        same = F.filter(items, lambda x: which(x) == one)
        return F.struct(one["prod_id"].alias("prod_id"), one["coupon_key"].alias("coupon_key"), F.aggregate(same, F.lit(0).cast("bigint"), lambda n, x: n + x["n"]).alias("n"))

    return F.when(F.size(several) == F.size(items), items).otherwise(F.transform(several, summed))


def build_baskets(sources, window: tuple[int, int], max_groups: int = MAX_GROUPS_PER_BASKET, pin: bool = True, counts: dict | None = None) -> HeldBaskets:
    """The click step for the job: the same sessions and groups as ``build_clicks``, with a SKU's
    clicks in a session as one row. The keys are made for the viewed SKUs, not for each click, and
    reach the clicks with the groups by one join, with which the clicks on discontinued SKUs leave.
    ``counts`` takes the click rows of the baskets."""
    with recorded_scratch() as written:
        held = _build_baskets(sources, window, max_groups, pin, counts)
    if pin:  # the clicks have served
        discard_but(held.baskets.sparkSession, written, held.baskets, held.viewed, held.keys)
    return held


def _build_baskets(sources, window: tuple[int, int], max_groups: int, pin: bool, counts: dict | None) -> HeldBaskets:
    seen = visit_skus(sources.hits, sources.visit_sessions, window)
    if pin:
        seen = materialize(seen, "clicks")
    viewed = drop_discontinued(seen.select("prod_id").distinct(), sources.products)
    if pin:
        viewed = materialize(viewed, "viewed")
    gmap = read_group_map(sources.prod_feature)
    keys = group_keys(gmap, assign_groups(viewed, gmap))
    if pin:  # one row per (SKU, group): read by the clicks and by the sales
        keys = materialize(keys, "group-keys")
    of_viewed = keys.drop("coupon").join(viewed, ["prod_id"], "left_semi")  # the map names others, too
    keyed = seen.where(F.col("session_key").isNotNull()).join(of_viewed, ["prod_id"])
    baskets = hold_baskets(keyed, max_groups)
    if pin:  # read by the pair matrix, the SKU counts and the permutation test
        # Its rows come sorted by session: they are collected in that order, not sorted once more.
        baskets = materialize(baskets, "baskets", counts, F.coalesce(F.sum("clicks"), F.lit(0)), {"spark.sql.execution.replaceHashWithSortAgg": "true"})
    return HeldBaskets(baskets, viewed, keys, gmap)
