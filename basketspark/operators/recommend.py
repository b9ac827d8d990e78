"""From group pairs to ranked SKU recommendations.

confident_pairs -> (expand_to_skus -> rank_top_k)  or  top_k_pruned -> rec_lists
                or  factorise -> write_factorised / read_factorised -> expand
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketspark.config import MIN_CONFIDENCE, TOP_K
from basketspark.functions.columns import cvm_score
from basketspark.runtime import settings, wide

SKU_PAIR_COLUMNS = (
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
    "sku_X",
    "sku_basket_count_X",
    "sku_Y",
    "sku_basket_count_Y",
    "sku_sales_X",
    "sku_sales_Y",
    "cvm_score",
)

# Order of recommendations for one viewed SKU: score, then views, then sales of Y (all descending).
RANK_KEYS = ("cvm_score", "sku_basket_count_Y", "sku_sales_Y")


def _rank_order():
    return [F.desc(c) for c in RANK_KEYS]


def confident_pairs(matrix: DataFrame, group_sales: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Pairs with confidence >= min whose two groups both have positive sales (semi joins)."""
    sold = group_sales.select("coupon_key")
    return (
        matrix.where(F.col("confidence") >= min_confidence)
        .join(sold.withColumnRenamed("coupon_key", "coupon_key_X"), ["coupon_key_X"], "left_semi")
        .join(sold.withColumnRenamed("coupon_key", "coupon_key_Y"), ["coupon_key_Y"], "left_semi")
    )


def sku_basket_counts(baskets: DataFrame) -> DataFrame:
    """(prod_id, coupon_key, sku_basket_count): baskets that viewed the SKU within each group."""
    return baskets.groupBy("prod_id", "coupon_key").agg(F.count_distinct("basket_key").alias("sku_basket_count"))


def held_sku_counts(items: DataFrame) -> DataFrame:
    """``sku_basket_counts`` of baskets' items, which name a SKU and group once a basket."""
    return items.groupBy("prod_id", "coupon_key").agg(F.count(F.lit(1)).alias("sku_basket_count"))


def _sku_side(prod_views: DataFrame, sales: DataFrame, tag: str) -> DataFrame:
    """The SKUs of each group with their basket counts and sales, a row each: what pairs are expanded
    with, so that no expanded row is dealt again to look up its sales."""
    return prod_views.join(sales.select("prod_id", "sales"), ["prod_id"], "left").select(
        F.col("coupon_key").alias(f"coupon_key_{tag}"),
        F.col("prod_id").alias(f"sku_{tag}"),
        F.col("sku_basket_count").alias(f"sku_basket_count_{tag}"),
        F.col("sales").alias(f"sku_sales_{tag}"),
    )


def _with_sku(df: DataFrame, prod_views: DataFrame, sales: DataFrame, tag: str) -> DataFrame:
    """Expand a group side to its SKUs, with their basket counts and sales (0 when absent)."""
    return (
        df.join(_sku_side(prod_views, sales, tag), [f"coupon_key_{tag}"], "left")
        .withColumn(f"sku_basket_count_{tag}", F.coalesce(f"sku_basket_count_{tag}", F.lit(0).cast("bigint")))
        .withColumn(f"sku_sales_{tag}", F.coalesce(f"sku_sales_{tag}", F.lit(0).cast(sales.schema["sales"].dataType)))
    )


def expand_to_skus(pairs: DataFrame, prod_views: DataFrame, sales: DataFrame) -> DataFrame:
    """Every (SKU of X, SKU of Y) of every pair, scored. Grows with (SKUs per group)^2."""
    expanded = _with_sku(_with_sku(pairs, prod_views, sales, "X"), prod_views, sales, "Y")
    return expanded.withColumn("cvm_score", cvm_score("sku_basket_count_Y", "confidence")).select(*SKU_PAIR_COLUMNS)


def rank_top_k(scored: DataFrame, k: int | None = TOP_K, by_range: bool = False) -> DataFrame:
    """``cvm_rank`` = dense rank per ``sku_X``; ties at the cut-off are all kept.

    With a cut-off, Spark plans a partial window group limit before the shuffle, so a
    viewed SKU with many candidates sends at most its top ranks from each task. ``by_range`` deals the
    rows to range partitions of ``sku_X``, in which they can be numbered without another shuffle.
    """
    scored = scored.repartitionByRange("sku_X") if by_range else scored
    w = Window.partitionBy("sku_X").orderBy(*_rank_order())
    ranked = scored.withColumn("cvm_rank", F.dense_rank().over(w))
    if k is not None:
        ranked = ranked.where(F.col("cvm_rank") <= k)
    return ranked.withColumn("cvm_rank", F.col("cvm_rank").cast("bigint"))


def rank_expanded(pairs: DataFrame, prod_views: DataFrame, sales: DataFrame, k: int | None = TOP_K, by_range: bool = False) -> DataFrame:
    """The full expansion, ranked: the naive form of ``top_k_pruned``."""
    return rank_top_k(expand_to_skus(pairs, prod_views, sales), k, by_range)


def top_k_pruned(pairs: DataFrame, prod_views: DataFrame, sales: DataFrame, k: int | None = TOP_K, by_range: bool = False) -> DataFrame:
    """Same rows as ``rank_top_k(expand_to_skus(...), k)`` without the full expansion.

    For a fixed group X the order key of a candidate depends only on (group Y, SKU Y).
    A row in the final top k of a SKU has fewer than k better distinct keys among all of
    that SKU's candidates, hence also within the list of its own group X. So each group
    keeps its top k candidates first; only those are expanded to the SKUs of X and ranked
    again per SKU.
    """
    if k is None:
        return rank_expanded(pairs, prod_views, sales, None, by_range)
    cand = _with_sku(pairs, prod_views, sales, "Y").withColumn("cvm_score", cvm_score("sku_basket_count_Y", "confidence"))
    per_group = Window.partitionBy("coupon_key_X").orderBy(*_rank_order())
    cand = cand.withColumn("_group_rank", F.dense_rank().over(per_group)).where(F.col("_group_rank") <= k).drop("_group_rank")
    expanded = _with_sku(cand, prod_views, sales, "X").select(*SKU_PAIR_COLUMNS)
    return rank_top_k(expanded, k, by_range)


@dataclasses.dataclass(frozen=True)
class Factorised:
    """The ranked SKU pairs as two tables. SKUs that sit in the same groups have the same
    candidates in the same ranks, so the ranks are held once for all of them: the tables grow
    with the groups' candidates and with the SKUs, not with their product."""

    ranks: DataFrame  # class_sku, and all columns of a ranked pair but those of SKU X
    members: DataFrame  # class_sku, coupon_key_X, sku_X, sku_basket_count_X, sku_sales_X

    def expand(self) -> DataFrame:
        """The ranked pairs, as ``rank_expanded`` gives them."""
        rows = self.ranks.join(self.members, ["class_sku", "coupon_key_X"])
        return rows.select(*SKU_PAIR_COLUMNS, "cvm_rank")

    def of_sku(self, sku: str) -> DataFrame:
        """The ranked pairs of one viewed SKU; only its own rows are expanded."""
        return dataclasses.replace(self, members=self.members.where(F.col("sku_X") == sku)).expand()


def factorise(pairs: DataFrame, prod_views: DataFrame, sales: DataFrame, k: int | None = TOP_K) -> Factorised:
    """Ranks for one SKU, the smallest, of each class of SKUs that sit in the same groups.

    A class is told by the number of its groups and two sums of 64-bit hashes of their keys. A
    SKU's groups are those that are X of some pair.
    """
    able = prod_views.join(pairs.select(F.col("coupon_key_X").alias("coupon_key")).distinct(), ["coupon_key"], "left_semi")
    digest = lambda seed: F.expr(f"bit_xor(xxhash64({seed}, coupon_key))")
    per_sku = able.groupBy("prod_id").agg(F.count(F.lit(1)).alias("n"), digest(1).alias("h1"), digest(2).alias("h2"))
    classes = per_sku.groupBy("n", "h1", "h2").agg(F.min("prod_id").alias("class_sku"))
    named = per_sku.join(classes, ["n", "h1", "h2"]).select("prod_id", "class_sku")
    of_class = able.join(classes.select(F.col("class_sku").alias("prod_id")), ["prod_id"], "left_semi")
    cand = _with_sku(pairs, prod_views, sales, "Y").withColumn("cvm_score", cvm_score("sku_basket_count_Y", "confidence"))
    side = of_class.select(F.col("coupon_key").alias("coupon_key_X"), F.col("prod_id").alias("sku_X"))
    ranked = rank_top_k(cand.join(side, ["coupon_key_X"]), k)
    own = [c for c in SKU_PAIR_COLUMNS if c not in ("sku_X", "sku_basket_count_X", "sku_sales_X")]
    members = able.join(named, ["prod_id"]).join(sales.select("prod_id", F.col("sales").alias("sku_sales_X")), ["prod_id"], "left")
    zero = F.lit(0).cast(sales.schema["sales"].dataType)
    return Factorised(
        ranks=ranked.select(F.col("sku_X").alias("class_sku"), *own, "cvm_rank"),
        members=members.select(
            "class_sku", F.col("coupon_key").alias("coupon_key_X"), F.col("prod_id").alias("sku_X"),
            F.col("sku_basket_count").alias("sku_basket_count_X"), F.coalesce("sku_sales_X", zero).alias("sku_sales_X"),
        ),
    )


def write_factorised(found: Factorised, path: str) -> None:
    spark = found.ranks.sparkSession
    with settings(spark, wide(spark)):
        found.ranks.write.parquet(f"{path}/ranks")
        found.members.write.parquet(f"{path}/members")


def read_factorised(spark: SparkSession, path: str) -> Factorised:
    return Factorised(spark.read.parquet(f"{path}/ranks"), spark.read.parquet(f"{path}/members"))


def rec_lists(ranked: DataFrame) -> DataFrame:
    """(sku_X, recs): recommended SKUs joined by '|', in rank order then SKU."""
    ordered = F.array_sort(F.collect_list(F.struct("cvm_rank", "sku_Y")))
    return ranked.groupBy("sku_X").agg(F.array_join(F.transform(ordered, lambda s: s["sku_Y"]), "|").alias("recs"))
