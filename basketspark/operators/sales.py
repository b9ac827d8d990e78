"""Net sales per SKU and per product group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketspark.runtime import materialize


def sku_sales(invoices: DataFrame, products: DataFrame | None, window: tuple[int, int], exclude_discontinued: bool = True) -> DataFrame:
    """(prod_id, sales): net sales of the window per upper-cased SKU.

    With ``exclude_discontinued`` the invoice SKU must exist in ``products`` with a
    non-null code other than 'D' (an inner join; the match is case-sensitive). Amounts are
    summed at the scale of the source, per raw SKU first: the join sees a row per SKU.
    """
    lo, hi = window
    inv = invoices.where((F.col("dt_key") < hi) & (F.col("dt_key") >= lo) & F.col("sku").isNotNull())
    inv = inv.groupBy("sku").agg(F.sum("amt").alias("amt"))
    if exclude_discontinued:
        active = products.where(F.col("stk_type_cd") != "D").select("sku")
        inv = inv.join(active, ["sku"], "inner")
    return inv.groupBy(F.upper("sku").alias("prod_id")).agg(F.sum("amt").alias("sales"))


def restrict_to_viewed(sales: DataFrame, viewed: DataFrame) -> DataFrame:
    """Keep the SKUs that were viewed (a semi join: no columns, no duplicates added)."""
    return sales.join(viewed, ["prod_id"], "left_semi")


def attach_groups(sales: DataFrame, keys: DataFrame, how: str = "left") -> DataFrame:
    """(prod_id, sales, coupon, coupon_key): every group of the SKU; its full sales count in each."""
    return sales.join(keys.select("prod_id", "coupon", "coupon_key"), ["prod_id"], how).withColumn(
        "coupon", F.coalesce("coupon", "prod_id")
    )


def group_sales(grouped_sales: DataFrame) -> DataFrame:
    """(coupon, coupon_key, coupon_sales) for groups with strictly positive sales."""
    return (
        grouped_sales.groupBy("coupon", "coupon_key")
        .agg(F.sum("sales").alias("coupon_sales"))
        .where(F.col("coupon_sales") > 0)
    )


def build_sales(
    sources, window, viewed: DataFrame, keys: DataFrame, exclude_discontinued: bool = True, how: str = "left", pin: bool = True, counts: dict | None = None
):
    """The whole sales step. Returns (per-SKU sales of viewed SKUs, SKU sales with groups, per-group sales).

    With ``pin`` the per-SKU sales (one row per SKU) are written once, so the invoice
    table is scanned and aggregated once although both SKU sides and the group sales use it.
    """
    per_sku = restrict_to_viewed(sku_sales(sources.invoices, sources.products, window, exclude_discontinued), viewed)
    if pin:
        per_sku = materialize(per_sku, "sku-sales", counts)
    grouped = attach_groups(per_sku, keys, how)
    if how == "inner":  # SKUs without a group leave the per-SKU sales too
        per_sku = per_sku.join(keys.select("prod_id"), ["prod_id"], "left_semi")
    return per_sku, grouped, group_sales(grouped)
