"""The five source relations derived from the TPC-H-like test tables.

Definitions are in FIXTURES.md and are mirrored in SQL by ``basketspark.plans.oracle``.
Every lineitem row is one web hit of the visit of its order; the order's line status
splits a visit into two return counts. Edge cases of the original sources come from
attributes, never from key ranges:

* visit sessions are missing for urgent orders in status P on the second return count
  (hits without a session, a left-join null);
* low-priority orders in status P are merged into one session per order month
  (scraper-like sessions with more than 30 groups);
* hits of the 7th line carry ``shipping-handling`` (whole hit dropped);
* hits without discount have no account (``NOACCT``, no pipe);
* parts above size 10 get a lower-case SKU in group ``G<partkey div 50>``; promo parts of
  Brand#1 also sit in the next group; size 3 maps to group ``T`` and size 4 to null;
* products of size 50 are discontinued, size 49 has a null code;
* invoices of returned lines 1 to 5 are credits of three times the price.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketspark.functions.columns import day_key_of
from basketspark.sources.readers import Sources

TABLES = ("lineitem", "orders", "part")


def read_testdata(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def hits_view(lineitem: DataFrame) -> DataFrame:
    partner = (F.col("l_partkey") + 50).cast("string")
    return lineitem.select(
        F.when(F.col("l_linestatus") == "O", F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("visit_return_count"),
        F.concat(F.lit("V"), F.col("l_orderkey").cast("string")).alias("post_visid_combined"),
        F.col("l_shipdate").alias("time_stamp"),
        day_key_of("l_shipdate").alias("dt_key"),
        F.when(
            F.col("l_linenumber") == 7,
            F.concat(F.lit("P"), F.col("l_partkey").cast("string"), F.lit(",shipping-handling")),
        )
        .otherwise(F.concat(F.lit(" p"), F.col("l_partkey").cast("string"), F.lit(" ,P"), partner, F.lit(", ,")))
        .alias("prod_list"),
        F.when(F.col("l_discount") == 0, F.lit("NOACCT"))
        .otherwise(F.concat(F.lit(" A"), F.col("l_suppkey").cast("string"), F.lit(" |x|y")))
        .alias("demandbase"),
    )


def visit_sessions_view(orders: DataFrame) -> DataFrame:
    merged = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    missing = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")

    def one(rc: int) -> DataFrame:
        rows = orders if rc == 0 else orders.where(~missing)
        key = F.when(
            merged, -(F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("bigint")
        ).otherwise(F.col("o_orderkey") * 2 + rc)
        return rows.select(
            F.lit(rc).cast("bigint").alias("visit_return_count"),
            F.concat(F.lit("V"), F.col("o_orderkey").cast("string")).alias("post_visid_combined"),
            key.alias("visit_session_key"),
        )

    return one(0).unionByName(one(1))


def prod_feature_view(part: DataFrame) -> DataFrame:
    grp = F.floor(F.col("p_partkey") / 50).cast("bigint")
    key = F.col("p_partkey").cast("string")
    big = part.where(F.col("p_size") > 10)
    return (
        big.select(F.concat(F.lit("p"), key).alias("sku_nbr"), F.concat(F.lit("G"), grp.cast("string")).alias("size_grp"))
        .unionByName(
            big.where((F.col("p_type") == "PROMO") & (F.col("p_brand") == "Brand#1")).select(
                F.concat(F.lit("P"), key).alias("sku_nbr"), F.concat(F.lit("G"), (grp + 1).cast("string")).alias("size_grp")
            )
        )
        .unionByName(part.where(F.col("p_size") == 3).select(F.concat(F.lit("P"), key).alias("sku_nbr"), F.lit("T").alias("size_grp")))
        .unionByName(
            part.where(F.col("p_size") == 4).select(
                F.concat(F.lit("P"), key).alias("sku_nbr"), F.lit(None).cast("string").alias("size_grp")
            )
        )
    )


def products_view(part: DataFrame) -> DataFrame:
    return part.select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("sku"),
        F.when(F.col("p_size") == 50, F.lit("D"))
        .when(F.col("p_size") == 49, F.lit(None).cast("string"))
        .otherwise(F.lit("S"))
        .alias("stk_type_cd"),
    )


def invoices_view(lineitem: DataFrame) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    credit = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") <= 5)
    return lineitem.select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("sku"),
        day_key_of("l_shipdate").alias("dt_key"),
        F.when(credit, (price * F.lit(-3)).cast("decimal(18,2)")).otherwise(price).alias("amt"),
    )


def of_days(lineitem: DataFrame, window: tuple[int, int]) -> DataFrame:
    """The window as bounds on the stored date, which reach the scan (the day key of the views
    is computed above it)."""
    day = lambda key: F.to_date(F.lit(str(key)), "yyyyMMdd").cast("timestamp_ntz")
    return lineitem.where((F.col("l_shipdate") >= day(window[0])) & (F.col("l_shipdate") < day(window[1])))


def fixture_sources(spark: SparkSession, sf_dir: str, window: tuple[int, int] | None = None) -> Sources:
    """The views; with ``window`` only its days are read of the lines."""
    lineitem = read_testdata(spark, sf_dir, "lineitem")
    if window:
        lineitem = of_days(lineitem, window)
    orders = read_testdata(spark, sf_dir, "orders")
    part = read_testdata(spark, sf_dir, "part")
    return Sources(
        hits=hits_view(lineitem),
        visit_sessions=visit_sessions_view(orders),
        products=products_view(part),
        prod_feature=prod_feature_view(part),
        invoices=invoices_view(lineitem),
    )


# Window used by every fixture query: 2190 days before 2001-01-01, i.e. [19950103, 20010101).
FIXTURE_START_DATE = "20010101"
FIXTURE_PERIOD_DAYS = -2190
