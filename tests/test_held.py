"""Baskets held as one row each, pairs named before they are mirrored, permutations on counted rows."""

import re
from collections import Counter

from pyspark.sql import functions as F

from basketspark.operators import affinity, clicks, recommend, significance
from basketspark.operators.indexing import global_index
from basketspark.plans.catalog import _job
from basketspark.runtime import recorded_scratch


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_held_baskets_have_the_clicks_of_the_basket_rows(spark, sf_small):
    job = _job(spark, sf_small)
    rows = job.baskets.groupBy("basket_key", "prod_id", "coupon", "coupon_key", "prod_count", "coupon_count").agg(F.count(F.lit(1)).alias("n"))
    held = job.held.baskets.select("basket_key", "prod_count", "coupon_count", F.inline("items")).join(job.held.names, ["coupon_key"])
    assert bag(held.select(*rows.columns)) == bag(rows)
    assert job.counts["baskets"] == job.baskets.count()
    assert bag(recommend.held_sku_counts(job.held.items())) == bag(recommend.sku_basket_counts(job.baskets))


def test_hold_baskets_leaves_out_scrapers_and_single_groups(spark):
    made = [(1, "a", 1, 2), (1, "a", 1, 1), (1, "b", 2, 1)]  # two visits on one SKU
    made += [(2, "a", 1, 1), (2, "b", 1, 1)]  # one group
    made += [(3, "a", 1, 1), (3, "a", 2, 1)]  # one SKU in two groups
    made += [(4, f"p{i}", i, 1) for i in range(5)] + [(5, f"p{i}", i, 1) for i in range(4)]  # 5 groups, 4 groups
    df = spark.createDataFrame(made, "session_key long, prod_id string, coupon_key long, n long")
    got = {r.basket_key: r for r in clicks.hold_baskets(df, 4).collect()}
    assert sorted(got) == [1, 5]
    assert [tuple(i) for i in got[1]["items"]] == [("a", 1, 3), ("b", 2, 1)] and got[1].clicks == 4
    assert (got[5].prod_count, got[5].coupon_count) == (4, 4)


def test_held_pairs_equal_the_reference_join(spark):
    """Baskets above a block's groups, and a rare group that the threshold takes out."""
    made = [(b, f"p{g}", g, 1) for b in range(1, 13) for g in range(150) if (g * 7 + b) % (2 + g % 4)] + [(1, "rare", 999, 1)]
    df = spark.createDataFrame(made, "session_key long, prod_id string, coupon_key long, n long")
    names = df.select("coupon_key", F.concat(F.lit("G"), "coupon_key").alias("coupon")).distinct()
    held = clicks.hold_baskets(df, 500)
    totals = held.agg(F.count(F.lit(1)).alias("total_basket_count"))
    got = affinity.held_pair_matrix(affinity.whole_blocks(held, 500), names, totals).matrix
    rows = df.withColumnRenamed("session_key", "basket_key").join(names, ["coupon_key"])
    assert bag(got) == bag(affinity.pair_matrix(rows, method="join").matrix) != Counter()


def test_permuted_matrix_equals_that_of_the_permuted_rows(spark):
    made = [(b, f"p{(b * i) % 11}", (b * i) % 11 % 7, i % 3 + 1) for b in range(1, 40) for i in range(1, 5)] + [(99, f"p{i}", i, 1) for i in range(90)]
    items = spark.createDataFrame(made, "basket_key long, prod_id string, coupon_key long, n long").groupBy("basket_key", "prod_id", "coupon_key").agg(F.sum("n").alias("n"))
    names = items.select("coupon_key", F.concat(F.lit("G"), "coupon_key").alias("coupon")).distinct()
    rows = items.join(names, ["coupon_key"]).select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).drop("n", "col")
    want = affinity.pair_matrix(significance.permute_baskets(rows, 42, 2), by=["perm_id"]).matrix
    assert bag(significance.permutation_null(items, names, perm_times=2)) == bag(want) != Counter()


def test_index_writes_the_kept_columns_only(spark):
    df = spark.range(100).select("id", F.md5(F.col("id").cast("string")).alias("h"), (F.col("id") % 2).alias("g"))
    with recorded_scratch() as written:
        got = global_index(df, ["h"], "idx", partition_by=["g"], keep=["id"])
    assert not {"h"} & set(spark.read.parquet(written[0]).columns)
    assert bag(got.select("id", "idx")) == bag(global_index(df, ["h"], "idx", partition_by=["g"]).select("id", "idx"))


def test_percentile_works_its_frame_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def looked(v):
        seen.add(1)
        return v

    df = spark.range(500).select(F.udf(looked, "double")(F.col("id").cast("double")).alias("v"))
    df.where(F.col("v").isNotNull()).groupBy("v").count().collect()
    once = seen.value
    assert abs(significance.exact_percentile(df, "v", 0.95).first().value - 474.05) < 1e-9
    assert seen.value == 2 * once


def test_dense_pairs_equal_the_reference_join(spark, monkeypatch):
    made = [(b, f"G{g}", g) for b in range(1, 60) for g in range(200) if (g * 7 + b * b) % (2 + g % 5) == 0]
    rows = spark.createDataFrame(made + made[:50] + [(None, "G1", 1), (3, None, None)], "basket_key long, coupon string, coupon_key long")
    want = affinity.pair_matrix(rows, method="join").matrix
    monkeypatch.setattr(affinity, "DENSE_GROUPS", 32)
    monkeypatch.setattr(affinity, "_DENSE_BASKETS", 7)
    assert bag(affinity.pair_matrix(rows, method="dense").matrix) == bag(want) != Counter()
    with recorded_scratch() as written:
        pushed = affinity.confident_pairs_pushed(rows, 0.4, small_groups=8)
    assert bag(pushed) == bag(want.where("confidence >= 0.4")) != Counter()
    assert not any("large-baskets" in path for path in written)  # counted by blocks of groups


def test_self_join_has_more_tasks_for_more_rows(spark, monkeypatch):
    rows = spark.createDataFrame([(b, f"G{g}", g) for b in range(40) for g in range(20) if (b + g) % (2 + g % 4)], "basket_key long, coupon string, coupon_key long")
    want = bag(affinity.pair_matrix(rows).matrix)
    monkeypatch.setattr(affinity, "_JOIN_ROWS", 20)
    matrix = affinity.pair_matrix(rows, method="join").matrix
    plan = matrix._jdf.queryExecution().toString()
    sizes = [int(n) for n in re.findall(r"RepartitionByExpression \[[^]]*\], (\d+)", plan)]
    assert max(sizes) > 100 and min(sizes) > 8
    assert bag(matrix) == want != Counter()
