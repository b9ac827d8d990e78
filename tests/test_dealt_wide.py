"""The job's steps are dealt to tasks that grow in number with the input, whatever the session's number."""

from collections import Counter

from pyspark.sql import functions as F

from basketspark.operators import clicks
from basketspark.runtime import DEALT, materialize, settings, wide
from basketspark.sources.readers import Sources

PARTS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SMALL = {"spark.sql.shuffle.partitions": "2", "spark.sql.autoBroadcastJoinThreshold": "-1"}


def test_a_written_frame_has_as_many_tasks_as_its_size_needs(spark):
    rows = spark.range(40_000, numPartitions=4).select(F.xxhash64("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    with settings(spark, SMALL):
        # A task is to hold 64 kB of some 3 MB.
        out = materialize(rows.groupBy("k").agg(F.max("text").alias("text")), "dealt", conf={"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"})
        assert spark.conf.get(PARTS, None) is None
    assert len(out.inputFiles()) > 8 and out.count() == 40_000
    with settings(spark, {"spark.sql.shuffle.partitions": str(2 * DEALT)}):
        assert wide(spark) == {PARTS: str(2 * DEALT)}  # never fewer than the session asks for


def _sources(spark):
    hit = lambda visit, *skus: (1, visit, "t", 20200102, ",".join(skus), "a|b")
    hits = [hit("v1", "p1", "p2", "p9"), hit("v1", "p1", "p8"), hit("v2", "p2", "p3", "p8"), hit("v3", "p1", "p9"), hit("v4", "p9", "p8"), hit("v5", "p1", "p3")]
    hits = [h[:2] + (f"t{i}",) + h[3:] for i, h in enumerate(hits)]
    return Sources(
        hits=spark.createDataFrame(hits, "visit_return_count long, post_visid_combined string, time_stamp string, dt_key int, prod_list string, demandbase string"),
        visit_sessions=spark.createDataFrame([(1, f"v{i}", i) for i in range(1, 5)], "visit_return_count long, post_visid_combined string, visit_session_key long"),
        # P9 and P8 are discontinued; P9 is named twice, and both are in the group map, too.
        products=spark.createDataFrame([("P9", "D"), ("P9", "D"), ("P8", "D"), ("P1", "S"), ("P2", None), (None, "D")], "sku string, stk_type_cd string"),
        prod_feature=spark.createDataFrame([("p1", "A"), ("p1", "B"), ("p9", "A"), ("p8", "C"), ("p7", "D")], "sku_nbr string, size_grp string"),
        invoices=spark.createDataFrame([], "sku string, dt_key int, amt decimal(18,2)"),
    )


def test_clicks_on_discontinued_skus_leave_without_being_dealt_for_it(spark):
    src, window = _sources(spark), (20200101, 20200201)
    held = clicks.build_baskets(src, window)
    rows, viewed, keys, _, _ = clicks.build_clicks(src, window)
    want = Counter(tuple(r) for r in rows.select("basket_key", "prod_id", "coupon_key", "prod_count", "coupon_count").collect())
    got = Counter()
    for r in held.baskets.select("basket_key", "prod_count", "coupon_count", F.inline("items")).collect():
        got[r.basket_key, r.prod_id, r.coupon_key, r.prod_count, r.coupon_count] += r.n
    assert got == want and {k[1] for k in got} == {"P1", "P2", "P3"}
    assert {r[0] for r in held.viewed.collect()} == {r[0] for r in viewed.collect()} == {"P1", "P2", "P3"}
    assert {tuple(r) for r in held.keys.collect()} == {tuple(r) for r in keys.collect()}
    with settings(spark, SMALL):
        lazy = clicks.build_baskets(src, window, pin=False)
        seen = clicks.drop_discontinued(lazy.viewed, src.products)
        assert Counter(seen.collect()) == Counter(lazy.viewed.collect())
