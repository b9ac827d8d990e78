"""What the job deals and writes no more than it needs: whole matrix, expanded and numbered rows."""

import os
from collections import Counter

from basketspark.operators import publish, recommend
from basketspark.plans.catalog import _job
from basketspark.runtime import materialize, recorded_scratch, settings

SHUFFLED = {"spark.sql.autoBroadcastJoinThreshold": "-1"}  # as at size


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_confident_pairs_are_written_without_the_matrix(spark, sf_small):
    job, other = _job(spark, sf_small), _job(spark, sf_small)
    with recorded_scratch() as written:
        got = bag(job.pairs)
    assert not [p for p in written if os.path.basename(p).startswith("pair-matrix")]
    matrix = other.affinity.matrix
    assert got == bag(recommend.confident_pairs(matrix, other.group_sales, other.cfg.min_confidence)) != Counter()
    assert job.confidence_obs.get["pairs"] == other.confidence_obs.get["pairs"] == matrix.count()
    assert bag(other.pairs) == got


def _made(spark):
    pairs = [(x, f"G{x}", y, f"G{y}", 4, 5, 2, 0.5, 1.0, 0.1) for x in range(6) for y in range(6) if x != y]
    pairs = spark.createDataFrame(pairs, "coupon_key_X long, coupon_X string, coupon_key_Y long, coupon_Y string, basket_count_X long, basket_count_Y long, basket_count_XY long, confidence double, lift double, support double")
    views = spark.createDataFrame([(f"p{g}{i}", g, i + 1) for g in range(5) for i in range(3)] + [("p00", 1, 9)], "prod_id string, coupon_key long, sku_basket_count long")
    sales = spark.createDataFrame([(f"p{g}0", g * 10 - 5) for g in range(5)], "prod_id string, sales long")
    return pairs, views, sales


def test_expanded_pairs_are_not_dealt_to_look_up_sales(spark):
    pairs, views, sales = _made(spark)
    with settings(spark, SHUFFLED):
        out = recommend.expand_to_skus(pairs, views, sales)
        assert "hashpartitioning(sku_" not in plan(out)
        rows = out.select("coupon_key_X", "sku_X", "sku_basket_count_X", "sku_sales_X", "coupon_key_Y", "sku_Y", "sku_basket_count_Y", "sku_sales_Y").collect()
    seen, sold = {}, {r.prod_id: r.sales for r in sales.collect()}
    for r in views.collect():
        seen.setdefault(r.coupon_key, []).append((r.prod_id, r.sku_basket_count, sold.get(r.prod_id, 0)))
    side = lambda g: seen.get(g, [(None, 0, 0)])
    want = [(x, *a, y, *b) for x in range(6) for y in range(6) if x != y for a in side(x) for b in side(y)]
    assert Counter(tuple(r) for r in rows) == Counter(want)


def test_ranked_rows_are_numbered_where_they_were_ranked(spark):
    pairs, views, sales = _made(spark)
    with settings(spark, SHUFFLED):
        ranked = recommend.top_k_pruned(pairs, views, sales, 3, by_range=True)
        numbered = publish.number_records(ranked, ranged=True)
        assert "SortMergeJoin" not in plan(numbered)  # the offsets are broadcast
        rows = numbered.collect()
    key = lambda r: tuple((r[c] is not None, r[c]) for c in publish.RECORD_ORDER)
    assert [r.record_id for r in sorted(rows, key=key)] == list(range(1, len(rows) + 1))
    assert bag(numbered.drop("record_id")) == bag(recommend.rank_expanded(pairs, views, sales, 3)) != Counter()


def test_settings_hold_while_a_frame_is_written(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, None)
    materialize(spark.range(3), "settings")
    assert spark.conf.get(key, None) == before
    with settings(spark, {key: "1m"}):
        assert spark.conf.get(key) == "1m"
    assert spark.conf.get(key, None) == before
