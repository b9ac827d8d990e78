"""Block pairs and pushed confidence on very uneven baskets; versions, ids and guards."""

import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from basketspark.errors import CoverageError, DataValidityError, OutputOutOfBoundError
from basketspark.operators import affinity, publish, quality
from basketspark.plans import pipeline
from basketspark.plans.catalog import fixture_config
from basketspark.runtime import create_exclusive, exists, list_files, read_small, scratch_path
from basketspark.sources.fixtures import fixture_sources


def uneven(spark):
    """Many small baskets and one that holds a third of all rows; null keys and repeated rows."""
    rnd = random.Random(11)
    rows = [(b, g) for b in range(300) for g in rnd.sample(range(150), rnd.randint(1, 6))] + [(1000, g) for g in range(140)] * 4
    rows += [(1001, g) for g in range(0, 150, 3)] + [(None, 3), (5, None)]
    named = [(b, None if g is None else f"g{g}", g) for b, g in rows]
    return spark.createDataFrame(named, "basket_key long, coupon string, coupon_key long").repartition(5)


def counts_of(df):
    return {(r.coupon_key_X, r.coupon_key_Y): r.basket_count_XY for r in df.collect()}


@pytest.mark.parametrize("block_groups", [3, 16, 64, 500])
def test_blocks_make_every_pair_once(spark, monkeypatch, block_groups):
    monkeypatch.setattr(affinity, "BLOCK_GROUPS", block_groups)
    rows = uneven(spark)
    want = affinity.pair_matrix(rows, method="join", pin=False).matrix.collect()
    got = affinity.pair_matrix(rows, method="blocks").matrix.collect()
    assert len(want) > 1000 and sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_blocks_of_independent_runs(spark):
    rows = uneven(spark).withColumn("perm_id", F.explode(F.array(F.lit(0), F.lit(1)))).where("perm_id = 0 or basket_key % 3 != 0")
    forms = [affinity.pair_matrix(rows, by=["perm_id"], method=m).matrix.collect() for m in ("blocks", "half", "join")]
    assert sorted(map(tuple, forms[0])) == sorted(map(tuple, forms[1])) == sorted(map(tuple, forms[2]))


def test_a_hot_basket_is_many_even_groups(spark):
    """The rows that make the pairs of one large basket: none holds more than two blocks."""
    side = spark.range(2000).select(F.lit(7).cast("long").alias("basket_key"), F.col("id").alias("coupon_key"))
    pairs = affinity.block_pairs(side, block_groups=50)
    assert pairs.count() == pairs.distinct().count() == 2000 * 1999 // 2


@pytest.mark.parametrize("small_groups", [1, 4, 64])
@pytest.mark.parametrize("limit", [0.05, 0.2, 0.6, 1.0])
def test_pushed_confidence_loses_no_pair(spark, small_groups, limit):
    rows = uneven(spark)
    kept = spark.range(0, 120).select(F.col("id").alias("coupon_key"))
    matrix = affinity.pair_matrix(rows, method="join", pin=False).matrix.where(F.col("confidence") >= limit)
    inside = matrix.where("coupon_key_X < 120 and coupon_key_Y < 120")
    got = affinity.confident_pairs_pushed(rows, limit, small_groups=small_groups)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, matrix.collect()))
    got = affinity.confident_pairs_pushed(rows, limit, kept, small_groups=small_groups, pin=False)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, inside.collect()))


def test_empty_baskets_have_no_pairs(spark):
    none = uneven(spark).where(F.lit(False))
    assert affinity.pair_matrix(none).matrix.count() == 0 == affinity.confident_pairs_pushed(none, 0.2).count()


def test_exclusive_files_have_one_writer(spark):
    folder = scratch_path(spark, "exclusive")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda n: create_exclusive(spark, f"{folder}/one", f"writer {n}"), range(8)))
    assert sum(won) == 1 and list_files(spark, folder) == ["one"]
    assert read_small(spark, f"{folder}/one") == f"writer {won.index(True)}"
    assert list_files(spark, f"{folder}/none") == []


def test_runs_at_once_reserve_different_ids(spark):
    root, cfg = scratch_path(spark, "ids"), fixture_config()
    with ThreadPoolExecutor(6) as pool:
        ids = list(pool.map(lambda _: publish.reserve_run_id(spark, cfg, root), range(6)))
    assert sorted(ids) == [1, 2, 3, 4, 5, 6] and publish.next_run_id(spark, cfg, root) == 7


def test_a_version_number_taken_meanwhile_is_left_alone(spark, sf_small):
    cfg, root = fixture_config(), scratch_path(spark, "late")
    detail = publish.stamp_detail(pipeline.build(fixture_sources(spark, sf_small), cfg).ranked, 1, cfg)
    late = publish.publish_steps(spark, detail, None, 2, cfg, root)
    next(late)  # its rows are written; another run names its version first
    publish.publish(spark, detail.withColumn("MASTER_ID", F.lit(1).cast("long")), None, 1, cfg, root)
    for _ in late:
        pass
    assert [v["master_id"] for v in publish.table_versions(spark, cfg, root)] == [1, 2]
    assert publish.read_table(spark, cfg, root, master_id=1).count() == publish.read_table(spark, cfg, root).count() > 0
    with pytest.raises(FileNotFoundError):
        publish.read_table(spark, cfg, root, master_id=9)


def test_a_run_that_violates_a_check_writes_nothing(spark, sf_small):
    import dataclasses

    src, cfg = fixture_sources(spark, sf_small), fixture_config()
    cases = [
        (DataValidityError, dict(prod_feature=src.prod_feature.where(F.col("size_grp") == "T"))),
        (CoverageError, dict(hits=src.hits.where("dt_key >= 19950103"))),
        (OutputOutOfBoundError, dict(products=src.products.withColumn("stk_type_cd", F.lit("D")))),
    ]
    for error, cut in cases:
        root = scratch_path(spark, "violating")
        with pytest.raises(error, match="group map|hits|sales"):
            pipeline.run(spark, dataclasses.replace(src, **cut), cfg, out_root=root, keep_frames=False)
        assert not exists(spark, f"{root}/tables")


def test_other_errors_pass_the_checks_unchanged(spark):
    from pyspark.errors import PySparkException

    with pytest.raises(PySparkException), quality.checks():
        spark.range(1).select(F.raise_error(F.lit("something else"))).collect()
