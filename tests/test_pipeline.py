"""End-to-end run with publishing, and invariants of the outputs."""

from pyspark.sql import functions as F

from basketspark.plans import pipeline
from basketspark.plans.catalog import fixture_config
from basketspark.runtime import scratch_path
from basketspark.sources.fixtures import fixture_sources


def test_run_publishes_and_archives(spark, sf_small):
    root = scratch_path(spark, "test-publish")
    src = fixture_sources(spark, sf_small)
    cfg = fixture_config()
    frames, detail, report = pipeline.run(spark, src, cfg, out_root=root)
    assert report["master_id"] == 1 and report["confidence_above_1"] == 0 and report["confidence_below_0"] == 0
    n = spark.read.parquet(report["paths"]["table"]).count()
    assert n == frames.ranked.count() > 0
    _, _, report2 = pipeline.run(spark, src, cfg, out_root=root)
    assert report2["master_id"] == 2
    assert spark.read.parquet(report2["paths"]["archive"]).select(F.max("MASTER_ID")).first()[0] == 1
    assert spark.read.parquet(report2["paths"]["table"]).select(F.max("MASTER_ID")).first()[0] == 2
    assert spark.read.parquet(report2["paths"]["registry"]).count() == 2
    lists = spark.read.option("header", True).csv(report2["paths"]["csv_QA"])
    assert lists.count() == lists.select("sku_X").distinct().count()


def test_invariants(spark, sf_small):
    frames = pipeline.build(fixture_sources(spark, sf_small), fixture_config())
    m = frames.affinity.matrix
    assert m.where((F.col("confidence") < 0) | (F.col("confidence") > 1)).count() == 0
    mirror = m.select(
        F.col("coupon_key_Y").alias("coupon_key_X"),
        F.col("coupon_key_X").alias("coupon_key_Y"),
        F.col("basket_count_XY").alias("n_m"),
        F.col("lift").alias("lift_m"),
    )
    joined = m.join(mirror, ["coupon_key_X", "coupon_key_Y"], "full")
    assert joined.where(F.col("basket_count_XY").isNull() | F.col("n_m").isNull()).count() == 0
    assert joined.where(F.col("basket_count_XY") != F.col("n_m")).count() == 0
    assert joined.where(F.abs(F.col("lift") - F.col("lift_m")) > 1e-9 * F.abs(F.col("lift"))).count() == 0
    assert frames.ranked.agg(F.max("cvm_rank")).first()[0] <= 35
    assert frames.lists.count() == frames.ranked.select("sku_X").distinct().count()


def test_ccg_default_has_no_cut_off_and_publishes_its_rows(spark, sf_small):
    from basketspark.config import RunConfig
    from basketspark.sources.fixtures import FIXTURE_PERIOD_DAYS, FIXTURE_START_DATE

    cfg = RunConfig(division="CCG", start_date=FIXTURE_START_DATE, period_days=FIXTURE_PERIOD_DAYS)
    assert cfg.top_k is None and RunConfig(division="LSG", start_date=FIXTURE_START_DATE).top_k == 35
    assert RunConfig(division="CCG", start_date=FIXTURE_START_DATE, top_k=5).top_k == 5
    root = scratch_path(spark, "test-publish-ccg")
    _, _, report = pipeline.run(spark, fixture_sources(spark, sf_small), cfg, out_root=root)
    table = spark.read.parquet(report["paths"]["table"])
    files = spark.read.option("header", True).csv(report["paths"]["csv_QA"])
    assert table.count() == report["published_rows"] == files.count() > 0
    assert table.agg(F.max("CVM_RANK")).first()[0] > 35
    assert table.select("RECORD_ID").distinct().count() == table.count()


def test_empty_tables_are_not_archived_and_ids_move_on(spark, sf_small):
    from basketspark.operators import publish

    cfg = fixture_config()
    root = scratch_path(spark, "test-publish-empty")
    detail = publish.stamp_detail(pipeline.build(fixture_sources(spark, sf_small), cfg).ranked, 1, cfg)
    publish.replace_table(spark, detail.limit(0), None, 1, cfg, root)
    paths, n = publish.replace_table(spark, detail, None, 1, cfg, root)
    assert "archive" not in paths and n > 0
    assert publish.next_run_id(spark, cfg, root) == 2


def test_runs_can_discard_what_they_wrote(spark, sf_small):
    from basketspark.runtime import exists, recorded_scratch

    with recorded_scratch() as written:
        _, _, report = pipeline.run(
            spark, fixture_sources(spark, sf_small), fixture_config(), out_root=scratch_path(spark, "keep"), keep_frames=False
        )
    assert [p for p in written if exists(spark, p) and "/keep-" not in p] == []
    assert spark.read.parquet(report["paths"]["table"]).count() == report["published_rows"]


def test_a_cluster_without_a_shared_folder_is_refused(spark):
    import pytest

    from basketspark import runtime

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        runtime.checkpoint_root(Session())
