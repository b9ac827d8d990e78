"""Named queries over the test tables: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the whole test tables (through the fixture views) and runs the same
operators as the job. ``basketspark.plans.oracle`` holds the equivalent SQL.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketspark.config import RunConfig
from basketspark.errors import BasketError
from basketspark.functions.columns import day_key_of
from basketspark.operators import affinity, clicks, incremental, indexing, publish, quality, recommend, sales, significance
from basketspark.plans import pipeline
from basketspark.runtime import exists, materialize, scratch_path, settings, wide
from basketspark.sources.fixtures import FIXTURE_PERIOD_DAYS, FIXTURE_START_DATE, fixture_sources, hits_view, read_testdata
from basketspark.streaming.clicks_stream import start_clicks_stream

Query = Callable[[SparkSession, str], DataFrame]


def fixture_config(**overrides) -> RunConfig:
    return RunConfig(start_date=FIXTURE_START_DATE, period_days=FIXTURE_PERIOD_DAYS, **overrides)


def _sources(spark: SparkSession, sf_dir: str):
    return fixture_sources(spark, sf_dir, fixture_config().window)


def _job(spark: SparkSession, sf_dir: str, **overrides) -> pipeline.Job:
    """The job's frames; a query builds only those that it asks for."""
    return pipeline.build(_sources(spark, sf_dir), fixture_config(**overrides))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _sources(spark, sf_dir)
    return clicks.parse_hits(src.hits, src.visit_sessions, fixture_config().window)


def q_hits_parsed(spark, sf_dir):
    return _parsed(spark, sf_dir)


def q_clicks_active(spark, sf_dir):
    return clicks.drop_discontinued(_parsed(spark, sf_dir), _sources(spark, sf_dir).products)


def q_clicks_grouped(spark, sf_dir):
    return clicks.assign_groups(q_clicks_active(spark, sf_dir), clicks.read_group_map(_sources(spark, sf_dir).prod_feature))


def q_group_keys(spark, sf_dir):
    gmap = clicks.read_group_map(_sources(spark, sf_dir).prod_feature)
    return clicks.group_keys(gmap, materialize(q_clicks_grouped(spark, sf_dir), "clicks"))


def q_session_stats(spark, sf_dir):
    return clicks.session_stats(q_clicks_grouped(spark, sf_dir))


def q_sessions_kept(spark, sf_dir):
    return clicks.keep_sessions(q_session_stats(spark, sf_dir))


def q_baskets(spark, sf_dir):
    return _job(spark, sf_dir).baskets


def q_sku_sales(spark, sf_dir):
    src = _sources(spark, sf_dir)
    return sales.sku_sales(src.invoices, src.products, fixture_config().window, exclude_discontinued=True)


def q_sku_sales_all(spark, sf_dir):
    return sales.sku_sales(_sources(spark, sf_dir).invoices, None, fixture_config().window, exclude_discontinued=False)


def q_sku_sales_fine(spark, sf_dir):
    """Amounts of four decimals: price times discount, not rounded before they are summed."""
    src = _sources(spark, sf_dir)
    fine = read_testdata(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("sku"),
        day_key_of("l_shipdate").alias("dt_key"),
        (F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_discount").cast("decimal(5,2)")).cast("decimal(18,4)").alias("amt"),
    )
    return sales.sku_sales(fine, src.products, fixture_config().window, exclude_discontinued=True)


def q_group_sales(spark, sf_dir):
    return _job(spark, sf_dir).group_sales


def q_group_sales_inner(spark, sf_dir):
    job = _job(spark, sf_dir)
    return sales.build_sales(
        job.sources, job.cfg.window, job.viewed, job.keys, exclude_discontinued=False, how="inner"
    )[2]


def q_group_basket_counts(spark, sf_dir):
    return affinity.pair_matrix(_job(spark, sf_dir).held.rows()).counts


def q_frequent_groups(spark, sf_dir):
    return affinity.pair_matrix(_job(spark, sf_dir).held.rows()).frequent


def q_pair_matrix(spark, sf_dir):
    return _job(spark, sf_dir).affinity.matrix


def q_pair_matrix_selfjoin(spark, sf_dir):
    return _job(spark, sf_dir, pair_method="join").affinity.matrix


def q_pairs_confident(spark, sf_dir):
    return _job(spark, sf_dir).pairs


def q_pairs_confident_pushed(spark, sf_dir):
    """The same pairs with the confidence taken into the counting: baskets above the average size
    are looked into for pairs only that may still reach it."""
    job = _job(spark, sf_dir)
    return affinity.confident_pairs_pushed(job.held.rows(), job.cfg.min_confidence, job.group_sales, job.cfg.percentile_t, small_groups=6)


def q_sku_basket_counts(spark, sf_dir):
    return _job(spark, sf_dir).prod_views


def q_sku_pairs_scored(spark, sf_dir):
    job = _job(spark, sf_dir)
    return recommend.expand_to_skus(job.pairs, job.prod_views, job.sku_sales)


def q_sku_topk(spark, sf_dir):
    return _job(spark, sf_dir).unnumbered


def q_sku_topk_full_expansion(spark, sf_dir):
    return _job(spark, sf_dir, prune_candidates=False).unnumbered


def q_ccg_ranked(spark, sf_dir):
    """The second division: all invoiced SKUs, group match required, ranked without cut-off."""
    return _job(spark, sf_dir, division="CCG").unnumbered


def q_ccg_factorised(spark, sf_dir):
    """The second division's ranked rows from their stored form: ranks held once for all SKUs of the
    same groups, and the SKUs; expanded when they are read."""
    job, path = _job(spark, sf_dir, division="CCG"), scratch_path(spark, "factorised")
    recommend.write_factorised(recommend.factorise(job.pairs, job.prod_views, job.sku_sales, None), path)
    return recommend.read_factorised(spark, path).expand()


def q_rec_lists(spark, sf_dir):
    job = _job(spark, sf_dir)
    return job.output_rows(job.unnumbered)


def q_published_detail(spark, sf_dir):
    return publish.stamp_detail(_job(spark, sf_dir).ranked, 1, fixture_config())


def _published(spark, sf_dir, cfg: RunConfig, root: str | None = None, runs: int = 1, registered: bool = True) -> str:
    """The same job published several times. Without ``registered`` every run stops before
    its registry row, as a failure there would."""
    root = root or scratch_path(spark, "publish")
    job = pipeline.build(_sources(spark, sf_dir), cfg)
    for _ in range(runs):
        master_id = publish.reserve_run_id(spark, cfg, root)
        detail = publish.stamp_detail(job.ranked, master_id, cfg)
        steps = publish.publish if registered else publish.replace_table
        steps(spark, detail, job.lists, master_id, cfg, root, csv_targets=("QA",))
    return root


def _csv(spark, sf_dir, cfg: RunConfig) -> DataFrame:
    root = _published(spark, sf_dir, cfg)
    return spark.read.option("header", True).csv(f"{root}/csv/QA/CSV_Pipes_{cfg.window[1]}.csv")


def q_published_csv_roundtrip(spark, sf_dir):
    return _csv(spark, sf_dir, fixture_config())


def q_ccg_published_csv(spark, sf_dir):
    """The ranked rows of the second division as its files hold them (all columns are text)."""
    rows = _csv(spark, sf_dir, fixture_config(division="CCG"))
    return rows.select("sku_X", "coupon_X", "sku_Y", "coupon_Y", F.col("basket_count_XY").cast("bigint"), F.col("cvm_rank").cast("bigint"))


def _archive_and_table(spark, root: str, cfg: RunConfig, archived: int) -> DataFrame:
    out = publish.read_table(spark, cfg, root)
    for n in range(1, archived + 1):
        out = out.unionByName(publish.read_table(spark, cfg, root, master_id=n))
    return out


def q_archive_overwrite_roundtrip(spark, sf_dir):
    cfg = fixture_config()
    return _archive_and_table(spark, _published(spark, sf_dir, cfg, runs=2), cfg, 1)


def q_publish_after_failed_registry(spark, sf_dir):
    """Three runs that stop before the registry row: each has its own id, all rows remain."""
    cfg = fixture_config()
    return _archive_and_table(spark, _published(spark, sf_dir, cfg, runs=3, registered=False), cfg, 2)


def q_publish_stopped_anywhere(spark, sf_dir):
    """A first run, then one run after another that stops after each of the steps of publishing:
    what a reader of the table then gets, a whole run's rows every time."""
    cfg, root = fixture_config(), scratch_path(spark, "publish-stops")
    job = pipeline.build(_sources(spark, sf_dir), cfg)
    seen = None
    for number, stop in enumerate((None, *publish.STEPS)):
        master_id = publish.reserve_run_id(spark, cfg, root)
        detail = publish.stamp_detail(job.ranked, master_id, cfg)
        for step, _ in publish.publish_steps(spark, detail, job.lists, master_id, cfg, root, csv_targets=("QA",)):
            if step == stop:
                break
        read = publish.read_table(spark, cfg, root).select(F.lit(number).alias("run"), F.lit(stop or "none").alias("stopped_after"), "MASTER_ID", "RECORD_ID", "SKU_X", "SKU_Y")
        seen = read if seen is None else seen.unionByName(read)
    return seen


def q_publish_interleaved(spark, sf_dir):
    """Two runs take their ids and publish at the same time, step by step in turn: each has its own
    id, the rows of both remain."""
    cfg, root = fixture_config(), scratch_path(spark, "publish-two")
    job = pipeline.build(_sources(spark, sf_dir), cfg)
    ids = [publish.reserve_run_id(spark, cfg, root) for _ in range(2)]
    runs = [publish.publish_steps(spark, publish.stamp_detail(job.ranked, n, cfg), job.lists, n, cfg, root, csv_targets=("QA",)) for n in ids]
    for _ in zip(*runs):
        pass
    return publish.read_table(spark, cfg, root, master_id=ids[0]).unionByName(publish.read_table(spark, cfg, root, master_id=ids[1]))


def q_run_registry(spark, sf_dir):
    return spark.read.parquet(f"{_published(spark, sf_dir, fixture_config())}/model_master")


def q_run_job(spark, sf_dir):
    """The checked end-to-end run: the table that it publishes."""
    root = scratch_path(spark, "run")
    _, _, report = pipeline.run(spark, fixture_sources(spark, sf_dir), fixture_config(), out_root=root, keep_frames=False)
    return spark.read.parquet(report["paths"]["table"])


def q_check_outcomes(spark, sf_dir):
    """What each check raises on the test tables and on tables cut so that it must."""
    src, cfg = fixture_sources(spark, sf_dir), fixture_config()
    job = _job(spark, sf_dir)
    none = F.lit(False)
    cases = {
        "group_map": lambda: quality.require_not_empty_map(src.prod_feature),
        "group_map_empty": lambda: quality.require_not_empty_map(src.prod_feature.where(F.col("size_grp") == "T")),
        "sales": lambda: quality.require_sales(job.sku_sales),
        "sales_empty": lambda: quality.require_sales(sales.sku_sales(src.invoices.where(none), src.products, cfg.window)),
        "coverage": lambda: pipeline.check_coverage(src, cfg),
        "coverage_short": lambda: pipeline.check_coverage(_sources(spark, sf_dir), cfg),
        "division": lambda: fixture_config(division="XYZ"),
        "start_date": lambda: RunConfig(start_date="20011301"),
    }

    def outcome(case) -> str:
        try:
            case()
        except BasketError as error:
            return type(error).__name__
        return "passed"

    return spark.createDataFrame([(name, outcome(case)) for name, case in cases.items()], "check_name string, outcome string")


def q_guard_outcomes(spark, sf_dir):
    """Frames with the checks in their plans, written from the test tables and from tables cut so
    that a check must fail: what is raised, and whether the write was committed."""
    src, cfg = fixture_sources(spark, sf_dir), fixture_config()
    job, none = _job(spark, sf_dir), F.lit(False)
    matrix = job.affinity.matrix  # before the pairs, which then read it
    read = lambda **cut: quality.guard_sources(dataclasses.replace(src, **cut), cfg)
    pulled = lambda s: clicks.pull_hits(s.hits, s.visit_sessions, cfg.window)
    billed = lambda s: sales.sku_sales(s.invoices, s.products, cfg.window)
    of_window = _sources(spark, sf_dir)  # has no day before the window
    cases = {
        "hits": pulled(read()),
        "group_map_empty": pulled(read(prod_feature=src.prod_feature.where(F.col("size_grp") == "T"))),
        "hits_short": pulled(read(hits=of_window.hits)),
        "invoices": billed(read()),
        "invoices_none": billed(read(invoices=src.invoices.where(F.col("amt") < -(10**12)))),
        "sales": quality.guard_sales(job.pairs, job.sku_sales),
        "sales_none": quality.guard_sales(job.pairs, job.sku_sales.where(none)),
        "confidence": quality.guard_confidence(matrix),
        "confidence_high": quality.guard_confidence(matrix.withColumn("confidence", F.col("confidence") + 1.0)),
        "confidence_low": quality.guard_confidence(matrix.withColumn("confidence", -F.col("confidence"))),
    }

    def written(name: str, df: DataFrame) -> tuple[str, str, bool]:
        path, outcome = scratch_path(spark, f"guard-{name}"), "passed"
        try:
            with quality.checks(), settings(spark, wide(spark)):
                df.write.parquet(path)
        except BasketError as error:
            outcome = type(error).__name__
        return name, outcome, exists(spark, f"{path}/_SUCCESS")

    return spark.createDataFrame([written(*c) for c in cases.items()], "check_name string, outcome string, committed boolean")


def q_run_report(spark, sf_dir):
    """The counts of the checked run, all observed while its frames are written."""
    _, _, report = pipeline.run(spark, fixture_sources(spark, sf_dir), fixture_config(), keep_frames=False)
    names = ("pairs", "confidence_above_1", "confidence_below_0", "basket_rows", "sku_sales_rows", "published_rows")
    return spark.createDataFrame([tuple(report[n] for n in names)], ", ".join(f"{n} bigint" for n in names))


def q_coverage_check(spark, sf_dir):
    src = fixture_sources(spark, sf_dir)
    window = fixture_config().window
    return quality.coverage_report(src.hits, "dt_key", window, "hits").unionByName(
        quality.coverage_report(src.invoices, "dt_key", window, "invoices")
    )


def q_quality_report(spark, sf_dir):
    job = _job(spark, sf_dir)

    def n(df: DataFrame):
        return df.agg(F.count(F.lit(1))).scalar()

    baskets = job.held.baskets.agg(F.coalesce(F.sum("clicks"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("k"))
    return quality.confidence_report(job.affinity.matrix).select(
        "*",
        n(job.group_map).alias("group_map_rows"),
        n(job.sku_sales).alias("sales_rows"),
        n(_parsed(spark, sf_dir)).alias("click_rows"),
        baskets.select("n").scalar().alias("basket_rows"),
        baskets.select("k").scalar().alias("baskets_kept"),
    )


def _permutation_null(spark, sf_dir, perm_times: int) -> DataFrame:
    held = _job(spark, sf_dir).held
    return significance.permutation_null(held.items(), held.names, seed=42, perm_times=perm_times)


def q_permutation_null(spark, sf_dir):
    return _permutation_null(spark, sf_dir, 1)


def q_permutation_null_multi(spark, sf_dir):
    return _permutation_null(spark, sf_dir, 3)


def q_permutation_threshold(spark, sf_dir):
    return significance.significance_threshold(q_permutation_null(spark, sf_dir), 0.05)


#: Three positions of a window of five years: the second adds and retires a day, the third a month.
WINDOW_POSITIONS = ((19950103, 20000103), (19950104, 20000104), (19950203, 20000203))


def _daily(spark, sf_dir) -> str:
    """The daily table of all hits, stored by day."""
    src = fixture_sources(spark, sf_dir)
    pulled = clicks.pull_hits(src.hits, src.visit_sessions, (0, 99999999), keep=("dt_key",))
    return incremental.store_days(spark, incremental.daily_clicks(pulled, src.products, src.prod_feature))


def q_window_positions(spark, sf_dir):
    """The pair matrix of a window that moves twice, each time by signed counts of the sessions
    that the added and retired days touch."""
    daily, state, out = spark.read.parquet(_daily(spark, sf_dir)), None, None
    for position, window in enumerate(WINDOW_POSITIONS):
        state = incremental.move_state(state, daily, window) if state else incremental.build_state(daily, window)
        matrix = incremental.state_matrix(state).select(F.lit(position).alias("position"), "*")
        out = matrix if out is None else out.unionByName(matrix)
    return out


def q_window_clicks_by_day(spark, sf_dir):
    """Clicks a day in the last position's first month, read from the folders of those days."""
    days = incremental.read_days(spark, _daily(spark, sf_dir), (19950203, 19950303))
    return days.groupBy("dt_key").agg(F.count(F.lit(1)).alias("clicks"), F.count_distinct("session_key").alias("sessions"))


def _order_brands(spark, sf_dir, basket) -> DataFrame:
    lines = read_testdata(spark, sf_dir, "lineitem").select(basket.alias("basket_key"), "l_partkey")
    part = read_testdata(spark, sf_dir, "part").select("p_partkey", "p_brand")
    rows = lines.join(part, lines.l_partkey == part.p_partkey, "inner").select(
        "basket_key", F.col("l_partkey").cast("string").alias("prod_id"), F.col("p_brand").alias("coupon")
    )
    keyed = rows.join(indexing.dense_rank_keys(rows, "coupon", "coupon_key"), ["coupon"], "inner")
    return affinity.pair_matrix(keyed).matrix


def q_order_brand_matrix(spark, sf_dir):
    """The pair matrix on plain order lines: order = basket, part = SKU, brand = group."""
    return _order_brands(spark, sf_dir, F.col("l_orderkey"))


def q_month_part_matrix(spark, sf_dir):
    """Baskets without the session filter: all lines of a supplier and ship month, each part a group."""
    month = F.year("l_shipdate") * 100 + F.month("l_shipdate")
    rows = read_testdata(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") * 1000000 + month).cast("bigint").alias("basket_key"),
        F.col("l_partkey").cast("string").alias("prod_id"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("coupon"),
        F.col("l_partkey").cast("bigint").alias("coupon_key"),
    )
    return affinity.pair_matrix(rows).matrix


def day_part_baskets(spark, sf_dir) -> DataFrame:
    """All lines of a ship day together, each part a group: a basket grows with the input."""
    day = F.year("l_shipdate") * 10000 + F.month("l_shipdate") * 100 + F.dayofmonth("l_shipdate")
    return read_testdata(spark, sf_dir, "lineitem").select(
        day.cast("bigint").alias("basket_key"),
        F.col("l_partkey").cast("string").alias("prod_id"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("coupon"),
        F.col("l_partkey").cast("bigint").alias("coupon_key"),
    )


def q_day_part_matrix(spark, sf_dir):
    """Uncapped baskets: the pair matrix on the parts of each ship day."""
    return affinity.pair_matrix(day_part_baskets(spark, sf_dir), method="dense").matrix


def q_day_pairs_confident(spark, sf_dir):
    """Confident pairs of parts on uncapped baskets; those above 16 parts hold nearly all pairs."""
    return affinity.confident_pairs_pushed(day_part_baskets(spark, sf_dir), 0.1, small_groups=16)


def q_clicks_stream(spark, sf_dir):
    """The click-cleaning step as a stream: the lines land in three parts, newest first, and
    each part is a micro-batch of its own (or several)."""
    src = fixture_sources(spark, sf_dir)
    lines = read_testdata(spark, sf_dir, "lineitem")
    landing, out, state = (scratch_path(spark, f"clicks-stream-{n}") for n in ("in", "out", "state"))
    year = F.year("l_shipdate")
    for part in (year >= 1999, (year >= 1997) & (year < 1999), year < 1997):
        lines.where(part).write.mode("append").parquet(landing)
        start_clicks_stream(spark, landing, lines.schema, hits_view, src.visit_sessions, fixture_config().window, out, state).awaitTermination()
    return spark.read.parquet(out).select(*clicks.CLICK_COLUMNS)


QUERIES: dict[str, Query] = {
    "hits_parsed": q_hits_parsed,
    "clicks_active": q_clicks_active,
    "clicks_grouped": q_clicks_grouped,
    "group_keys": q_group_keys,
    "session_stats": q_session_stats,
    "sessions_kept": q_sessions_kept,
    "baskets": q_baskets,
    "sku_sales": q_sku_sales,
    "sku_sales_all": q_sku_sales_all,
    "sku_sales_fine": q_sku_sales_fine,
    "group_sales": q_group_sales,
    "group_sales_inner": q_group_sales_inner,
    "group_basket_counts": q_group_basket_counts,
    "frequent_groups": q_frequent_groups,
    "pair_matrix": q_pair_matrix,
    "pair_matrix_selfjoin": q_pair_matrix_selfjoin,
    "pairs_confident": q_pairs_confident,
    "pairs_confident_pushed": q_pairs_confident_pushed,
    "sku_basket_counts": q_sku_basket_counts,
    "sku_pairs_scored": q_sku_pairs_scored,
    "sku_topk": q_sku_topk,
    "sku_topk_full_expansion": q_sku_topk_full_expansion,
    "rec_lists": q_rec_lists,
    "ccg_ranked": q_ccg_ranked,
    "ccg_factorised": q_ccg_factorised,
    "published_detail": q_published_detail,
    "published_csv_roundtrip": q_published_csv_roundtrip,
    "ccg_published_csv": q_ccg_published_csv,
    "publish_after_failed_registry": q_publish_after_failed_registry,
    "publish_stopped_anywhere": q_publish_stopped_anywhere,
    "publish_interleaved": q_publish_interleaved,
    "run_job": q_run_job,
    "check_outcomes": q_check_outcomes,
    "guard_outcomes": q_guard_outcomes,
    "run_report": q_run_report,
    "archive_overwrite_roundtrip": q_archive_overwrite_roundtrip,
    "run_registry": q_run_registry,
    "coverage_check": q_coverage_check,
    "quality_report": q_quality_report,
    "permutation_null": q_permutation_null,
    "permutation_null_multi": q_permutation_null_multi,
    "permutation_threshold": q_permutation_threshold,
    "window_positions": q_window_positions,
    "window_clicks_by_day": q_window_clicks_by_day,
    "order_brand_matrix": q_order_brand_matrix,
    "month_part_matrix": q_month_part_matrix,
    "day_part_matrix": q_day_part_matrix,
    "day_pairs_confident": q_day_pairs_confident,
    "clicks_stream": q_clicks_stream,
}
