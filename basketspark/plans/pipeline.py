"""The whole job: sources -> baskets -> pair matrix -> recommendations -> publish."""

from __future__ import annotations

import dataclasses
import logging
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from basketspark.config import RunConfig
from basketspark.errors import CoverageError
from basketspark.operators import affinity, clicks, publish, quality, recommend, sales
from basketspark.runtime import discard, materialize, recorded_scratch
from basketspark.sources.readers import Sources

log = logging.getLogger("basketspark")


class Job:
    """The frames of one job. Each is built when it is first asked for, with what it needs
    and nothing else. With ``pin`` the reused ones are written once to the shared
    checkpoint folder and ``counts`` has their rows, counted as they are written. With
    ``guards`` the checks are part of the plans, which fail before they commit."""

    def __init__(self, sources: Sources, cfg: RunConfig, pin: bool = True, guards: bool = False):
        self.sources, self.cfg, self.pin, self.guards = sources, cfg, pin, guards
        self.counts: dict[str, int] = {}
        if guards:
            self.sources = quality.guard_sources(sources, cfg)

    @cached_property
    def held(self) -> clicks.HeldBaskets:
        """The baskets as the job itself reads them."""
        return clicks.build_baskets(self.sources, self.cfg.window, self.cfg.max_groups_per_basket, self.pin, self.counts)

    @cached_property
    def _clicks(self):
        return clicks.build_clicks(self.sources, self.cfg.window, self.cfg.max_groups_per_basket, self.pin)

    @property
    def baskets(self) -> DataFrame:
        """The basket rows with every column of a click."""
        return self._clicks[0]

    @property
    def viewed(self) -> DataFrame:
        return self.held.viewed

    @property
    def keys(self) -> DataFrame:
        return self.held.keys

    @property
    def keyed_clicks(self) -> DataFrame:
        return self._clicks[3]

    @property
    def group_map(self) -> DataFrame:
        return self.held.group_map

    @cached_property
    def _sales(self):
        cfg = self.cfg
        return sales.build_sales(
            self.sources, cfg.window, self.viewed, self.keys, cfg.exclude_discontinued_sales, cfg.sales_group_join, self.pin, self.counts
        )

    @property
    def sku_sales(self) -> DataFrame:
        return self._sales[0]

    @property
    def group_sales(self) -> DataFrame:
        return self._sales[2]

    @cached_property
    def _counted(self) -> tuple[affinity.Affinity, Observation | None]:
        """The pair matrix as a plan that counts its confidence bounds when it is written."""
        cfg, held = self.cfg, self.held
        if cfg.pair_method == "blocks":
            totals = held.baskets.agg(F.count(F.lit(1)).alias("total_basket_count"))
            blocks = affinity.whole_blocks(held.baskets, cfg.max_groups_per_basket)
            aff = affinity.held_pair_matrix(blocks, held.names, totals, cfg.percentile_t, pin=self.pin)
        else:
            aff = affinity.pair_matrix(held.rows(), t=cfg.percentile_t, method=cfg.pair_method, pin=self.pin)
        if not self.pin:
            return aff, None
        matrix, observed = quality.observe_confidence(aff.matrix)  # counted while it is written
        matrix = quality.guard_confidence(matrix) if self.guards else matrix
        return dataclasses.replace(aff, matrix=matrix), observed

    @cached_property
    def affinity(self) -> affinity.Affinity:
        aff = self._counted[0]
        return dataclasses.replace(aff, matrix=materialize(aff.matrix, "pair-matrix")) if self.pin else aff

    @property
    def confidence_obs(self) -> Observation | None:
        return self._counted[1]

    @cached_property
    def pairs(self) -> DataFrame:
        """The confident pairs. Unless the matrix was written before, only they are: the whole matrix
        is made and counted on the way."""
        whole = not self.pin or "affinity" in self.__dict__
        matrix = (self.affinity if whole else self._counted[0]).matrix
        found = recommend.confident_pairs(matrix, self.group_sales, self.cfg.min_confidence)
        return found if whole else materialize(found, "confident-pairs")

    @cached_property
    def prod_views(self) -> DataFrame:
        found = recommend.held_sku_counts(self.held.items())
        return materialize(found, "sku-counts") if self.pin else found  # read by both sides of the pairs

    def _ranked(self, by_range: bool) -> DataFrame:
        rank = recommend.top_k_pruned if self.cfg.prune_candidates else recommend.rank_expanded
        return rank(self.pairs, self.prod_views, self.sku_sales, self.cfg.top_k, by_range)

    @cached_property
    def unnumbered(self) -> DataFrame:
        """The ranked SKU pairs."""
        return self._ranked(False)

    @cached_property
    def ranked(self) -> DataFrame:
        """The ranked SKU pairs as they are published: numbered and written once."""
        rows = self._ranked(by_range=self.pin)
        if self.guards and self.cfg.division == "LSG":
            rows = quality.guard_sales(rows, self.sku_sales)
        return publish.number_records(rows, self.counts, ranged=True) if self.pin else rows

    def output_rows(self, ranked: DataFrame) -> DataFrame:
        """What the files hold: a joined list per SKU, or (CCG) the ranked rows themselves."""
        return recommend.rec_lists(ranked) if self.cfg.publish_list else ranked.drop("record_id")

    @cached_property
    def lists(self) -> DataFrame:
        """``output_rows`` of the published rows; lists are written once, for all files."""
        rows = self.output_rows(self.ranked)
        return materialize(rows, "lists") if self.pin and self.cfg.publish_list else rows


def build(sources: Sources, cfg: RunConfig, pin: bool = True, guards: bool = False) -> Job:
    """The job's frames (no publishing; checks with ``guards`` only)."""
    return Job(sources, cfg, pin, guards)


def check_coverage(sources: Sources, cfg: RunConfig) -> None:
    for name, df in (("hits", sources.hits), ("invoices", sources.invoices)):
        missing = quality.uncovered_days(df, "dt_key", cfg.window)
        if missing:
            raise CoverageError(f"{name} has no rows at or beyond the days {missing} that the run needs")


def run(
    spark: SparkSession,
    sources: Sources,
    cfg: RunConfig,
    out_root: str | None = None,
    keep_frames: bool = True,
) -> tuple[Job | None, DataFrame | None, dict]:
    """Validate, compute and (with ``out_root``) publish. Returns job, detail, report.

    The checks are in the plans: coverage and the group map in those that read the hits and
    the invoices, the confidence bounds in the pair matrix, the sales in the ranked rows. All
    counts of the report are observed while frames are written. Without ``keep_frames`` what
    the run wrote to the checkpoint folder is deleted at its end,
    whether it succeeds or not, and no frames are returned.
    """
    with recorded_scratch() as written:
        try:
            with quality.checks():
                job, detail, report = _run(spark, sources, cfg, out_root)
            return (job, detail, report) if keep_frames else (None, None, report)
        finally:
            if not keep_frames:
                discard(spark, written)


def _run(spark: SparkSession, sources: Sources, cfg: RunConfig, out_root: str | None):
    job = build(sources, cfg, guards=True)
    if cfg.division == "LSG":
        job.sku_sales  # written before the pair matrix, its rows counted on the way
        quality.check_sales(job.counts)
    job.pairs  # the whole matrix is made, checked and counted as they are written
    report = dict(job.confidence_obs.get)
    job.ranked
    report.update(basket_rows=job.counts["baskets"], sku_sales_rows=job.counts["sku-sales"], published_rows=job.counts["index"])
    master_id = publish.reserve_run_id(spark, cfg, out_root) if out_root is not None else 1
    detail = publish.stamp_detail(job.ranked, master_id, cfg)
    report["master_id"] = master_id
    if out_root is not None:
        report["paths"], _ = publish.publish(spark, detail, job.lists, master_id, cfg, out_root)
    log.info("run %s: %s", cfg, report)
    return job, detail, report
