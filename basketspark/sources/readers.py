"""Readers for the five source relations of the job.

The job reads web hits, visit sessions, products, the SKU-to-group map and invoices.
Each is a plain DataFrame; this module only resolves where it comes from (a DataFrame,
a catalog table, a parquet folder or a JDBC table) and renames columns to the names the
operators bind to. Projections and predicates are applied by the operators, so Catalyst
pushes them into the scan (``PushedFilters`` / ``ReadSchema``) or into the JDBC query.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Column names used by the operators, per relation.
CANONICAL_COLUMNS = {
    "hits": ("visit_return_count", "post_visid_combined", "time_stamp", "dt_key", "prod_list", "demandbase"),
    "visit_sessions": ("visit_return_count", "post_visid_combined", "visit_session_key"),
    "products": ("sku", "stk_type_cd"),
    "prod_feature": ("sku_nbr", "size_grp"),
    "invoices": ("sku", "amt", "dt_key"),
}

def load(spark: SparkSession, ref: DataFrame | str, fmt: str = "parquet") -> DataFrame:
    """Resolve a source: a DataFrame as is, a path (read with ``fmt``) or a table name."""
    if isinstance(ref, DataFrame):
        return ref
    if "/" in ref or ref.endswith(".parquet"):
        return spark.read.format(fmt).load(ref)
    return spark.read.table(ref)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    column: str | None = None,
    lower: int | str | None = None,
    upper: int | str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """A JDBC table; filters and projections applied later are pushed into its query.

    With ``column`` (numeric, date or timestamp), bounds and a number of partitions, that many
    tasks read ranges of the column; the bounds only set the stride, no row is left out.
    """
    given = [v is not None for v in (column, lower, upper, partitions)]
    if any(given) != all(given):
        raise ValueError("a partitioned read needs column, lower, upper and partitions")
    split = dict(column=column, lowerBound=lower, upperBound=upper, numPartitions=partitions) if column else {}
    return spark.read.jdbc(url, table, properties=dict(properties or {}), **split)


def _rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


@dataclasses.dataclass(frozen=True)
class Sources:
    """The five inputs of the job, with canonical column names."""

    hits: DataFrame
    visit_sessions: DataFrame
    products: DataFrame
    prod_feature: DataFrame
    invoices: DataFrame

    @classmethod
    def from_refs(
        cls,
        spark: SparkSession,
        refs: Mapping[str, DataFrame | str],
        columns: Mapping[str, Mapping[str, str]],
        fmt: str = "parquet",
    ) -> "Sources":
        """``columns`` maps, per relation, the source's own column names to those above."""
        frames = {}
        for name in CANONICAL_COLUMNS:
            df = _rename(load(spark, refs[name], fmt), columns.get(name, {}))
            missing = [c for c in CANONICAL_COLUMNS[name] if c not in df.columns]
            if missing:
                raise ValueError(f"source {name!r} lacks columns {missing}")
            frames[name] = df
        return cls(**frames)
