"""Data-quality checks. Counts are collected with ``DataFrame.observe`` where the frame is
computed anyway, so a check does not add a job of its own.

Guards are checks inside a plan: the plan that writes a frame raises by itself, so a run that
violates a check fails before its write commits, and whoever writes the frame cannot forget the
check. ``checks`` turns what Spark then raises into the library's errors. A table that Spark
does not read at all, as the other side of a join turned out empty, is not checked either.
"""

from __future__ import annotations

import contextlib
import dataclasses
import re
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from basketspark.config import shift_key
from basketspark.errors import BasketError, CoverageError, DataValidityError, OutputOutOfBoundError

_MARK = "failed check "


def require_rows(df: DataFrame, error: type[Exception], message: str) -> None:
    """Raise when the frame is empty (reads at most one row)."""
    if df.isEmpty():
        raise error(message)


def confidence_bound_counts(matrix: DataFrame) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("pairs"),
        F.count_if(F.col("confidence") > 1.0).alias("confidence_above_1"),
        F.count_if(F.col("confidence") < 0.0).alias("confidence_below_0"),
    ]


def confidence_report(matrix: DataFrame) -> DataFrame:
    """One row: pairs, pairs with confidence > 1, pairs with confidence < 0."""
    return matrix.agg(*confidence_bound_counts(matrix))


def observe_confidence(matrix: DataFrame, name: str = "confidence_bounds") -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return matrix.observe(obs, *confidence_bound_counts(matrix)), obs


def check_confidence(values: dict) -> None:
    """Raise when the observed counts show pairs whose confidence is no probability."""
    for count, side in (("confidence_above_1", "above 1"), ("confidence_below_0", "below 0")):
        if values.get(count, 0):
            raise OutputOutOfBoundError(f"pair matrix: {values[count]} of {values.get('pairs', '?')} pairs have a confidence {side}")


def uncovered_days(df: DataFrame, key_col: str, window: tuple[int, int]) -> list[int]:
    """Of the two boundary days (one below the window, its last day) those that the table
    doesn't reach. Each is a filtered look for one row, which day partitions answer."""
    lo, hi = window
    first, last = shift_key(lo, -1), shift_key(hi, -1)
    key = F.col(key_col)
    return [day for day, side in ((first, key <= first), (last, key >= last)) if df.where(side).select(key_col).isEmpty()]


def coverage_report(df: DataFrame, key_col: str, window: tuple[int, int], table: str) -> DataFrame:
    """One row: does the table hold days from one day below the window to its last day?"""
    lo, hi = window
    need_lo, need_hi = shift_key(lo, -1), shift_key(hi, -1)
    return df.agg(
        F.lit(table).alias("table_name"),
        F.min(key_col).cast("bigint").alias("min_key"),
        F.max(key_col).cast("bigint").alias("max_key"),
    ).select(
        "table_name",
        "min_key",
        "max_key",
        F.lit(need_lo).cast("bigint").alias("required_lo"),
        F.lit(need_hi).cast("bigint").alias("required_hi"),
        F.coalesce((F.col("min_key") <= need_lo) & (F.col("max_key") >= need_hi), F.lit(False)).alias("covered"),
    )


def _mapped(prod_feature: DataFrame) -> DataFrame:
    return prod_feature.where(F.col("size_grp").isNotNull() & (F.col("size_grp") != "T"))


_NO_GROUPS = "group map: no SKU of the product features has a group other than 'T'"
_NO_SALES = "sales: no viewed SKU was invoiced inside the window"


def require_not_empty_map(prod_feature: DataFrame) -> None:
    """The product feature table must give some SKU a group (tested before the map is built)."""
    require_rows(_mapped(prod_feature), DataValidityError, _NO_GROUPS)


def require_sales(sales: DataFrame) -> None:
    require_rows(sales, OutputOutOfBoundError, _NO_SALES)


def check_sales(values: dict, name: str = "sku-sales") -> None:
    """Raise when the rows that were counted as the sales were written are none."""
    if not values[name]:
        raise OutputOutOfBoundError(_NO_SALES)


# --- guards ---


def _fail(error: type[BasketError], message: str) -> Column:
    return F.raise_error(F.lit(f"{_MARK}{error.__name__}: {message}"))


def _where_ok(df: DataFrame, tests: DataFrame, ok: str, error: type[BasketError], message: str) -> DataFrame:
    """``df``, unless ``ok`` of the one row of tests is false: the subquery raises when it is run,
    before the rows of the plan are, and also if there are none."""
    return df.where(tests.select(F.when(F.col(ok), F.lit(True)).otherwise(_fail(error, message)).alias("passed")).scalar())


def guard_rows(df: DataFrame, needed: DataFrame, error: type[BasketError], message: str) -> DataFrame:
    """``df``, whose plan fails if ``needed`` has no row."""
    some = needed.select(F.lit(1).alias("one")).limit(1).agg((F.count("one") > 0).alias("ok"))
    return _where_ok(df, some, "ok", error, message)


def guard_coverage(df: DataFrame, key_col: str, window: tuple[int, int], name: str) -> DataFrame:
    """``df``, whose plan fails if its days do not reach both ends of the window."""
    lo, hi = window
    first, last = shift_key(lo, -1), shift_key(hi, -1)
    out = df
    for day, side in ((first, F.col(key_col) <= first), (last, F.col(key_col) >= last)):
        out = guard_rows(out, df.where(side), CoverageError, f"{name}: no rows at or beyond day {day} for the window {lo} to {hi}")
    return out


def guard_confidence(matrix: DataFrame) -> DataFrame:
    """The matrix, whose plan fails at a confidence that is no probability."""
    value = F.col("confidence")
    bad = (value < 0.0) | (value > 1.0)
    return matrix.withColumn("confidence", F.when(bad, _fail(OutputOutOfBoundError, "pair matrix: a confidence outside 0 to 1")).otherwise(value))


def guard_sales(df: DataFrame, sku_sales: DataFrame) -> DataFrame:
    """``df``, whose plan fails if no SKU has sales."""
    return guard_rows(df, sku_sales, OutputOutOfBoundError, _NO_SALES)


def guard_sources(sources, cfg):
    """The sources with the checks on them in the plans of the tables that are read by days."""
    hits = guard_rows(sources.hits, _mapped(sources.prod_feature), DataValidityError, _NO_GROUPS)
    invoices = sources.invoices
    if cfg.check_coverage:
        hits = guard_coverage(hits, "dt_key", cfg.window, "hits")
        invoices = guard_coverage(invoices, "dt_key", cfg.window, "invoices")
    return dataclasses.replace(sources, hits=hits, invoices=invoices)


def _messages(error: BaseException) -> Iterator[str]:
    yield str(error)
    cause = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    while cause is not None:
        yield str(cause.getMessage())
        cause = cause.getCause()


@contextlib.contextmanager
def checks() -> Iterator[None]:
    """Raises the library's error where a guard failed inside the block."""
    try:
        yield
    except (PySparkException, Py4JJavaError) as error:
        known = {c.__name__: c for c in BasketError.__subclasses__()}
        for text in _messages(error):
            found = re.search(rf"{_MARK}(\w+): ([^\n]*)", text)
            if found and found[1] in known:
                raise known[found[1]](found[2]) from error
        raise
