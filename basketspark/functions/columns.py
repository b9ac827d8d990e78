"""Scalar column expressions.

All are built from ``pyspark.sql.functions`` so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed pattern: the account number is the text before the first pipe.
_ACCOUNT_PATTERN = r"^([^|]*)[|]"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_key_of(ts: Column | str) -> Column:
    """YYYYMMDD integer key of a date or timestamp."""
    ts = _c(ts)
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def trimmed(c: Column | str) -> Column:
    """Strip leading and trailing spaces."""
    return F.trim(_c(c))


def normalised_list(c: Column | str) -> Column:
    """Upper-cased, trimmed comma list of products."""
    return F.upper(F.trim(_c(c)))


def account_no(demandbase: Column | str) -> Column:
    """Account number: text before the first pipe of the trimmed field, trimmed again.

    A field without a pipe gives the empty string, so the hit is later dropped.
    """
    return F.trim(F.regexp_extract(F.trim(_c(demandbase)), _ACCOUNT_PATTERN, 1))


def confidence(n_xy: Column | str, n_x: Column | str) -> Column:
    """P(Y | X) = baskets with X and Y / baskets with X."""
    return _c(n_xy) / _c(n_x)


def lift(conf: Column | str, n_y: Column | str, n_total: Column | str) -> Column:
    """confidence / P(Y), written in the order ``conf / n_y * N`` (keeps doubles stable)."""
    return _c(conf) / _c(n_y) * _c(n_total)


def support(n_xy: Column | str, n_total: Column | str) -> Column:
    """P(X and Y) = baskets with X and Y / all baskets."""
    return _c(n_xy) / _c(n_total)


def cvm_score(sku_count_y: Column | str, conf: Column | str) -> Column:
    """Ranking score of a recommended SKU: its basket count times the group confidence."""
    return _c(sku_count_y) * _c(conf)
