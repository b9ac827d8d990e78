"""Column expressions shared by several steps (all JVM-side, no UDFs)."""

from basketspark.functions.columns import (
    account_no,
    confidence,
    cvm_score,
    day_key_of,
    lift,
    normalised_list,
    support,
    trimmed,
)

__all__ = [
    "account_no",
    "confidence",
    "cvm_score",
    "day_key_of",
    "lift",
    "normalised_list",
    "support",
    "trimmed",
]
