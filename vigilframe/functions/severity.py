"""Severity ranks and the severity threshold predicate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Higher is worse, anything else ranks 0.
SEVERITY_RANK = {"low": 1, "medium": 2, "high": 3, "critical": 4}


def severity_rank(severity: Column) -> Column:
    lowered = F.lower(severity)
    rank = F.lit(0)
    for name, value in SEVERITY_RANK.items():
        rank = F.when(lowered == name, F.lit(value)).otherwise(rank)
    return rank


def severity_at_least(severity: Column, threshold: str = "medium", mode: str = "ordinal") -> Column:
    """True where a severity reaches `threshold`.

    `ordinal` compares ranks.  `lexical` compares the lower-cased words as strings: with
    "medium" it keeps "unknown" and drops "critical" and "high".
    """
    if mode == "ordinal":
        if threshold.lower() not in SEVERITY_RANK:
            raise ValueError(f"unknown severity threshold: {threshold}")
        return severity_rank(severity) >= F.lit(SEVERITY_RANK[threshold.lower()])
    if mode == "lexical":
        return F.coalesce(F.lower(severity), F.lit("")) >= F.lit(threshold.lower())
    raise ValueError(f"unknown severity mode: {mode}")
