"""What arrived, what moved, what is missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def load_tally(df: DataFrame, by: str, ok: Column) -> DataFrame:
    """Moved and failed counts per ``by``, and a total row, which ``is_total`` marks."""
    failed = F.coalesce(~ok, F.lit(True))
    return df.rollup(by).agg(
        F.count_if(ok).alias("moved"),
        F.count_if(failed).alias("failed"),
        (F.grouping(by) == 1).alias("is_total"),
    )


def missing_sources(expected: DataFrame, loaded: DataFrame, key: str = "source") -> DataFrame:
    """Expected names with no loaded row; empty means everything arrived."""
    return expected.select(key).distinct().join(loaded.select(key).distinct(), key, "left_anti")
