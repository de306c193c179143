"""Row-wise reshaping, driven by the source specs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierflow.functions import market_codes, safe_numeric_sql
from tierflow.specs import FILE_NAME, LOAD_TS, SourceSpec


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    """All columns under a prefix, so several sides can stand in one table."""
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in df.columns])


def to_silver(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Rename, type and default the Bronze columns of one source."""
    lineage = [c for c in (FILE_NAME, LOAD_TS) if c in df.columns]
    return df.selectExpr(*[f"{_silver_sql(spec, c)} as `{c}`" for c in spec.columns], *lineage)


def _silver_sql(spec: SourceSpec, name: str) -> str:
    value = f"`{spec.columns[name]}`"
    if name in spec.defaults:
        further, final = spec.defaults[name]
        value = f"coalesce({', '.join([value, *(f'`{c}`' for c in further), repr(final)])})"
    return safe_numeric_sql(value) if name in spec.numeric else value


def require_key(df: DataFrame, key: str) -> DataFrame:
    """Rows that have the key; the filter reaches the parquet scan."""
    return df.filter(F.col(key).isNotNull())


def market_fallback(df: DataFrame, code: str = "market_code") -> DataFrame:
    """Set both market codes: the dimension's if it matched, else the row's own."""
    own2, own3 = market_codes(code)
    return df.withColumns(
        {
            "market_code2": F.coalesce(F.col("alpha2"), own2),
            "market_code3": F.coalesce(F.col("alpha3"), own3),
        }
    )
