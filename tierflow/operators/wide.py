"""One wide table over all sources, flat or nested.  No step shuffles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from tierflow.functions import numeric_text_sql, safe_numeric_sql
from tierflow.specs import (
    FILE_NAME,
    GOLD_STRUCTS,
    LOAD_TS,
    RANKING_OWNER,
    WIDE_COLUMNS,
    WIDE_NUMERIC,
    metadata_label,
)

TAG = "source_table"


def _as_text(field: T.StructField) -> str:
    if isinstance(field.dataType, T.DecimalType):
        return numeric_text_sql(f"`{field.name}`")
    return f"cast(`{field.name}` as string)"


def wide_union(frames: dict[str, DataFrame], columns: tuple[str, ...] = WIDE_COLUMNS) -> DataFrame:
    """All frames under one text schema plus the tag they came from.

    Columns are matched by name (letter case aside); what a frame lacks is NULL.
    """

    def widen(tag: str, df: DataFrame) -> DataFrame:
        own = {f.name.lower(): f for f in df.schema}
        cells = [
            f"{_as_text(own[c.lower()]) if c.lower() in own else 'cast(null as string)'} as `{c}`"
            for c in columns
        ]
        return df.selectExpr(*cells, f"'{tag}' as {TAG}")

    return reduce(DataFrame.union, [widen(tag, df) for tag, df in frames.items()])


def nest_gold(df: DataFrame, tags: tuple[str, ...], guarded: bool = False) -> DataFrame:
    """Pack wide rows into the eleven Gold structs and the tag.

    Every struct is filled from its columns whatever the row's source, so the
    ranking structs of one ranking row all show it.  ``guarded=True`` leaves the
    ranking structs of other sources NULL.

    The projection is given as SQL text: as Column calls, its several hundred
    cells would take longer to build than to run.
    """
    have = {f.name.lower(): f for f in df.schema}

    def cell(wide: str) -> str:
        field = have.get(wide)
        if wide in WIDE_NUMERIC:
            if field is None:
                return safe_numeric_sql("null")
            typed = isinstance(field.dataType, T.DecimalType)
            return f"`{field.name}`" if typed else safe_numeric_sql(f"`{field.name}`")
        return "cast(null as string)" if field is None else _as_text(field)

    def packed(struct: str) -> str:
        value = ", ".join(f"{cell(wide)} as {name}" for name, wide in GOLD_STRUCTS[struct])
        value = f"struct({value})"
        if guarded and struct in RANKING_OWNER:
            value = f"case when {TAG} = '{RANKING_OWNER[struct]}' then {value} end"
        return f"{value} as {struct}"

    def routed(value: str, suffix: str) -> list[str]:
        return [
            f"case when {TAG} = '{tag}' then {value} end as {metadata_label(tag)}_{suffix}"
            for tag in tags
        ]

    metadata = routed(FILE_NAME, FILE_NAME) + routed(f"cast({LOAD_TS} as timestamp)", LOAD_TS)
    return df.selectExpr(
        *[packed(s) for s in GOLD_STRUCTS], f"struct({', '.join(metadata)}) as METADATA", TAG
    )


def nested_union(frames: dict[str, DataFrame], guarded: bool = False) -> DataFrame:
    """``nest_gold(wide_union(frames))``, nesting each typed frame before the union.

    The result is the same, but numbers and timestamps are not turned into text
    and parsed back, and each branch knows its tag, so its other METADATA fields
    are constant NULLs instead of a CASE per row.
    """
    tags = tuple(frames)
    nested = [
        nest_gold(df.withColumn(TAG, F.lit(tag)), tags, guarded) for tag, df in frames.items()
    ]
    return reduce(DataFrame.union, nested)
