from tierflow.operators.audit import load_tally, missing_sources
from tierflow.operators.incremental import (
    latest_batch,
    newer_than,
    one_per_key,
    replaced_by_key,
    rows_absent,
    rows_present,
)
from tierflow.operators.joins import join_per_key, left_join_any, left_join_any_located, left_join_hot, located
from tierflow.operators.jsonpack import json_document, json_report, json_row, json_rows
from tierflow.operators.shape import market_fallback, prefixed, require_key, to_silver
from tierflow.operators.wide import nest_gold, nested_union, wide_union

__all__ = [
    "join_per_key",
    "json_document",
    "json_report",
    "json_row",
    "json_rows",
    "latest_batch",
    "left_join_any",
    "left_join_any_located",
    "left_join_hot",
    "load_tally",
    "located",
    "market_fallback",
    "missing_sources",
    "nest_gold",
    "nested_union",
    "newer_than",
    "one_per_key",
    "prefixed",
    "replaced_by_key",
    "require_key",
    "rows_absent",
    "rows_present",
    "to_silver",
    "wide_union",
]
