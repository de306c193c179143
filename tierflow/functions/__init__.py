from tierflow.functions.scalars import (
    date_stamp,
    file_stem,
    market_codes,
    numeric_text,
    numeric_text_sql,
    safe_numeric,
    safe_numeric_sql,
    split_literal,
    uri_text,
)
from tierflow.functions.variants import (
    field_text,
    is_array,
    is_object,
    is_truthy,
    field_or_blank,
    value_text,
)

__all__ = [
    "date_stamp",
    "field_or_blank",
    "field_text",
    "file_stem",
    "is_array",
    "is_object",
    "is_truthy",
    "market_codes",
    "numeric_text",
    "numeric_text_sql",
    "safe_numeric",
    "safe_numeric_sql",
    "split_literal",
    "uri_text",
    "value_text",
]
