"""Column expressions shared by all layers.  All are built-ins, so they stay in codegen."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from tierflow.specs import NUMERIC

# Date patterns of landed batches and archive folders.
STAMP_PATTERNS = {
    "day": "yyyyMMdd",
    "second": "yyyyMMdd_HHmmss",
    "folder": "yyyy-MM-dd",
}


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_literal(c: Column | str, delimiter: str) -> Column:
    """Split on a literal delimiter (Spark's own ``split`` takes a regex)."""
    return F.split(_column(c), re.escape(delimiter))


def file_stem(path: Column | str) -> Column:
    """Last path segment, cut at its first dot; NULL parts stay NULL."""
    last_segment = F.get(F.reverse(split_literal(path, "/")), F.lit(0))
    return F.get(split_literal(last_segment, "."), F.lit(0))


def uri_text(path: Column | str) -> Column:
    """A ``_metadata.file_path`` URI as plain text.

    The URI escapes blanks but leaves ``+`` bare, which ``url_decode`` would read
    as a blank; so ``+`` is escaped first.
    """
    return F.url_decode(F.replace(_column(path), F.lit("+"), F.lit("%2B")))


def safe_numeric(c: Column | str) -> Column:
    """decimal(38,9), NULL where the text is no number."""
    return _column(c).try_cast(NUMERIC)


def safe_numeric_sql(sql: str) -> str:
    """``safe_numeric`` as SQL text, for wide projections built in one go."""
    return f"try_cast({sql} as {NUMERIC.simpleString()})"


def numeric_text_sql(sql: str) -> str:
    """A decimal as plain text without trailing zeros: 12, 19.4, 0.

    Whole numbers go through bigint, which is several times faster than trimming
    text.  Below a millionth, the cast alone gives ``1E-9`` in a session without
    ANSI mode; then those few digits are written out.
    """
    n = f"cast({sql} as {NUMERIC.simpleString()})"
    whole = f"try_cast({n} as bigint)"
    digits = f"lpad(cast(cast(abs({n}) * 1000000000 as bigint) as string), 9, '0')"
    return (
        f"case when {whole} = {n} then cast({whole} as string) "
        f"when {n} between -0.000001 and 0.000001 "
        f"then rtrim('0', concat(if({n} < 0, '-0.', '0.'), {digits})) "
        f"else rtrim('.', rtrim('0', cast({n} as string))) end"
    )


def numeric_text(name: str) -> Column:
    """``numeric_text_sql`` of a column name or other SQL text."""
    return F.expr(numeric_text_sql(name))


def market_codes(code: Column | str) -> tuple[Column, Column]:
    """(two-letter code, three-letter code) of a market code, by trimmed length."""
    trimmed = F.trim(_column(code))
    return (
        F.when(F.length(trimmed) == 2, trimmed),
        F.when(F.length(trimmed) == 3, trimmed),
    )


def date_stamp(ts: Column | str, kind: str = "day") -> Column:
    """Timestamp as the stamp used in file names (``day``, ``second``) or folders."""
    return F.date_format(_column(ts), STAMP_PATTERNS[kind])
