"""Small helpers over VARIANT, used to read API responses of varying shape.

VARIANT keeps what a fixed schema loses: whether a key is absent or null, and
whether a value is a list, an object, a number or text.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def is_object(v: Column) -> Column:
    # Cheaper than schema_of_variant, which describes the whole value.
    return F.try_variant_get(v, "$", "struct<>").isNotNull()


def is_array(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>").isNotNull()


def field_text(v: Column, path: str) -> Column:
    """The value under a dotted path as text (see ``value_text``); NULL if absent or null."""
    return value_text(F.try_variant_get(v, f"$.{path}", "variant"))


def value_text(x: Column) -> Column:
    """A value as the extractor's CSV writer spells it.

    Text and whole numbers as they are, ``True`` and ``False``, and a number with a point
    or an exponent with at least one decimal (``5.0``, ``1000.0``) or, where it is very
    large or small, an exponent (``1e+16``).  Lists and objects stay JSON.  VARIANT itself
    does not tell ``-0.0`` from ``0.0``, nor a number of 19 digits before a bare ``.0``
    from a whole one.
    """
    text = F.try_variant_get(x, "$", "string")
    kind = F.schema_of_variant(x)
    point = kind.startswith("D")  # DECIMAL or DOUBLE
    # Rare and long: as a function over an array it stays out of the generated code.
    number = F.get(F.transform(F.array(x), _point_text), F.lit(0))
    return F.when(point, number).when(kind == "BOOLEAN", F.initcap(text)).otherwise(text)


def _point_text(x: Column) -> Column:
    text, double = F.try_variant_get(x, "$", "string"), F.try_variant_get(x, "$", "double")
    # A decimal of 19 digits and no point is a whole number too long for 64 bits.
    digits = F.length(F.regexp_replace(text, "[^0-9]", ""))
    decimal, whole = F.schema_of_variant(x) != "DOUBLE", ~F.contains(text, F.lit("."))
    exact = (digits <= 15) & ((F.abs(double) >= 1e-4) | (text == "0"))
    return (
        F.when(decimal & whole & (digits >= 19), text)
        .when(decimal & exact, F.when(whole, F.concat(text, F.lit(".0"))).otherwise(text))
        .otherwise(double_text(double))
    )


def double_text(d: Column) -> Column:
    """A double with a point below 1e16 and from 1e-4 on, else with an exponent of two digits at least."""
    java = d.cast("string")
    size = F.abs(d)
    plain = F.regexp_replace(java.try_cast("decimal(38,21)").cast("string"), r"(\.[0-9]+?)0+$", "$1")
    mantissa = F.regexp_replace(F.split_part(java, F.lit("E"), F.lit(1)), r"\.0$", "")
    power = F.split_part(java, F.lit("E"), F.lit(2)).try_cast("int")
    sign = F.when(power < 0, F.lit("-")).otherwise(F.lit("+"))
    return (
        F.when(F.isnan(d) | size.isin(float("inf")), F.replace(F.lower(java), F.lit("infinity"), F.lit("inf")))
        .when((size == 0) | ((size >= 1e-3) & (size < 1e7)), java)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(F.concat(mantissa, F.lit("e"), sign, F.lpad(F.abs(power).cast("string"), F.greatest(F.length(F.abs(power).cast("string")), F.lit(2)), F.lit("0"))))
    )


def has_field(v: Column, path: str) -> Column:
    """True if the key is there at all, even with a null value."""
    return F.try_variant_get(v, f"$.{path}", "variant").isNotNull()


def field_or_blank(v: Column, path: str) -> Column:
    """As ``field_text`` with ``''`` for an absent key; an explicit null stays NULL."""
    return F.when(has_field(v, path), field_text(v, path)).otherwise(F.lit(""))


def elements(v: Column, path: str) -> Column:
    """The list under a path as ``array<variant>``; NULL if it is no list."""
    return F.try_variant_get(v, f"$.{path}", "array<variant>")


def is_truthy(v: Column) -> Column:
    """False for null, 0, false and ''; the text '0' counts as a value."""
    kind = F.schema_of_variant(v)
    return (
        F.when(kind == "VOID", F.lit(False))
        .when(kind == "STRING", F.try_variant_get(v, "$", "string") != "")
        .when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
        .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), ~F.to_json(v).isin("{}", "[]"))
        .otherwise(F.try_variant_get(v, "$", "double") != 0)
    )
