"""Column helpers over JSON text and VARIANT values.

A JSON value is handled as a VARIANT (one strict parse per record).  Its
coarse kind (``json_kind``) is one of BOOLEAN, BIGINT, DECIMAL(p,s), DOUBLE,
STRING, VOID (JSON null), OBJECT, ARRAY.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(v: Column, f) -> Column:
    """``f(v)`` with ``v`` evaluated once: a lambda variable stands for it.  Written
    out, an expression that uses a nested value several times (and the Java code
    made of it) would grow with the square of the depth."""
    return F.transform(F.array(v), f).getItem(0)


def decode_utf8(value: Column) -> Column:
    """Bytes -> text; malformed UTF-8 becomes U+FFFD."""
    return F.make_valid_utf8(value.cast("string"))


def blank_text(text: Column) -> Column:
    """Only JSON whitespace (space, tab, CR, LF): not a parse error but no value."""
    return text.rlike(r"^[ \t\r\n]*\z")


def json_kind(v: Column) -> Column:
    """The kind of a value.  Containers are told by what they convert to: the schema
    of a value is printed by a function that calls itself on every level."""
    return F.when(is_object(v), F.lit("OBJECT")).when(is_array(v), F.lit("ARRAY")).otherwise(F.schema_of_variant(v))


def is_json_null(v: Column) -> Column:
    """Absent (SQL NULL) or JSON null."""
    return v.isNull() | F.is_variant_null(v)


def is_object(v: Column) -> Column:
    # Casting to an empty struct only checks that the value is an object.
    return F.try_variant_get(v, "$", "struct<>").isNotNull()


def is_array(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>").isNotNull()


INTEGER_KINDS = ("TINYINT", "SMALLINT", "INT", "BIGINT")


def is_integer_kind(kind: Column) -> Column:
    return kind.isin(*INTEGER_KINDS)


def is_number_kind(kind: Column) -> Column:
    return kind.isin(*INTEGER_KINDS, "FLOAT", "DOUBLE") | kind.startswith("DECIMAL")


def jvm_number_text(v: Column, kind: Column) -> Column:
    """Text of a JSON number as the JVM prints the parsed node: integers as
    digits, other numbers as a double (``1.0``, ``1.0E10``).

    The variant keeps integers that fit 64 bits as BIGINT; a DECIMAL with
    scale 0 is either a float literal with a zero fraction (printed as a
    double) or an integer beyond 64 bits (printed as digits)."""
    as_double = F.try_variant_get(v, "$", "double").cast("string")
    digits = F.try_variant_get(v, "$", "string")
    zero_scale = kind.startswith("DECIMAL") & kind.endswith(",0)")
    fits_long = F.try_variant_get(v, "$", "bigint").isNotNull()
    return (F.when(is_integer_kind(kind), digits)
            .when(zero_scale & ~fits_long, digits)
            .otherwise(as_double))
