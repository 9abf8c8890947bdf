"""Text forms of lists, and a stable way to spread ids over lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What Python does not print as it is: controls, formats, unassigned and private code points, and
# separators other than the space (Java syntax).
_UNPRINTED = r"[\p{C}\p{Z}&&[^ ]]"


def _code_point(char: Column) -> Column:
    """The escape of one character that is not printed: two, four or eight hex digits."""
    code = F.ascii(char)
    digits = F.lower(F.hex(code))
    return (
        F.when(code < 0x100, F.concat(F.lit("\\x"), F.lpad(digits, 2, "0")))
        .when(code < 0x10000, F.concat(F.lit("\\u"), F.lpad(digits, 4, "0")))
        .otherwise(F.concat(F.lit("\\U"), F.lpad(digits, 8, "0")))
    )


def _python_literal(item: Column) -> Column:
    text = F.replace(item, F.lit("\\"), F.lit("\\\\"))
    for raw, escaped in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    escaped = F.transform(
        F.split(text, ""), lambda c: F.when(c.rlike(_UNPRINTED), _code_point(c)).otherwise(c)
    )
    text = F.when(text.rlike(_UNPRINTED), F.array_join(escaped, "")).otherwise(text)
    has_single, has_double = F.contains(item, F.lit("'")), F.contains(item, F.lit('"'))
    return F.when(has_single & ~has_double, F.concat(F.lit('"'), text, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("\\'")), F.lit("'"))
    )


def list_text(items: Column, style: str = "json") -> Column:
    """An array of strings as JSON text or as a Python list literal.

    Which code points are assigned at all depends on the Unicode version of the Java in use; for
    newer ones the literal has an escape where Python may have the character. It reads back the same.
    """
    if style == "json":
        return F.to_json(items)
    if style == "python":
        return F.concat(F.lit("["), F.array_join(F.transform(items, _python_literal), ", "), F.lit("]"))
    raise ValueError(f"unknown list style {style!r}")


def line_of(key: Column, lines: Column) -> Column:
    """A line number in ``[0, lines)`` that depends only on ``key`` (first 32 bits of its MD5)."""
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint"), lines)
