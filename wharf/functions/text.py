"""Text, bytes and time rendering."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Fixed value: full match of zero or more whitespace characters, non-breaking spaces excluded.
BLANK_PATTERN = r"\A\p{javaWhitespace}*\z"


def is_blank(c: Column) -> Column:
    """True for null, empty and whitespace-only text."""
    return c.isNull() | c.rlike(BLANK_PATTERN)


def utf8(c: Column) -> Column:
    """Bytes to text; invalid bytes become U+FFFD."""
    return F.make_valid_utf8(c.cast("string"))


def bytes_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.unhex(F.lit("")))


def instant_text(c: Column, kind: T.DataType) -> Column:
    """ISO instant text with 0, 3 or 6 fraction digits, independent of the session zone.

    Zone-less timestamps are read as UTC.
    """
    if isinstance(kind, T.TimestampType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        c = F.timestamp_add("MICROSECOND", F.unix_micros(c), epoch)
    text = c.cast("string")
    fraction = F.when(F.instr(text, ".") > 0, F.substring_index(text, ".", -1))
    return F.concat(
        F.replace(F.substring(text, 1, 19), F.lit(" "), F.lit("T")),
        F.when(fraction.isNull(), F.lit(""))
        .when(F.length(fraction) <= 3, F.concat(F.lit("."), F.rpad(fraction, 3, "0")))
        .otherwise(F.concat(F.lit("."), F.rpad(fraction, 6, "0"))),
        F.lit("Z"),
    )
