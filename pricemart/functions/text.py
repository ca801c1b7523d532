"""Text and number rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: what may stand around the 32 hexadecimal digits of a UUID
UUID_PREFIXES = "urn:|uuid:"
UUID_MARKS = "^[{}]+|[{}]+$|-"


def number_text(value: Column, kind: T.DataType) -> Column:
    """A number as plain decimal text without trailing zeros; null stays null."""
    text = value.cast("string")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        # numbers that no such decimal holds are shown as they are, with an exponent
        text = F.coalesce(value.try_cast("decimal(38,12)").cast("string"), text)
    plain = text.contains(".") & ~text.contains("E")
    return F.when(plain, F.regexp_replace(text, "\\.?0+$", "")).otherwise(text)


def two_decimals(value: Column) -> Column:
    """A number with two decimals, halves rounded to even; one that no decimal(38,16) holds as it is."""
    rounded = F.bround(value.try_cast("decimal(38,16)"), 2).cast("decimal(38,2)").cast("string")
    return F.coalesce(rounded, value.cast("string"))


def or_none(text: Column) -> Column:
    """Report text of an optional value."""
    return F.coalesce(text.cast("string"), F.lit("None"))


def stripped(text: Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def normal_symbol(symbol: Column) -> Column:
    """Symbols compare stripped and in upper case."""
    return F.upper(stripped(symbol))


def is_uuid(text: Column) -> Column:
    """Whether text is a UUID, with or without dashes, braces or a URN prefix, in either case."""
    digits = F.regexp_replace(F.regexp_replace(text, UUID_PREFIXES, ""), UUID_MARKS, "")
    return F.coalesce(digits.rlike("^[0-9a-fA-F]{32}$"), F.lit(False))


def stable_id(*parts: Column) -> Column:
    """A UUID-shaped id computed from ``parts``: the same again when a lost task is rerun."""
    digest = F.sha2(F.concat_ws("\u001f", *(F.coalesce(p.cast("string"), F.lit("\u0000")) for p in parts)), 256)
    return F.concat_ws(
        "-", *(F.substring(digest, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    )


def snippet(text: Column, size: int = 220) -> Column:
    """One line of at most ``size`` characters; longer text ends in three dots."""
    line = stripped(F.regexp_replace(text, "\n", " "))
    return F.when(F.length(line) > size, F.concat(F.substring(line, 1, size - 3), F.lit("..."))).otherwise(line)
