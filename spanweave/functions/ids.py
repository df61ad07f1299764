"""Identifier expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_hex(col: Column) -> Column:
    return F.coalesce(col.rlike("^[0-9a-fA-F]+$"), F.lit(False))


def hex_to_long(col: Column) -> Column:
    """Hex text to the signed value of its low 64 bits; null when the text is no hex number.

    `conv` saturates (or raises) above 64 bits, so only the last 16 digits are handed to it.
    """
    return F.when(is_hex(col), F.conv(F.right(col, F.lit(16)), 16, -10).cast("bigint"))


def long_to_hex(col: Column) -> Column:
    """The inverse, as the tracing backend writes ids: 16 lower-case digits."""
    return F.lpad(F.lower(F.hex(col)), 16, "0")


def normalize_trace_id(col: Column) -> Column:
    """Pad to 32 digits.  Longer ids stay whole; blanks of a padded id become zeros too."""
    padded = F.translate(F.lpad(col, 32, "0"), " ", "0")
    return F.when(F.length(col) < 32, padded).otherwise(col)
