"""Casts that give NULL for text they cannot read, whatever the session's ANSI mode."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.schema import MONEY


def lenient_long(text: Column) -> Column:
    """Text to bigint; a decimal fraction is cut off (``'1.7'`` gives 1)."""
    whole = F.regexp_replace(text, r"\.[0-9]*\s*$", "")
    return F.coalesce(text.try_cast("bigint"), whole.try_cast("bigint"))


def lenient_double(text: Column) -> Column:
    return text.try_cast("double")


def lenient_boolean(text: Column) -> Column:
    return text.try_cast("boolean")


def fits_money(number: Column) -> Column:
    """True when the number is absent or survives the exact decimal type."""
    return number.isNull() | number.try_cast(MONEY).isNotNull()
