"""Text parsing, product codes and hashed keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes that book postage, fees and corrections rather than products.
ADMIN_CODES = ("B", "M", "POST", "DOT", "BANK CHARGES")

# Fixed value: stands in for a null part, so that null and '' hash differently.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"

# Fixed value: how a warehouse lets numbers be written.
NUMBER = (
    r"(?i)^\s*([+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?|[+-]?inf(inity)?|nan)\s*$"
)


def whole_number(text: Column) -> Column:
    """Text to INT, rounding half away from zero; null when not a number or out of range.

    A plain string-to-int cast rejects '2.5' and '1e2', which a warehouse accepts, so text
    it rejects goes through a decimal with room for ten whole digits, all an INT has. Digits
    only, the common case, never get there.
    """
    rounded = F.round(text.try_cast("decimal(38,28)")).try_cast("int")
    return F.coalesce(text.try_cast("int"), rounded)


def real_number(text: Column) -> Column:
    """Text to FLOAT; null when not a number. The cast alone also takes '5d' and '0x1p3'."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def normal_code(code: Column) -> Column:
    return F.upper(F.trim(code))


def is_sellable(code: Column) -> Column:
    """False for administrative codes, null for a null code: both fail a filter."""
    return ~normal_code(code).isin(*ADMIN_CODES)


def surrogate_key(*columns: str) -> Column:
    """MD5 over the columns as text, joined by '-'."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_KEY_PART)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def hex_bytes(text: Column) -> Column:
    """What lower-case hexadecimal digits stand for, in half the space; null for other text."""
    found = F.unhex(text)
    return F.when(F.lower(F.hex(found)) == text, found)


def hex_text(found: Column) -> Column:
    return F.lower(F.hex(found))
