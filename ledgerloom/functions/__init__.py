"""Column expressions; everything runs inside the JVM, no Python UDFs."""

from ledgerloom.functions.dates import date_key, month_of, parse_invoice_time
from ledgerloom.functions.labels import customer_segment, segment_movement, segment_transition
from ledgerloom.functions.text import (
    ADMIN_CODES,
    hex_bytes,
    hex_text,
    is_sellable,
    normal_code,
    surrogate_key,
    real_number,
    whole_number,
)

__all__ = [
    "ADMIN_CODES",
    "customer_segment",
    "date_key",
    "hex_bytes",
    "hex_text",
    "is_sellable",
    "month_of",
    "normal_code",
    "parse_invoice_time",
    "segment_movement",
    "segment_transition",
    "surrogate_key",
    "real_number",
    "whole_number",
]
