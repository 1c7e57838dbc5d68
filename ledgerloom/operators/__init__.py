"""Reusable DataFrame operators."""

from ledgerloom.operators.calendar import calendar, date_spine
from ledgerloom.operators.first import first_per_key, with_values
from ledgerloom.operators.history import each_month, months_of, spells, to_date_by_month
from ledgerloom.operators.incremental import (
    absent_rows,
    child_values,
    insert_if_absent,
    orphans,
    without_parent,
)
from ledgerloom.operators.quantiles import bucket_ends, place
from ledgerloom.operators.ranking import ranked, tile, with_row_ids

__all__ = [
    "absent_rows",
    "bucket_ends",
    "calendar",
    "child_values",
    "date_spine",
    "each_month",
    "first_per_key",
    "insert_if_absent",
    "months_of",
    "orphans",
    "place",
    "ranked",
    "spells",
    "tile",
    "to_date_by_month",
    "with_row_ids",
    "with_values",
    "without_parent",
]
