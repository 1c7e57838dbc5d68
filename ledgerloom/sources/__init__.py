"""Reading raw files, reference lists and sample tables."""

from ledgerloom.sources.raw_csv import RawLoad, append_raw, load_raw, scan_raw
from ledgerloom.sources.sample import sample_countries, sample_raw
from ledgerloom.sources.seed import default_countries, read_countries

__all__ = [
    "RawLoad",
    "append_raw",
    "default_countries",
    "load_raw",
    "read_countries",
    "sample_countries",
    "sample_raw",
    "scan_raw",
]
