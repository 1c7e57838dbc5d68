"""Country names and their two-letter codes."""

from __future__ import annotations

import csv
from importlib import resources

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.schemas import COUNTRIES


def read_countries(spark: SparkSession, path: str) -> DataFrame:
    """A country list kept as CSV in shared storage; names may hold quoted commas."""
    return (
        spark.read.schema(COUNTRIES)
        .option("header", True)
        .option("escape", '"')
        .option("comment", "#")
        .csv(path)
    )


def default_countries(spark: SparkSession) -> DataFrame:
    """The list shipped with the package: fixed and small, so it travels with the plan.

    Made through Arrow, which gives the planner its size; rows handed over as Python
    tuples have none, and a join with them would shuffle the other side.
    """
    text = resources.files("ledgerloom.sources").joinpath("countries.csv").read_text("utf-8")
    lines = [line for line in text.splitlines() if not line.startswith("#")]
    rows = [r | {"id": int(r["id"])} for r in csv.DictReader(lines)]
    return spark.createDataFrame(pa.Table.from_pylist(rows), COUNTRIES)
