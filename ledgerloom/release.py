"""Releases: one small file names the folders of a whole set of tables.

A build writes new folders beside the old ones; readers see them only when a release names
them, all at once. Releases are numbered and created only if the number is free, the last one
counts. Folders that no remaining release names are removed after a time of grace, in which
readers of an earlier release may finish.
"""

from __future__ import annotations

import json
import time
from collections.abc import Mapping
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerloom.scratch import create_file, delete_folder, list_folder, read_file

# Numbers taken meanwhile by others before this one gives up.
ATTEMPTS = 20


def _folder(root: str) -> str:
    return f"{root}/_releases"


def _released(spark: SparkSession, root: str) -> dict[int, float]:
    """Time of change of each release, by number."""
    found = list_folder(spark, _folder(root))
    return {int(n.removesuffix(".json")): t for n, t in found if n.endswith(".json")}


def _content(spark: SparkSession, root: str, number: int) -> dict[str, dict]:
    """Path, below the root, and schema of each table."""
    text = read_file(spark, f"{_folder(root)}/{number:012}.json")
    return json.loads(text) if text else {}


def publish(spark: SparkSession, root: str, tables: Mapping[str, tuple[str, DataFrame]]) -> int:
    """Make ``tables`` (name -> path below the root, frame) what readers get; its number."""
    content = {
        name: {"path": path, "schema": df.schema.json()} for name, (path, df) in tables.items()
    }
    for _ in range(ATTEMPTS):
        number = max(_released(spark, root), default=-1) + 1
        if create_file(spark, f"{_folder(root)}/{number:012}.json", json.dumps(content)):
            return number
    raise RuntimeError(f"other releases came first {ATTEMPTS} times")


def open_release(spark: SparkSession, root: str, number: int | None = None) -> dict[str, DataFrame]:
    """The tables of a release, by default the last whole one."""
    for n in sorted(_released(spark, root), reverse=True):
        if number is not None and n != number:
            continue
        # A release whose file is still being written is empty: the one before counts.
        if content := _content(spark, root, n):
            return {name: _table(spark, root, **entry) for name, entry in content.items()}
    raise FileNotFoundError(f"no release in {root}")


def _table(spark: SparkSession, root: str, path: str, schema: str) -> DataFrame:
    kind = StructType.fromJson(json.loads(schema))
    return spark.read.schema(kind).parquet(f"{root}/{path}").select(*kind.fieldNames())


def remove_old(
    spark: SparkSession, root: str, older_than: timedelta = timedelta(days=7)
) -> list[str]:
    """Remove releases that were replaced longer than ``older_than`` ago, and folders of
    versions that no remaining release names, if as old; the folders removed.

    ``older_than`` must exceed the longest build and the longest query.
    """
    before = time.time() - older_than.total_seconds()
    released = _released(spark, root)
    numbers = sorted(released)
    gone = [n for n, after in zip(numbers, numbers[1:]) if released[after] < before]
    kept = [_content(spark, root, n) for n in numbers if n not in gone]
    live = {entry["path"] for content in kept for entry in content.values()}
    removed = []
    for table in sorted({path.rsplit("/", 1)[0] for path in live}):
        for version, changed in list_folder(spark, f"{root}/{table}"):
            if f"{table}/{version}" not in live and changed < before:
                delete_folder(spark, f"{root}/{table}/{version}")
                removed.append(f"{table}/{version}")
    for n in gone:
        delete_folder(spark, f"{_folder(root)}/{n:012}.json")
    return removed
