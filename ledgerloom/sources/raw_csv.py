"""Error-tolerant load of raw CSV files."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.schemas import RAW, RAW_COLUMNS
from ledgerloom.scratch import STORED, create_file, delete_folder, list_folder, read_file

BAD_LINE = "_bad_line"
# Where a rejected line comes from and what is wrong with it; null for good rows.
PROVENANCE = {"file": "string", "block_start": "long", "fields": "integer", "reason": "string"}
FEW, MANY, UNREADABLE = "too few fields", "too many fields", "unreadable"
# Appends started again because others finished meanwhile.
ATTEMPTS = 5


@dataclass(frozen=True)
class RawLoad:
    """Rows that parsed, and the lines that did not.

    ``rejections`` has them with their origin: ``file``, ``block_start`` (the byte at which the
    piece of the file that holds the line begins), ``fields``, ``reason`` and ``line``.
    """

    rows: DataFrame
    rejects: DataFrame
    rejections: DataFrame

    def counts(self) -> DataFrame:
        """``(loaded, rejected)`` in one row."""
        loaded = self.rows.agg(F.count("*").alias("loaded"))
        rejected = self.rejects.agg(F.count("*").alias("rejected"))
        return loaded.select("loaded", rejected.scalar().alias("rejected"))

    def rejections_by_file(self) -> DataFrame:
        """How many lines of each file were rejected, by reason."""
        return self.rejections.groupBy("file", "reason").agg(F.count("*").alias("lines"))


def scan_raw(
    spark: SparkSession,
    folder: str | list[str],
    header: bool = True,
    encoding: str = "UTF-8",
) -> DataFrame:
    """Every ``*.csv`` in ``folder``, or the files named, as text; lines with too few or too many fields
    keep their source text in ``_bad_line``."""
    if isinstance(folder, str) and csv_files(spark, folder).isEmpty():
        raise FileNotFoundError(f"no CSV files in {folder}")
    schema = T.StructType([*RAW.fields, T.StructField(BAD_LINE, T.StringType())])
    reader = (
        spark.read.schema(schema)
        .option("header", header)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_LINE)
        # With pruning the parser skips unread fields and would miss short lines.
        .option("columnPruning", "false")
        .option("pathGlobFilter", "*.csv")
    )
    return reader.csv(folder)


def field_count(line: Column) -> Column:
    """Fields of a CSV line; commas between quotes do not count."""
    plain = F.regexp_replace(line, r'"([^"]|"")*"', "")
    return F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit(""))) + 1


FOUND = "path string, size long, modified long"


def csv_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, size, modified) of every ``*.csv``; contents are not read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
    try:
        found = listed.load(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no folder {folder}") from e
    return found.select(
        "path",
        F.col("length").alias("size"),
        F.unix_micros("modificationTime").alias("modified"),
    )


def load_raw(
    spark: SparkSession,
    folder: str,
    target: str,
    header: bool = True,
    encoding: str = "UTF-8",
) -> RawLoad:
    """Parse all files once, in place of what ``target`` held, into a table at ``target``, split by whether the line was good.

    Good rows and rejects are then separate folders of a columnar table, so counting or
    reading either one does not parse the text again.
    """
    parsed = _split(scan_raw(spark, folder, header, encoding))
    writer = parsed.write.options(**STORED).mode("overwrite")
    writer.partitionBy("rejected").parquet(target)
    return _stored(spark, [target])


def append_raw(
    spark: SparkSession,
    folder: str,
    target: str,
    header: bool = True,
    encoding: str = "UTF-8",
) -> RawLoad:
    """Parse only files that no earlier load has seen, and add them to ``target``.

    A file is known by path, size and time of change. Each load writes a folder of its own
    and then a numbered list of its files, created only if that number is free; readers take
    the folders that a list names, so a load that fails adds nothing. Of two loads at once the
    later one drops what it wrote and starts again with the files that the other left. The
    names of one load's new files reach the driver, as Spark's reader needs them. A folder
    without new files adds no load.
    """
    for _ in range(ATTEMPTS):
        number, known = _lists(spark, target)
        new = csv_files(spark, folder)
        if known is not None:
            new = new.join(known.select("path", "size", "modified"), new.columns, "left_anti")
        files = new.collect()
        if not files or _add(spark, target, number, files, header, encoding):
            break
    else:
        raise RuntimeError(f"other loads came first {ATTEMPTS} times")
    _, known = _lists(spark, target)
    if known is None:
        raise FileNotFoundError(f"no CSV files in {folder}")
    names = [r["load"] for r in known.select("load").distinct().collect()]
    loads = f"{target}/loads"
    return _stored(spark, [f"{loads}/load={name}" for name in sorted(names)], loads)


def _add(
    spark: SparkSession, target: str, number: int, files: list[Row], header: bool, encoding: str
) -> bool:
    """Write a load and its list; False, leaving nothing, when that number is taken."""
    load = uuid.uuid4().hex
    place, listed = f"{target}/loads/load={load}", f"{target}/lists/{number:012}.json"
    lines = [json.dumps(f.asDict() | {"load": load}) for f in files]
    try:
        parsed = scan_raw(spark, [f.path for f in files], header, encoding)
        writer = _split(parsed).write.options(**STORED)
        writer.partitionBy("rejected").parquet(place)
        if create_file(spark, listed, "\n".join(lines) + "\n"):
            return True
    except Exception:
        # The list may be there although creating it raised.
        if _names(spark, listed, load):
            return True
        delete_folder(spark, place)
        raise
    delete_folder(spark, place)
    return False


def _names(spark: SparkSession, listed: str, load: str) -> bool:
    folder, name = listed.rsplit("/", 1)
    there = name in dict(list_folder(spark, folder))
    return there and f'"load": "{load}"' in read_file(spark, listed)


def _lists(spark: SparkSession, target: str) -> tuple[int, DataFrame | None]:
    """The next list's number, and the files of all finished loads (None before the first)."""
    names = [n for n, _ in list_folder(spark, f"{target}/lists") if n.endswith(".json")]
    if not names:
        return 0, None
    lists = spark.read.schema(f"{FOUND}, load string").option("mode", "FAILFAST")
    return len(names), lists.json([f"{target}/lists/{n}" for n in sorted(names)])


def _split(lines: DataFrame) -> DataFrame:
    """Whether each line was good, and where it comes from if it was not."""
    bad, fields = F.col(BAD_LINE).isNotNull(), field_count(F.col(BAD_LINE))
    expected = len(RAW_COLUMNS)
    reason = F.when(fields < expected, FEW).when(fields > expected, MANY).otherwise(UNREADABLE)
    found = {
        "file": F.col("_metadata.file_path"),
        "block_start": F.col("_metadata.file_block_start"),
        "fields": fields,
        "reason": reason,
    }
    return lines.select(
        "*",
        *[F.when(bad, value.cast(PROVENANCE[name])).alias(name) for name, value in found.items()],
        bad.alias("rejected"),
    )


def _stored(spark: SparkSession, folders: list[str], base: str | None = None) -> RawLoad:
    schema = T.StructType([*RAW.fields, T.StructField(BAD_LINE, T.StringType())])
    for name, kind in PROVENANCE.items():
        schema = schema.add(name, kind)
    schema = schema.add("rejected", "boolean")
    reader = spark.read.schema(schema)
    stored = (reader.option("basePath", base) if base else reader).parquet(*folders)
    bad = stored.filter("rejected").withColumn("line", F.col(BAD_LINE))
    return RawLoad(
        rows=stored.filter(~F.col("rejected")).select(*RAW_COLUMNS),
        rejects=bad.select("line"),
        rejections=bad.select(*PROVENANCE, "line"),
    )
