"""Tables written once and read back, in the shared folder the cluster names.

A written table cuts lineage for good (it survives lost executors), is scanned
column by column afterwards, and gives Catalyst a real file size to choose joins
from. Nothing in this library broadcasts by hint: a side is broadcast only when
its measured size is under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# How tables of rows are written: hashed keys and codes take half the bytes of the default.
STORED = {"compression": "zstd"}


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind. They would stay until the driver
    happens to collect garbage, and a stored table is read from its own files."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or a temporary folder when Spark itself is local."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="ledgerloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder from whatever file system the path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def create_file(spark: SparkSession, path: str, content: str) -> bool:
    """Write a small file; False when one of that name is there already."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(target.getParent())
    try:
        out = system.create(target, False)
    except Py4JJavaError:
        if system.exists(target):
            return False
        raise
    try:
        out.write(bytearray(content, "utf-8"))
    finally:
        out.close()
    return True


def read_file(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    source = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def list_folder(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """Name and time of change (seconds since 1970) of what a folder holds; none, no names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(target):
        return []
    return [
        (f.getPath().getName(), f.getModificationTime() / 1000) for f in system.listStatus(target)
    ]


class Scratch:
    """A fresh subfolder per use; each kept table gets its own path inside it.

    As a context manager it removes the subfolder at the end: everything computed from
    the kept tables must be written by then. ``options`` are those of the parquet writer.
    """

    def __init__(self, spark: SparkSession, options: Mapping[str, str] | None = None):
        self.spark = spark
        self.options = dict(options or {})
        self.root = f"{shared_folder(spark)}/ledgerloom/{uuid.uuid4().hex}"

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *exc: object) -> None:
        delete_folder(self.spark, self.root)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        with shuffles_removed(self.spark):
            df.write.options(**self.options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
