"""All tables from raw rows to marts, each built once and read back."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Iterable, Iterator
from functools import cached_property, reduce

from pyspark.sql import DataFrame, Observation, SparkSession

from ledgerloom import release
from ledgerloom.plans import checks, gold, marts
from ledgerloom.plans.silver import silver
from ledgerloom.scratch import STORED, Scratch, delete_folder, list_folder, shuffles_removed

LAYERS = {
    "silver": ("silver_ecommerce",),
    "gold": ("dim_customers", "dim_products", "dim_date", "fact_sales"),
    "marts": ("mart_invoices", "mart_rfm_snapshot", "mart_rfm_movement"),
}


class Warehouse:
    """A table is computed and written under ``root`` when first asked for.

    Silver has four readers and every mart reads the same fact, so each is stored rather
    than recomputed. Building again under the same root writes new folders beside the old
    ones: readers keep what they read until ``create_tables`` points the catalog at the new
    folders, and a build that fails changes nothing for them. Without a root the tables are
    temporary; as a context manager a warehouse removes those at the end. ``publish`` releases
    a whole build at once (``release``), and ``release.remove_old`` removes earlier versions.
    """

    def __init__(
        self,
        raw: DataFrame,
        countries: DataFrame,
        root: str | None = None,
        calendar_start: str = gold.CALENDAR_START,
        calendar_end: str = gold.CALENDAR_END,
    ):
        self.spark = raw.sparkSession
        self.raw = raw
        self.countries = countries
        self.temporary = root is None
        self.root = root or Scratch(self.spark).root
        self.version = uuid.uuid4().hex
        self.calendar = (calendar_start, calendar_end)
        self._seen: dict[str, dict] = {}

    def __enter__(self) -> Warehouse:
        return self

    def __exit__(self, *exc: object) -> None:
        if self.temporary:
            delete_folder(self.spark, self.root)

    def _path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}/{self.version}"

    def _stored(
        self, layer: str, name: str, df: DataFrame, by: str | None = None
    ) -> DataFrame:
        """Write a table, in one folder per value of ``by`` if given, and count violations of
        its row checks on the way.

        The stage that writes is the one observed: its tasks count once, however often they
        run, so lost executors do not change the counts.
        """
        path, seen = self._path(layer, name), Observation(f"{name} {self.version}")
        counts = checks.row_counts(checks.row_checks(df, self._checks()[name]))
        with shuffles_removed(self.spark):
            if by is None:
                df.observe(seen, *counts).write.options(**STORED).parquet(path)
            else:
                writer = marts.by_folder(df, by).observe(seen, *counts).write.options(**STORED)
                writer.partitionBy(by).parquet(path)
        self._seen[name] = seen.get
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)

    @cached_property
    def silver_ecommerce(self) -> DataFrame:
        return self._stored("silver", "silver_ecommerce", silver(self.raw))

    @cached_property
    def dim_customers(self) -> DataFrame:
        return self._stored("gold", "dim_customers", gold.dim_customers(self.silver_ecommerce))

    @cached_property
    def dim_products(self) -> DataFrame:
        return self._stored("gold", "dim_products", gold.dim_products(self.silver_ecommerce))

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._stored("gold", "dim_date", gold.dim_date(self.spark, *self.calendar))

    @cached_property
    def fact_sales(self) -> DataFrame:
        return self._stored("gold", "fact_sales", gold.fact_sales(self.silver_ecommerce))

    @cached_property
    def mart_invoices(self) -> DataFrame:
        df = marts.mart_invoices(
            self.fact_sales, self.dim_customers, self.dim_products, self.dim_date, self.countries
        )
        return self._stored("marts", "mart_invoices", df)

    @cached_property
    def mart_rfm_snapshot(self) -> DataFrame:
        with Scratch(self.spark) as scratch:
            df = marts.mart_rfm_snapshot(self.fact_sales, self.dim_date, scratch)
            return self._stored("marts", "mart_rfm_snapshot", df, by=marts.MONTH)

    @property
    def latest_month(self) -> str | None:
        """The last month of the snapshot, from the names of its folders: nothing is scanned."""
        self.mart_rfm_snapshot
        return marts.latest_folder(self.spark, self._path("marts", "mart_rfm_snapshot"))

    @cached_property
    def mart_rfm_movement(self) -> DataFrame:
        """Stored in (customer, month) order, so that readers of one customer skip files."""
        df = marts.mart_rfm_movement(self.mart_rfm_snapshot)
        laid_out = df.sortWithinPartitions("customer_id", "snapshot_month")
        return self._stored("marts", "mart_rfm_movement", laid_out)

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for names in LAYERS.values() for name in names}

    def publish(self) -> int:
        """Build what is missing and release all tables at once: ``Warehouse.open`` gives
        either all tables of this build or all of an earlier one."""
        built = self.tables()
        return release.publish(
            self.spark,
            self.root,
            {
                name: (f"{layer}/{name}/{self.version}", built[name])
                for layer, names in LAYERS.items()
                for name in names
            },
        )

    @staticmethod
    def open(spark: SparkSession, root: str, number: int | None = None) -> dict[str, DataFrame]:
        """All tables of one release, by default the last."""
        return release.open_release(spark, root, number)

    def create_views(self) -> None:
        for name, df in self.tables().items():
            df.createOrReplaceTempView(name)

    def create_tables(self) -> None:
        """Register the stored files as ``<layer>.<table>``, or point it at them.

        All tables are built first. A table that Spark itself keeps the files of is left
        alone: replacing it would delete them.
        """
        built = self.tables()
        for layer, names in LAYERS.items():
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
            for name in names:
                self._register(f"{layer}.{name}", built[name], self._path(layer, name))

    def _register(self, table: str, df: DataFrame, path: str) -> None:
        catalog = self.spark.catalog
        if catalog.tableExists(table):
            if catalog.getTable(table).tableType == "MANAGED":
                raise ValueError(f"{table} is a managed table")
            if self.spark.table(table).dtypes == df.dtypes:
                self.spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
                catalog.refreshTable(table)
                return
            self.spark.sql(f"DROP TABLE {table}")  # the entry; its files stay
        if not any(marts.MONTH in f for f, _ in list_folder(self.spark, path)):
            catalog.createTable(table, path=path, source="parquet")
            return
        columns = ", ".join(f"`{c}` {kind}" for c, kind in df.dtypes)
        self.spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({marts.MONTH}) "
            f"LOCATION '{path}'"
        )
        self.spark.sql(f"MSCK REPAIR TABLE {table}")

    def _checks(self) -> dict[str, list[checks.Check]]:
        """Declared checks by table, in the order of the layers; months must lie within the
        calendar."""
        start, end = self.calendar
        last = datetime.date.fromisoformat(end) - datetime.timedelta(days=1)
        months = (start[:8] + "01", last.isoformat()[:8] + "01")
        return {
            "silver_ecommerce": checks.silver_checks(),
            "dim_customers": checks.dim_customers_checks(),
            "dim_products": checks.dim_products_checks(),
            "dim_date": checks.dim_date_checks(),
            "fact_sales": checks.fact_sales_checks(),
            "mart_invoices": checks.mart_invoices_checks(),
            "mart_rfm_snapshot": checks.mart_rfm_snapshot_checks(months),
            "mart_rfm_movement": checks.mart_rfm_movement_checks(),
        }

    def _report(self, name: str, declared: list[checks.Check]) -> DataFrame:
        """Checks on single rows from what was seen while the table was written, and a scan
        for each uniqueness check."""
        df, parts = getattr(self, name), []
        on_rows = checks.row_checks(df, self._checks()[name])
        seen = {(c.name, c.column): self._seen[name][f"c{i}"] for i, c in enumerate(on_rows)}
        asked = [c for c in checks.row_checks(df, declared) if (c.name, c.column) in seen]
        if asked:
            counted = {f"c{i}": seen[c.name, c.column] for i, c in enumerate(asked)}
            parts.append(checks.observed_report(self.spark, name, asked, counted))
        if rest := [c for c in declared if not any(c is a for a in asked)]:
            parts.append(checks.check_table(name, df, rest))
        return reduce(DataFrame.unionByName, parts)

    def _reports(self) -> Iterator[DataFrame]:
        yield checks.check_table("raw_ecommerce", self.raw, checks.raw_checks())
        for name, declared in self._checks().items():
            yield self._report(name, declared)

    def check_report(self) -> DataFrame:
        """One row per declared check."""
        return reduce(DataFrame.unionByName, self._reports())

    def counted_report(self, scratch: Scratch) -> DataFrame:
        """The same, counted and stored table by table: all counts at once would hold the shuffles
        of all."""
        found = [scratch.keep(report, "report") for report in self._reports()]
        return reduce(DataFrame.unionByName, found)

    def build(self, tolerated: Iterable[tuple[str, str]] = ()) -> None:
        """Build layer by layer; a layer with a failed check raises ``ChecksFailed`` before
        anything that reads it is built.

        ``tolerated`` holds (table, check name) pairs that may fail.
        """
        declared, allowed = self._checks(), set(tolerated)
        for names in LAYERS.values():
            parts = []
            for name in names:
                asked = [c for c in declared[name] if (name, c.name) not in allowed]
                getattr(self, name)
                if asked:
                    parts.append(self._report(name, asked))
            checks.require(reduce(DataFrame.unionByName, parts))
