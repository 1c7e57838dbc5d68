"""The normalised store: append-only tables published all together.

A load writes its new rows of each table into a ``run_id=`` folder of its own, checks
them, and only then adds one line to the commit log (``commit_log``). Readers see the
folders of committed runs, so a load that fails part-way leaves nothing visible, and a rerun
of the same batch adds no rows. Whether a load is committed is read from the log alone; a
load whose commit raised is removed only if the log does not name it.

Small runs are merged into one by a commit that replaces them, so the folders a reader opens
stay few however many loads were made. The replaced folders stay for readers that began
before, until ``clean_up`` removes those older than it is told. A load and a compaction at
once want the same number: the later one starts again.
"""

from __future__ import annotations

import time
import uuid
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.commit_log import CommitLog, Run, State
from ledgerloom.operators import absent_rows, with_row_ids, with_values
from ledgerloom.plans import checks, normalised
from ledgerloom.schemas import STORE
from ledgerloom.scratch import STORED, Scratch, delete_folder, list_folder

# Loads started again because others committed meanwhile.
ATTEMPTS = 5
# A load that leaves more runs than this merges the small ones.
MOST_RUNS = 16
_RUN = "run_id="


def to_merge(runs: tuple[Run, ...]) -> list[Run]:
    """From the smallest up, while the next run is at most twice what is merged so far.

    What is left grows at least threefold from run to run, so there are few of them, and a
    row is copied a number of times that grows with the logarithm of the store.
    """
    chosen: list[Run] = []
    for run in sorted(runs, key=lambda r: r.rows):
        if chosen and run.rows > 2 * max(sum(r.rows for r in chosen), 1):
            break
        chosen.append(run)
    return chosen if len(chosen) > 1 else []


class Store:
    def __init__(self, spark: SparkSession, root: str, most_runs: int = MOST_RUNS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.most_runs = most_runs
        self.log = CommitLog(spark, f"{self.root}/_commits")

    # ── reading ──────────────────────────────────────────────────────────────

    @property
    def _log(self) -> str:
        return self.log.folder

    def committed_runs(self) -> list[str]:
        """Runs that make up the tables; merged ones under the name of their merge."""
        return self.log.state().names

    def _folder(self, table: str, run_id: str) -> str:
        return f"{self.root}/{table}/{_RUN}{run_id}"

    def _read(self, table: str, runs: list[str]) -> DataFrame:
        schema = STORE[table].schema
        if not runs:
            # Known to be empty when planned, so that joins with it fold away.
            nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
            return self.spark.range(0).select(*nothing).filter(F.lit(False))
        return self.spark.read.schema(schema).parquet(*[self._folder(table, r) for r in runs])

    def table(self, name: str) -> DataFrame:
        return self._read(name, self.committed_runs())

    def row_counts(self) -> DataFrame:
        runs = self.committed_runs()
        return normalised.row_counts({t: self._read(t, runs) for t in STORE})

    def check_report(self) -> DataFrame:
        """Keys, required columns, text lengths and foreign keys of the stored tables."""
        runs = self.committed_runs()
        tables = {name: self._read(name, runs) for name in STORE}
        return checks.check_report(
            {
                name: (df, checks.stored_checks(STORE[name], tables))
                for name, df in tables.items()
            }
        )

    # ── loading ──────────────────────────────────────────────────────────────

    def load(self, silver: DataFrame) -> str:
        """Insert what is new in ``silver`` into all four tables, or into none."""
        source = normalised.silver_columns(silver)
        run_id = self._committed(lambda state, run_id: self._write_run(source, state, run_id))
        if len(self.log.state().runs) > self.most_runs:
            self.compact()
        return run_id

    def _committed(self, write) -> str | None:
        """Write a run on top of the log's state and commit it; again if others came first.

        ``write`` returns the run's rows, the last line id and the runs it replaces, or None
        where there is nothing to do.
        """
        for _ in range(ATTEMPTS):
            run_id, state = uuid.uuid4().hex, self.log.state()
            try:
                done = write(state, run_id)
                if done is None:
                    return None
                rows, last_id, replaces = done
                committed = self._commit(state, Run(run_id, rows), last_id, replaces)
            except Exception:
                # If the log cannot be read now, nothing is removed.
                if self.log.holds(state.seq, run_id):
                    return run_id
                self._remove(run_id)
                raise
            if committed:
                return run_id
            self._remove(run_id)  # another load came first
        raise RuntimeError(f"other loads came first {ATTEMPTS} times")

    def _commit(self, state: State, run: Run, last_id: int, replaces: list[str]) -> bool:
        return self.log.add(state, run, last_id, replaces)

    def _remove(self, run_id: str) -> None:
        for name in STORE:
            delete_folder(self.spark, self._folder(name, run_id))

    def _write_run(self, source: DataFrame, state: State, run_id: str) -> tuple:
        """Parents are stored once: they are inserted and also guard their children.

        What is counted of the new rows is counted while they are written.
        """
        runs, seen = state.names, {}
        with Scratch(self.spark, STORED) as scratch:
            customers = scratch.keep(normalised.customers(source), "customers")
            products = scratch.keep(normalised.products(source), "products")
            orders = scratch.keep(normalised.orders(source, customers), "orders")
            parents = {"customers": customers, "products": products, "orders": orders}
            for name, batch in parents.items():
                new = absent_rows(batch, self._read(name, runs), STORE[name].key)
                seen[name] = self._append(name, new, run_id)

            # Lines already stored go first. Keys are looked up once each, not line by line. What
            # follows a lookup is a shuffle on something else, so a hot invoice can be split.
            key = STORE["order_items"].key
            lines = absent_rows(
                with_values(source, "quantity"),
                self._read("order_items", runs),
                key,
                ("quantity", "unit_price", "total_price"),
            )
            parents = {"invoice_no": orders, "stock_code": products}
            unknown = normalised.unknown_values(source, parents, scratch)
            items = normalised.order_items(lines, orders, products, unknown)
            items = with_row_ids(items, key, scratch, after=state.last_id)
            seen["order_items"] = self._append("order_items", items, run_id)
            self._check_run(runs, run_id, seen, scratch)
        rows = sum(found["rows"] for found in seen.values())
        return rows, seen["order_items"].get("last_id") or state.last_id, []

    def _append(self, name: str, new: DataFrame, run_id: str) -> dict:
        """Write new rows; money columns that do not fit raise here, as they do in a database.

        Returns what was observed on the way: rows, the last id, and violations of the checks
        on single rows. The observed stage is the one that writes, whose tasks count once
        however often they run.
        """
        typed = new.select(*[F.col(f.name).cast(f.dataType) for f in STORE[name].schema])
        row_checks = checks.stored_row_checks(STORE[name])
        counts = [F.count("*").alias("rows"), *checks.row_counts(row_checks)]
        if name == "order_items":
            counts.append(F.max("id").alias("last_id"))
        seen = Observation(f"{name} {run_id}")
        writer = typed.observe(seen, *counts).write.options(**STORED)
        writer.parquet(self._folder(name, run_id))
        return seen.get

    def _check_run(self, runs: list[str], run_id: str, seen: dict, scratch: Scratch) -> None:
        """New rows are absent from the target, so keys need checking among them only.

        Tables without new rows cannot fail. Values of a foreign key are stored, so that a few
        of them meet the parents at their scan.
        """
        reports = []
        for name, spec in STORE.items():
            rows = checks.stored_row_checks(spec)
            reports.append(checks.observed_report(self.spark, name, rows, seen[name]))
            if not seen[name]["rows"]:
                continue
            new = self._read(name, [run_id])
            left = [
                checks.stored_parent_check(
                    new, column, self._read(parent, [*runs, run_id]), column, scratch.keep
                )
                for column, parent in spec.parents.items()
            ]
            left += [checks.unique_combination(*columns) for columns in spec.unique_sets]
            reports.append(checks.check_table(name, new, left))
        checks.require(reduce(DataFrame.unionByName, reports))

    # ── housekeeping ─────────────────────────────────────────────────────────

    def compact(self) -> str | None:
        """Merge the small runs into one; None if there is nothing to gain."""
        return self._committed(self._merge)

    def _merge(self, state: State, run_id: str) -> tuple | None:
        chosen = to_merge(state.runs)
        if not chosen:
            return None
        names = [r.run_id for r in chosen]
        for name in STORE:
            merged = self._read(name, names).write.options(**STORED)
            merged.parquet(self._folder(name, run_id))
        return sum(r.rows for r in chosen), state.last_id, names

    def clean_up(self, older_than: timedelta = timedelta(days=7)) -> None:
        """Remove folders that no commit names any more, and old files of the log.

        ``older_than`` must exceed the longest load and the longest query: a run that is
        being written, or read since before it was replaced, looks the same.
        """
        before = time.time() - older_than.total_seconds()
        live = {f"{_RUN}{name}" for name in self.committed_runs()}
        for table in STORE:
            for folder, changed in list_folder(self.spark, f"{self.root}/{table}"):
                if folder.startswith(_RUN) and folder not in live and changed < before:
                    delete_folder(self.spark, f"{self.root}/{table}/{folder}")
        self.log.trim(before)


def load_store(silver: DataFrame, root: str) -> DataFrame:
    """Load and report the row counts of the four tables."""
    store = Store(silver.sparkSession, root)
    store.load(silver)
    return store.row_counts()
