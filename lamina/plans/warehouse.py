"""The whole warehouse: raw, bronze, silver with checks, gold."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from itertools import groupby
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.operators import quality
from lamina.operators.integrity import duplicate_summary, orphan_summaries
from lamina.operators.surrogate import step
from lamina.plans import answers, bronze, checks, gold, incremental, silver
from lamina.schemas import (
    BRONZE, DQ_LOG, RAW_LAYOUTS, RAW_PRIMARY_KEYS, RAW_REFERENCES, raw_schema,
)
from lamina.sources.csv import read_csv
from lamina.sources.hashed import HashHistory
from lamina.sources.tables import Tables, path_exists

LOG = "dq_log_results"
DIMENSIONS = ("dim_date", "dim_patients", "dim_payers", "dim_conditions")
FACTS = ("fact_claims", "fact_encounters")
GOLD_TABLES = DIMENSIONS + FACTS
SURROGATES = {  # natural key and surrogate key
    "dim_patients": ("patient_id", "patient_key"),
    "dim_payers": ("payer_id", "payer_key"),
    "dim_conditions": ("code", "condition_key"),
}


def run_label(layer: str, now: datetime) -> str:
    """A run id for a caller without one: layer, UTC time and a random part."""
    return f"{layer}/{now.astimezone(timezone.utc):%Y-%m-%dT%H:%M:%SZ}/{uuid4()}"


@dataclass(frozen=True)
class Warehouse:
    """One flow in dependency order.

    `as_of` stands for now: lineage times, ages and the end of the calendar.
    """

    tables: Tables
    hash_buckets: int = 64  # of the hash history of each bronze table
    key_buckets: int = 16  # of silver and the facts where they are kept up to date by merges

    # --- raw ---

    def load_csv_folder(self, folder: str) -> dict[str, int]:
        """Load every raw table with a <table>.csv file or folder, once.

        Does nothing when patients are already there. Missing files are skipped.
        """
        if self.tables.is_loaded("raw", "patients"):
            self.tables.report("raw layer already populated, skipping")
            for table in RAW_LAYOUTS:  # a load that broke off, or a file that came later
                if self.tables.find("raw", table) is None and path_exists(
                    self.tables.spark, f"{folder.rstrip('/')}/{table}.csv"
                ):
                    self.tables.report(f"  ERROR {table}: has a file but was never loaded")
            return {}
        loaded = {}
        for table in RAW_LAYOUTS:
            path = f"{folder.rstrip('/')}/{table}.csv"
            if not path_exists(self.tables.spark, path):
                self.tables.report(f"  SKIP {table}: file not found")
                continue
            df = read_csv(self.tables.spark, path, table)
            loaded[table] = self.tables.refresh("raw", table, df)
        return loaded

    # --- bronze ---

    def load_bronze(
        self, table: str, raw: DataFrame, as_of: datetime, dedup_within_batch: bool = False
    ) -> int:
        """Append the rows whose hash bronze does not hold. The history's hashes stay where they are."""
        with step(self.tables.spark):
            return self.tables.append("bronze", table, bronze.increment_by_history(
                raw, HashHistory(self.tables, self.hash_buckets), table, as_of, dedup_within_batch))

    # --- silver ---

    def load_silver(self, table: str, as_of: datetime, run_id: str) -> int:
        """Refresh one silver table and log its checks; both become visible together."""
        with self.tables.together():
            rows = self.refresh_silver(table, as_of)
            self.log_checks([table], as_of, run_id)
        return rows

    def refresh_silver(self, table: str, as_of: datetime) -> int:
        with step(self.tables.spark):
            newest = silver.newest_stored(self.tables.read("bronze", table), table)
            return self.tables.refresh("silver", table, silver.shaped(newest, table, as_of))

    def log_checks(self, names: Iterable[str], as_of: datetime, run_id: str) -> None:
        """Measure stored silver tables, each in one scan, and add the rows to the log."""
        log = self.tables.read_or_empty("metadata", LOG, DQ_LOG)
        last_id = log.agg(F.max("id")).first()[0] or 0
        measured = reduce(DataFrame.unionByName, [
            quality.measure(self.tables.read("silver", t), f"silver_{t}", silver.CHECKS[t])
            for t in names
        ])
        entries = [  # a handful of rows: one per check
            e.asDict() | {"id": last_id + i + 1}
            for i, e in enumerate(quality.log_rows(measured, run_id, as_of).collect())
        ]
        stored = self.tables.spark.createDataFrame(
            [tuple(e[c] for c in DQ_LOG.names) for e in entries], DQ_LOG
        )
        self.tables.append("metadata", LOG, stored.coalesce(1))
        for table, rows in groupby(entries, key=lambda e: e["table_name"]):
            status = [e["status"] for e in rows]
            self.tables.report(
                f"  checks [{table}]: {status.count('PASSED')}/{len(status)} passed"
            )

    # --- gold ---

    def load_gold(self, table: str, as_of: datetime) -> int:
        """Refresh a gold table. Keys given to a dimension's rows are registered for good, and both become visible together."""
        if table not in SURROGATES:
            with step(self.tables.spark):
                return self.tables.refresh("gold", table, self._gold(table, as_of))
        natural, key = SURROGATES[table]
        with self.tables.jointly(), step(self.tables.spark):
            if self._known_keys(table) is not None and self.tables.find("keys", table) is None:
                self.tables.append("keys", table, self._known_keys(table))  # a dimension from before there was a registry
            known = self._known_keys(table)
            rows = self.tables.refresh("gold", table, self._gold(table, as_of))
            given = self.tables.read("gold", table).select(natural, key)
            new = given if known is None else given.join(known.select(natural), natural, "left_anti")
            self.tables.append("keys", table, new)
        return rows

    def _known_keys(self, table: str) -> DataFrame | None:
        """Every natural key that ever had a surrogate key, also of rows that left the dimension."""
        known = self.tables.find("keys", table)
        if known is None:
            known = self.tables.find("gold", table)
        return None if known is None else known.select(*SURROGATES[table])

    def merge_silver(self, table: str, as_of: datetime) -> int:
        """Take new bronze rows into a silver table; only the buckets of their keys are written."""
        with step(self.tables.spark):
            return incremental.merge_silver(self.tables, table, as_of, self.key_buckets)

    def merge_fact_claims(self) -> int:
        """Compute anew the claims that changes of silver and new keys concern."""
        with step(self.tables.spark):
            return incremental.merge_fact_claims(self.tables, self.key_buckets)

    def merge_fact_encounters(self) -> int:
        """Compute anew the encounters that changes of silver and new keys concern."""
        with step(self.tables.spark):
            return incremental.merge_fact_encounters(self.tables, self.key_buckets)

    def _gold(self, table: str, as_of: datetime) -> DataFrame:
        def s(name: str) -> DataFrame:
            return self.tables.read("silver", name)

        def g(name: str) -> DataFrame:
            return self.tables.read("gold", name)

        stored = self._known_keys  # facts hold a dimension's keys, so a refresh may not deal them anew
        if table == "dim_date":
            return gold.dim_date(
                gold.first_warehouse_day(s("claims"), s("encounters")), as_of
            ).coalesce(1)
        if table == "dim_patients":
            return gold.dim_patients(s("patients"), stored(table))
        if table == "dim_payers":
            return gold.dim_payers(s("payers"), stored(table))
        if table == "dim_conditions":
            return gold.dim_conditions(s("conditions"), stored(table))
        if table == "fact_claims":
            return gold.fact_claims(
                s("claims"), s("claims_transactions"), s("encounters"),
                g("dim_patients"), g("dim_payers"),
            )
        if table == "fact_encounters":
            return gold.fact_encounters(
                s("encounters"), s("conditions"), s("careplans"),
                g("dim_patients"), g("dim_payers"),
            )
        raise LookupError(f"no gold table {table}")

    # --- all ---

    def build(
        self, raw: Mapping[str, DataFrame] | None, as_of: datetime, run_id: str | None = None,
        at_once: int = 4, by_merges: bool = False,
    ) -> str:
        """Run every step. `raw` defaults to the stored raw layer. Returns the run id.

        With `by_merges`, silver and the facts take in what is new instead of being built from all
        that bronze holds, table by table; the other steps are as always.

        Tables of a layer do not depend on each other, so up to `at_once` of
        them are submitted together and share the executors. Silver and its
        checks become visible in one step, and so do all gold tables.
        """
        run_id = run_id or run_label("silver", datetime.now(timezone.utc))

        def source(table: str) -> DataFrame:
            return raw[table] if raw is not None else self.tables.read("raw", table)

        with ThreadPoolExecutor(at_once) as pool:
            def each(load: Callable[[str], int], names: Iterable[str]) -> None:
                list(pool.map(load, names))  # waits, and raises what a load raised

            each(lambda t: self.load_bronze(t, source(t), as_of), BRONZE)
            if by_merges:
                for t in BRONZE:
                    self.merge_silver(t, as_of)
                self.log_checks(BRONZE, as_of, run_id)
                with self.tables.together():
                    each(lambda t: self.load_gold(t, as_of), DIMENSIONS)
                self.merge_fact_claims()
                self.merge_fact_encounters()
                return run_id
            with self.tables.together():
                each(lambda t: self.refresh_silver(t, as_of), BRONZE)
                self.log_checks(BRONZE, as_of, run_id)
            with self.tables.together():
                each(lambda t: self.load_gold(t, as_of), DIMENSIONS)
                each(lambda t: self.load_gold(t, as_of), FACTS)
        return run_id

    def publish(self) -> list[str]:
        """Register every stored table for `spark.sql`. Returns their SQL names."""
        layers = {
            "raw": RAW_LAYOUTS, "bronze": BRONZE, "silver": BRONZE, "gold": GOLD_TABLES,
            "metadata": (LOG,),
        }
        return [n for layer, names in layers.items() for n in self.tables.publish(layer, names)]

    # --- answers and checks ---

    def revenue_cycle(self) -> DataFrame:
        return answers.revenue_cycle(
            self.tables.read("gold", "fact_claims"), self.tables.read("gold", "dim_payers")
        )

    def payer_settlement(self) -> DataFrame:
        return answers.payer_settlement(
            self.tables.read("gold", "fact_claims"), self.tables.read("gold", "dim_payers")
        )

    def readmission(self) -> DataFrame:
        return answers.readmission(self.tables.read("gold", "fact_encounters"))

    def readmission_preview(self) -> DataFrame:
        return answers.readmission_preview(self.tables.read("gold", "fact_encounters"))

    def failed_checks(self) -> DataFrame:
        return answers.failed_checks(self.tables.read("metadata", LOG))

    def check_trend(self) -> DataFrame:
        return answers.check_trend(self.tables.read("metadata", LOG))

    def verify(self, layer: str) -> DataFrame:
        """Check rows for one layer: raw, bronze, silver, dq, gold or all."""
        if layer == "all":
            parts = [self.verify(name) for name in ("raw", "bronze", "silver", "dq", "gold")]
            whole = parts[0]
            for part in parts[1:]:
                whole = whole.unionByName(part)
            return whole
        if layer == "raw":
            return checks.populated({t: self._raw(t) for t in RAW_LAYOUTS})
        if layer == "dq":
            return checks.log_status(self.tables.read("metadata", LOG))
        if layer == "gold":
            stored = {t: self.tables.read("gold", t) for t in GOLD_TABLES}
            silver_layer = {t: self.tables.read("silver", t) for t in ("claims", "encounters")}
            return checks.gold_layer(stored).unionByName(checks.gold_meaning(stored, silver_layer))
        frames = {t: self.tables.read(layer, t) for t in BRONZE}
        if layer == "bronze":
            return checks.populated(frames).unionByName(checks.unique_hashes(frames))
        if layer == "silver":
            return checks.pass_rates(frames)
        raise LookupError(f"no layer {layer}")

    def raw_duplicates(self) -> DataFrame:
        """Primary keys of the raw layer that repeat, one row per loaded table."""
        return reduce(DataFrame.unionByName, [
            duplicate_summary(self._raw(t), t, ["id"]) for t in RAW_PRIMARY_KEYS
        ])

    def raw_orphans(self) -> DataFrame:
        """References of the raw layer that point nowhere, one row per reference."""
        references = [(child, column, parent) for child, found in RAW_REFERENCES.items() for column, parent in found.items()]
        return orphan_summaries(references, {t: self._raw(t) for t in RAW_LAYOUTS})

    def _raw(self, table: str) -> DataFrame:
        return self.tables.read_or_empty("raw", table, raw_schema(table))
