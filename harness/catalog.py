"""Every registered query: whole tables in, one DataFrame out."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harness import stored
from harness.adapters import REFERENCES, source
from lamina.operators import quality
from lamina.operators.integrity import duplicate_summary, orphan_summary
from lamina.operators.surrogate import ensure_checkpoint_dir, stored_once
from lamina.plans import answers, bronze, checks, gold, silver
from lamina.schemas import BRONZE, bronze_schema, raw_columns
from lamina.sources.csv import read_csv
from lamina.sources.tables import empty

AS_OF = datetime(2024, 6, 30)
DAY_BEFORE = AS_OF - timedelta(days=1)
RUN_ID = "silver__20240630T000000__00000000"

Query = Callable[[SparkSession, str], DataFrame]


class Flow:
    """The layers over one set of test tables, built on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str, store_silver: bool = False):
        self.spark, self.sf_dir, self.store_silver = spark, sf_dir, store_silver
        self._dims: dict[str, DataFrame] = {}
        self._silver: dict[str, DataFrame] = {}

    def raw(self, table: str) -> DataFrame:
        return source(self.spark, self.sf_dir, table)

    def bronze(self, table: str) -> DataFrame:
        """First load. Transactions say when they arrived, so they have versions."""
        arrived = F.col("fromdate") if table == "claims_transactions" else AS_OF
        return bronze.stage(self.raw(table), table, arrived)

    def claims_history(self) -> DataFrame:
        """Every claim loaded while still open, then the whole table again a day later."""
        opened = self.raw("claims").withColumn("status1", F.lit("OPEN"))
        first = bronze.stage(opened, "claims", DAY_BEFORE)
        return first.unionByName(self.claims_increment())

    def claims_increment(self) -> DataFrame:
        opened = self.raw("claims").withColumn("status1", F.lit("OPEN"))
        first = bronze.stage(opened, "claims", DAY_BEFORE)
        return bronze.increment(self.raw("claims"), first, "claims", AS_OF)

    def silver(self, table: str) -> DataFrame:
        if table in self._silver:
            return self._silver[table]
        built = silver.BUILDERS[table](self.bronze(table), AS_OF)
        if self.store_silver:
            built = self._silver[table] = stored_once(built)
        return built

    def checks(self, table: str) -> DataFrame:
        return quality.measure(self.silver(table), f"silver_{table}", silver.CHECKS[table])

    def log(self) -> DataFrame:
        parts = [quality.log_rows(self.checks(t), RUN_ID, AS_OF) for t in BRONZE]
        return reduce(DataFrame.unionByName, parts)

    def dim(self, name: str) -> DataFrame:
        if name not in self._dims:
            self._dims[name] = {
                "patients": lambda: gold.dim_patients(self.silver("patients")),
                "payers": lambda: gold.dim_payers(self.silver("payers")),
                "conditions": lambda: gold.dim_conditions(self.silver("conditions")),
                "date": lambda: gold.dim_date(
                    gold.first_warehouse_day(self.silver("claims"), self.silver("encounters")),
                    AS_OF,
                ),
            }[name]()
        return self._dims[name]

    def fact_claims(self) -> DataFrame:
        return gold.fact_claims(
            self.silver("claims"), self.silver("claims_transactions"), self.silver("encounters"),
            self.dim("patients"), self.dim("payers"),
        )

    def fact_encounters(self) -> DataFrame:
        return gold.fact_encounters(
            self.silver("encounters"), self.silver("conditions"), self.silver("careplans"),
            self.dim("patients"), self.dim("payers"),
        )

    def claims_with_payer(self) -> DataFrame:
        """What the claim answers need of the claim fact: no numbering, no patient."""
        return gold.claim_measures(
            self.silver("claims"), self.silver("claims_transactions"), self.silver("encounters"),
            [gold.payer_lookup(self.dim("payers"))],
        )

    def admissions(self) -> DataFrame:
        """What the readmission answers need of the encounter fact: no dimension."""
        return gold.encounter_measures(
            self.silver("encounters"), self.silver("conditions"),
            gold.earliest_active_plan(self.silver("careplans")),
        )

    def gold(self) -> dict[str, DataFrame]:
        return {
            "dim_date": self.dim("date"),
            "dim_patients": self.dim("patients"),
            "dim_payers": self.dim("payers"),
            "dim_conditions": self.dim("conditions"),
            # Read by several checks each, so computed once.
            "fact_claims": stored_once(self.fact_claims()),
            "fact_encounters": stored_once(self.fact_encounters()),
        }

    def all_of(self, make: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
        return {t: make(t) for t in BRONZE}


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines hand over the same types."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- CSV round trips: write a source as CSV into the shared folder, read it back ---


def _scratch(spark: SparkSession, name: str) -> str:
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/csv-{uuid.uuid4().hex}/{name}.csv"


def _csv_transactions(flow: Flow) -> DataFrame:
    spark, table = flow.spark, "claims_transactions"
    path = _scratch(spark, table)
    utc_text = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    flow.raw(table).withColumns({
        "fromdate": F.date_format("fromdate", utc_text),
        "todate": F.date_format("todate", utc_text),
    }).write.option("header", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    return read_csv(spark, path, table).select(*BRONZE[table].columns)


def filled_transactions() -> str:
    """All columns of the raw layout: those of the source, and for the others text with quotes, commas and line breaks,
    or numbers, by the type. Valid in Spark SQL and in DuckDB."""
    filled = {
        "string": "concat(cast(id as varchar(40)), ' said \"{0}\", ', chr(10), ' twice ')",
        "integer": "cast(length(cast(id as varchar(40))) * {1} as integer)",
        "decimal": "cast(length(cast(id as varchar(40))) * {1} as decimal(15,2))",
    }
    columns = []
    for k, c in enumerate(raw_columns("claims_transactions")):
        kind = c.type.typeName()
        if c.name in BRONZE["claims_transactions"].columns:
            columns.append(f"cast({c.name} as varchar(40)) as {c.name}" if c.is_uuid else c.name)
        elif c.is_uuid:
            columns.append(f"concat('{c.name}-', cast(id as varchar(40))) as {c.name}")
        else:
            columns.append(filled[kind].format(c.name, k) + f" as {c.name}")
    return ", ".join(columns)


def _csv_all_columns(flow: Flow) -> DataFrame:
    spark, table = flow.spark, "claims_transactions"
    path, utc_text = _scratch(spark, table), "yyyy-MM-dd'T'HH:mm:ss'Z'"
    flow.raw(table).createOrReplaceTempView("lamina_transactions")
    filled = spark.sql(f"select {filled_transactions()} from lamina_transactions")
    # Texts of 33 columns are many times the table: packed, in files small enough for one task each.
    filled.withColumns({c: F.date_format(c, utc_text) for c in ("fromdate", "todate")}).write.option("header", True).option(
        "escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option(
        "compression", "gzip").option("maxRecordsPerFile", 250_000).csv(path)
    return read_csv(spark, path, table)


def _csv_texts(flow: Flow) -> DataFrame:
    """Whole documents as observation values: quotes, line breaks, any script."""
    spark = flow.spark
    path = _scratch(spark, "observations")
    documents = spark.read.parquet(f"{flow.sf_dir.rstrip('/')}/documents.parquet")
    documents.select(
        F.col("doc_id").cast("string").alias("code"),
        F.col("lang").alias("category"),
        F.col("source").alias("description"),
        F.col("text").alias("value"),
        F.lit("text").alias("type"),
    ).write.option("header", True).option("escape", '"').option("quoteAll", True).option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    return read_csv(spark, path, "observations").select(
        "code", "category", "description", F.md5("value").alias("value_md5"), "type", "units"
    )


# --- reports ---


def _duplicates(flow: Flow) -> DataFrame:
    return _union([
        duplicate_summary(flow.raw(t), t, spec.record_key) for t, spec in BRONZE.items()
    ])


def _orphans(flow: Flow) -> DataFrame:
    return _union([
        orphan_summary(flow.raw(child), child, column, flow.raw(parent), parent)
        for child, column, parent in REFERENCES
    ])


def _gold_checks(flow: Flow) -> DataFrame:
    # Dimensions, numbering, facts and the calendar are jobs of their own, and all read silver: it is computed once.
    return checks.gold_layer(Flow(flow.spark, flow.sf_dir, store_silver=True).gold())


def _registry() -> dict[str, Callable[[Flow], DataFrame]]:
    entries: dict[str, Callable[[Flow], DataFrame]] = {}
    for table in BRONZE:
        entries[f"bronze_{table}"] = lambda f, t=table: bronze.increment(
            f.raw(t), empty(f.spark, bronze_schema(t)), t,
            F.col("fromdate") if t == "claims_transactions" else AS_OF,
        )
    entries["anti_join_rehash"] = Flow.claims_increment
    for table in BRONZE:
        entries[f"silver_{table}"] = lambda f, t=table: f.silver(t)
    entries["latest_version"] = lambda f: silver.claims(f.claims_history(), AS_OF)
    for table in BRONZE:
        entries[f"dq_{table}"] = lambda f, t=table: f.checks(t)
    entries |= {
        "dim_date_claims": lambda f: gold.dim_date(
            gold.first_claim_day(f.silver("claims")), AS_OF),
        "dim_date_encounters": lambda f: gold.dim_date(
            gold.first_encounter_day(f.silver("encounters")), AS_OF),
        "dim_date": lambda f: f.dim("date"),
        "dim_patients": lambda f: f.dim("patients"),
        "dim_payers": lambda f: f.dim("payers"),
        "dim_conditions": lambda f: f.dim("conditions"),
        "fact_claims": Flow.fact_claims,
        "fact_encounters": Flow.fact_encounters,
        "q1_revenue_cycle": lambda f: answers.revenue_cycle(
            f.claims_with_payer(), f.dim("payers")),
        "payer_settlement": lambda f: answers.payer_settlement(
            f.claims_with_payer(), f.dim("payers")),
        "q2_readmission": lambda f: answers.readmission(f.admissions()),
        "q2_readmission_preview": lambda f: answers.readmission_preview(f.admissions()),
        "dq_failed": lambda f: answers.failed_checks(f.log()),
        "dq_trend": lambda f: answers.check_trend(f.log()),
        "dq_log": lambda f: f.log(),
        "duplicate_keys": _duplicates,
        "fk_orphans": _orphans,
        "duplicate_hashes": lambda f: checks.unique_hashes(f.all_of(f.bronze)),
        "check_populated": lambda f: checks.populated(f.all_of(f.bronze)),
        "check_pass_rates": lambda f: checks.pass_rates(f.all_of(f.silver)),
        "check_dq_log": lambda f: checks.log_status(f.log()),
        "check_gold": _gold_checks,
        "stored_revenue_cycle": lambda f: stored.revenue_cycle(f, AS_OF),
        "stored_readmission": lambda f: stored.readmission(f, AS_OF),
        "stored_second_load": lambda f: stored.second_load(f, AS_OF),
        "stored_log_of_two_runs": lambda f: stored.log_of_two_runs(f, AS_OF),
        "raw_populated": lambda f: stored.raw_populated(f, AS_OF),
        "keys_after_new_payer": lambda f: stored.keys_after_new_payer(f, AS_OF),
        "refresh_twice": lambda f: stored.refresh_twice(f, AS_OF),
        **{name: lambda f, make=make: make(f, AS_OF) for name, make in {
            "bronze_three_loads": stored.three_loads,
            "silver_merge": stored.silver_merge,
            "fact_claims_merged": stored.fact_claims_merged,
            "fact_encounters_merged": stored.fact_encounters_merged,
            "keys_after_a_gap": stored.keys_after_a_gap,
            "csv_folder_load": stored.folder_load,
            "run_summary": stored.run_summary,
            "answers_in_order": stored.answers_in_order,
            "raw_duplicates": stored.raw_duplicates,
            "raw_orphans": stored.raw_orphans,
            "gold_meaning": stored.gold_meaning,
        }.items()},
        "csv_roundtrip": _csv_transactions,
        "csv_all_columns": _csv_all_columns,
        "csv_roundtrip_text": _csv_texts,
    }
    return entries


def queries() -> dict[str, Query]:
    return {
        name: lambda spark, sf_dir, make=make: comparable(make(Flow(spark, sf_dir)))
        for name, make in _registry().items()
    }
