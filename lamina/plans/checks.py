"""Layer checks: rows of (check, table_name, value, ok)."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.operators.integrity import duplicate_summary, orphan_summary
from lamina.operators.quality import passed_rows

# References from facts to dimensions.
GOLD_REFERENCES = (
    ("fact_claims", "patient_key", "dim_patients", "patient_key"),
    ("fact_claims", "payer_key", "dim_payers", "payer_key"),
    ("fact_claims", "service_date_key", "dim_date", "date_key"),
    ("fact_encounters", "patient_key", "dim_patients", "patient_key"),
    ("fact_encounters", "payer_key", "dim_payers", "payer_key"),
    ("fact_encounters", "date_key", "dim_date", "date_key"),
)
# What a fact's surrogate key stands for: the record it came from, and that record's natural key.
GOLD_MEANING = (
    ("fact_claims", "claim_id", "claims", "id", "payer_id", "payer_key", "dim_payers"),
    ("fact_claims", "claim_id", "claims", "id", "patient_id", "patient_key", "dim_patients"),
    ("fact_encounters", "encounter_id", "encounters", "id", "payer_id", "payer_key", "dim_payers"),
    ("fact_encounters", "encounter_id", "encounters", "id", "patient_id", "patient_key", "dim_patients"),
)
GOLD_NATURAL_KEYS = (
    ("dim_date", "date_key"),
    ("dim_patients", "patient_id"),
    ("dim_payers", "payer_id"),
    ("dim_conditions", "code"),
)
GOLD_FLAGS = (
    ("fact_encounters", "has_active_careplan"),
    ("fact_encounters", "is_readmission"),
    ("dim_conditions", "condition_category"),
)
PASS_RATE = 95.0


def _row(check: str, table: str, value: Column, ok: Column) -> list[Column]:
    return [
        F.lit(check).alias("check"),
        F.lit(table).alias("table_name"),
        value.cast("double").alias("value"),
        F.coalesce(ok, F.lit(False)).alias("ok"),
    ]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def populated(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every table has rows."""
    rows = F.count(F.lit(1))
    return _union([t.agg(*_row("has rows", name, rows, rows > 0)) for name, t in tables.items()])


def unique_hashes(bronze: Mapping[str, DataFrame]) -> DataFrame:
    """No row hash twice. Hashes are counted per value, copies merge map-side."""
    frames = []
    for name, table in bronze.items():
        counts = table.groupBy("_row_hash").agg(F.count(F.lit(1)).alias("copies"))
        surplus = F.coalesce(F.sum(F.col("copies") - 1), F.lit(0))
        frames.append(counts.agg(*_row("no duplicate row hash", name, surplus, surplus == 0)))
    return _union(frames)


def pass_rates(silver: Mapping[str, DataFrame]) -> DataFrame:
    """Share of PASS rows, for the tables that carry a row status."""
    return _union([
        t.agg(*_row("pass rate", name, F.expr(passed_rows()), F.expr(passed_rows()) >= PASS_RATE))
        for name, t in silver.items()
        if "_dq_status" in t.columns
    ])


def log_status(log: DataFrame) -> DataFrame:
    """Failed checks per table."""
    failed = F.count_if(F.col("status") == "FAILED")
    return log.groupBy("table_name").agg(failed.alias("failed")).select(
        F.lit("logged checks passed").alias("check"),
        "table_name",
        F.col("failed").cast("double").alias("value"),
        (F.col("failed") == 0).alias("ok"),
    )


def gold_references(gold: Mapping[str, DataFrame]) -> DataFrame:
    """Every fact key points at a dimension row."""
    frames = []
    for fact, column, dim, key in GOLD_REFERENCES:
        summary = orphan_summary(gold[fact], fact, column, gold[dim], dim, key)
        frames.append(
            summary.select(
                *_row(f"{column} resolves", fact, F.col("orphan_rows"), F.col("orphan_rows") == 0)
            )
        )
    return _union(frames)


def gold_meaning(gold: Mapping[str, DataFrame], silver: Mapping[str, DataFrame]) -> DataFrame:
    """Every fact key points at the dimension row of the natural key its record has.

    A key that resolves can still be a wrong one; this is the check that would see it.
    """
    frames = []
    for fact, fact_id, record, record_id, natural, key, dim in GOLD_MEANING:
        pairs = gold[fact].where(F.col(key).isNotNull()).select(F.col(fact_id).alias("_id"), key).join(
            silver[record].select(F.col(record_id).alias("_id"), natural), "_id")
        # Few pairs of key and natural key: counted before they meet the dimension.
        counts = pairs.groupBy(key, natural).agg(F.count(F.lit(1)).alias("_rows"))
        meant = gold[dim].select(key, F.col(natural).alias("_meant"))
        wrong = F.coalesce(F.sum(F.when(~F.col(natural).eqNullSafe(F.col("_meant")), F.col("_rows"))), F.lit(0))
        frames.append(counts.join(meant, key, "left").agg(*_row(f"{key} means {natural}", fact, wrong, wrong == 0)))
    return _union(frames)


def gold_flags(gold: Mapping[str, DataFrame]) -> DataFrame:
    """Precomputed flags are never NULL."""
    frames = []
    for table, column in GOLD_FLAGS:
        missing = F.count_if(F.col(column).isNull())
        frames.append(gold[table].agg(*_row(f"{column} set", table, missing, missing == 0)))
    return _union(frames)


def gold_keys(gold: Mapping[str, DataFrame]) -> DataFrame:
    """Every natural key occurs once in its dimension."""
    return _union([
        duplicate_summary(gold[table], table, [key]).select(
            *_row(f"{key} unique", table, F.col("surplus_rows"), F.col("surplus_rows") == 0)
        )
        for table, key in GOLD_NATURAL_KEYS
    ])


def gold_layer(gold: Mapping[str, DataFrame]) -> DataFrame:
    return _union([gold_references(gold), gold_keys(gold), gold_flags(gold)])
