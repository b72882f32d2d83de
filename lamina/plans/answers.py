"""Published questions, answered from the gold tables and the check log.

Joins to a dimension happen after grouping by its key, so only one row per
payer and class meets the dimension. Result order is that of the published
queries (descending: NULLs first, ascending: NULLs last).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.functions.columns import exact_ratio
from lamina.plans.gold import ACUTE_CLASSES


def _with_payer(grouped: DataFrame, dim_payers: DataFrame) -> DataFrame:
    return grouped.join(dim_payers.select("payer_key", "name", "ownership"), "payer_key")


def revenue_cycle(fact_claims: DataFrame, dim_payers: DataFrame) -> DataFrame:
    """Open claims: outstanding balance and days to payment by payer and class."""
    grouped = (
        fact_claims.where("claim_status = 'OPEN'")
        .groupBy("payer_key", "encounter_class")
        .agg(
            F.sum("avg_days_to_payment").alias("days"),
            F.count("avg_days_to_payment").alias("paid"),
            F.sum("total_outstanding").alias("due"),
        )
    )
    return (
        _with_payer(grouped, dim_payers)
        .groupBy(F.col("name").alias("payer"), "ownership", "encounter_class")
        .agg(
            exact_ratio(F.sum("days"), F.sum("paid"), 1).alias("avg_days_to_payment"),
            F.round(F.sum("due"), 2).alias("total_outstanding"),
        )
        .orderBy(F.desc_nulls_first("total_outstanding"))
    )


def payer_settlement(fact_claims: DataFrame, dim_payers: DataFrame) -> DataFrame:
    """Mean days to payment by ownership, fastest first."""
    grouped = (
        fact_claims.where("avg_days_to_payment is not null")
        .groupBy("payer_key")
        .agg(
            F.sum("avg_days_to_payment").alias("days"),
            F.count(F.lit(1)).alias("paid"),
        )
    )
    return (
        _with_payer(grouped, dim_payers)
        .groupBy("ownership")
        .agg(exact_ratio(F.sum("days"), F.sum("paid"), 1).alias("avg_days"))
        .orderBy(F.asc_nulls_last("avg_days"))
    )


def _readmissions(fact_encounters: DataFrame, rows: str, rate: str, digits: int) -> DataFrame:
    returned = F.sum(F.col("is_readmission").cast("int"))
    return (
        fact_encounters.where(F.col("encounter_class").isin(*ACUTE_CLASSES))
        .groupBy("has_active_careplan")
        .agg(
            F.count(F.lit(1)).alias(rows),
            returned.alias("readmissions"),
            exact_ratio(returned * 100, F.count(F.lit(1)), digits).alias(rate),
        )
    )


def readmission(fact_encounters: DataFrame) -> DataFrame:
    """Readmission rate with and without an active care plan."""
    return _readmissions(fact_encounters, "total_encounters", "readmission_rate_pct", 2)


def readmission_preview(fact_encounters: DataFrame) -> DataFrame:
    """The same at one decimal, under the short names of the spot check."""
    return _readmissions(fact_encounters, "encounters", "readmission_pct", 1)


def failed_checks(log: DataFrame) -> DataFrame:
    """Failed checks, newest first."""
    return (
        log.where("status = 'FAILED'")
        .orderBy(F.desc_nulls_first("checked_at"))
        .select(
            "run_id", "table_name", "column_name", "metric_type",
            F.round("metric_value", 1).alias("value"), "threshold",
        )
    )


def check_trend(log: DataFrame) -> DataFrame:
    """Number and mean value of checks by table and status."""
    return (
        log.groupBy("table_name", "status")
        .agg(
            F.count(F.lit(1)).alias("checks"),
            F.round(F.avg("metric_value"), 1).alias("avg_value"),
        )
        .orderBy("table_name")
    )
