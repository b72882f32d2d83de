"""Gold: dimensions, facts and their precomputed measures."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from lamina.functions.columns import date_key, exact_ratio, money, or_zero, padded_name
from lamina.operators.latest import first_per_key
from lamina.operators.skew import balanced_lookups
from lamina.operators.surrogate import dense_keys, stable_keys

# The days within which a stay counts as a readmission, and the classes it looks at.
READMISSION_DAYS = 30
ACUTE_CLASSES = ("inpatient", "emergency")

# Words that make a condition chronic, anywhere, in any case.
CHRONIC_WORDS = (
    "chronic", "disorder", "disease", "syndrome", "diabetes", "hypertension",
    "asthma", "failure", "obesity", "depression", "anxiety", "cancer",
    "leukemia", "anemia",
)


# --- dimensions ----------------------------------------------------------


def first_claim_day(claims: DataFrame) -> DataFrame:
    return claims.agg(F.min("service_date").cast("date").alias("first_day"))


def first_encounter_day(encounters: DataFrame) -> DataFrame:
    return encounters.agg(F.min("start_ts").cast("date").alias("first_day"))


def first_warehouse_day(claims: DataFrame, encounters: DataFrame) -> DataFrame:
    """The earlier of both starts: one calendar that serves both facts."""
    return (
        first_claim_day(claims)
        .unionByName(first_encounter_day(encounters))
        .agg(F.min("first_day").alias("first_day"))
    )


def dim_date(first_day: DataFrame, as_of: datetime) -> DataFrame:
    """One row per day from `first_day` (a one-row frame) to the day of `as_of`.

    No rows when there is no first day or it lies after `as_of`.
    """
    last = F.lit(as_of.date())
    span = F.when(
        F.col("first_day") <= last,
        F.sequence("first_day", last, F.expr("interval 1 day")),
    )
    days = first_day.select(F.explode(span).alias("full_date"))
    return days.select(
        date_key(F.col("full_date")).alias("date_key"),
        "full_date",
        padded_name("full_date", "EEEE").alias("day_of_week"),
        F.dayofmonth("full_date").alias("day_of_month"),
        F.weekofyear("full_date").alias("week_of_year"),
        F.month("full_date").alias("month"),
        padded_name("full_date", "MMMM").alias("month_name"),
        F.quarter("full_date").alias("quarter"),
        F.year("full_date").alias("year"),
        F.dayofweek("full_date").isin(1, 7).alias("is_weekend"),
    )


def dim_patients(patients: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """`known`: the dimension as stored; its patients keep their keys."""
    return _entity_dim(
        patients, "patient", ["age_group", "gender", "race", "ethnicity", "is_deceased"], known
    )


def dim_payers(payers: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """`known`: the dimension as stored; its payers keep their keys."""
    return _entity_dim(payers, "payer", ["name", "ownership"], known)


def _entity_dim(
    silver: DataFrame, entity: str, columns: list[str], known: DataFrame | None
) -> DataFrame:
    """One row per natural key with a surrogate key, dense when nothing is known."""
    rows = silver.where("id is not null").select(F.col("id").alias(f"{entity}_id"), *columns)
    return stable_keys(
        rows, f"{entity}_id", f"{entity}_key", [F.asc_nulls_last(c) for c in columns], known
    )


def dim_conditions(conditions: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """First description per code, and whether it reads as chronic.

    Distinct pairs first: a hash aggregate shrinks the table to the few
    (code, description) pairs before anything is sorted.
    """
    patterns = ", ".join(f"'%{word}%'" for word in CHRONIC_WORDS)
    chronic = F.expr(f"description ilike any ({patterns})")
    rows = (
        conditions.where("code is not null")
        .select("code", "description")
        .distinct()
        .groupBy("code")
        .agg(F.min("description").alias("description"))
        .withColumn("condition_category", F.when(chronic, "Chronic").otherwise("Acute"))
    )
    return stable_keys(rows, "code", "condition_key", known=known)


# --- claims --------------------------------------------------------------


def transaction_totals(transactions: DataFrame) -> DataFrame:
    """Per claim: payments, adjustments and mean days to payment."""
    days = F.when(F.col("transaction_type") == "PAYMENT", F.col("days_to_payment")).cast("bigint")
    return (
        transactions.where("claim_id is not null")
        .groupBy("claim_id")
        .agg(
            money(F.sum("payments")).alias("total_payments"),
            money(F.sum("adjustments")).alias("total_adjustments"),
            exact_ratio(F.sum(days), F.count(days), 2)
            .cast("decimal(10,2)")
            .alias("avg_days_to_payment"),
        )
    )


def first_encounter_of_day(encounters: DataFrame) -> DataFrame:
    """Per patient and calendar day: the earliest encounter, ties by id."""
    rows = encounters.where("patient_id is not null and start_ts is not null").select(
        "patient_id",
        F.col("start_ts").cast("date").alias("service_day"),
        "start_ts",
        "id",
        "encounter_class",
        "total_claim_cost",
        "payer_coverage",
        "patient_oop",
    )
    return first_per_key(rows, ["patient_id", "service_day"], [F.asc("start_ts"), F.asc("id")]).drop(
        "start_ts", "id"
    )


def _with_keys(base: DataFrame, natural_key: str, key_name: str) -> DataFrame:
    """Number a fact by its id column alone, then join on the id.

    Only the ids go through the range partitioning and the checkpoint; the
    wide rows meet their keys where they are partitioned by id anyway.
    """
    return dense_keys(base.select(natural_key), natural_key, key_name).join(base, natural_key)


Lookup = tuple[DataFrame, list[str]]  # a table, and the columns it is unique on


def patient_lookup(dim_patients: DataFrame) -> Lookup:
    return dim_patients.select("patient_id", "patient_key"), ["patient_id"]


def payer_lookup(dim_payers: DataFrame) -> Lookup:
    return dim_payers.select("payer_id", "payer_key"), ["payer_id"]


def claim_measures(
    claims: DataFrame, transactions: DataFrame, encounters: DataFrame,
    lookups: Sequence[Lookup] = (), numbered: bool = False,
) -> DataFrame:
    """One row per claim with a service date, with its measures and what is looked up.

    Claim and encounter are linked by patient and day. The same earliest
    encounter supplies class and money, so one lookup serves both.
    """
    rows, totals = _dated(claims), transaction_totals(transactions)
    keyed = _with_keys(rows, "claim_id", "claim_key") if numbered else rows
    return _claim_measures(rows, keyed, totals, encounters, lookups)


def _dated(claims: DataFrame) -> DataFrame:
    return claims.where("service_date is not null").select(
        F.col("id").alias("claim_id"),
        "patient_id",
        "payer_id",
        F.col("service_date").cast("date").alias("service_day"),
        "claim_status",
        "total_outstanding",
    )


def _claim_measures(
    base: DataFrame, rows: DataFrame, totals: DataFrame, encounters: DataFrame, lookups: Sequence[Lookup],
) -> DataFrame:
    # Claim ids are unique on all sides: plain joins, one partitioning.
    rows = rows.join(totals, "claim_id", "left")
    by_day = (first_encounter_of_day(encounters), ["patient_id", "service_day"])
    rows = balanced_lookups(rows, [by_day, *lookups], spread_by=F.col("claim_id"), probe=base)
    return rows.withColumns({
        "encounter_class": F.coalesce("encounter_class", F.lit("unknown")),
        "total_payments": or_zero("total_payments"),
        "total_adjustments": or_zero("total_adjustments"),
    })


def fact_claims(
    claims: DataFrame, transactions: DataFrame, encounters: DataFrame,
    dim_patients: DataFrame, dim_payers: DataFrame,
) -> DataFrame:
    """One row per claim with a service date."""
    lookups = [patient_lookup(dim_patients), payer_lookup(dim_payers)]
    return _fact_columns(claim_measures(claims, transactions, encounters, lookups, numbered=True))


def fact_claims_of(
    claims: DataFrame, totals: DataFrame, encounters: DataFrame, dim_patients: DataFrame, dim_payers: DataFrame,
    keys: DataFrame,
) -> DataFrame:
    """The same from totals (as `transaction_totals` has them) and keys (claim_id, claim_key) that are known already."""
    base, lookups = _dated(claims), [patient_lookup(dim_patients), payer_lookup(dim_payers)]
    return _fact_columns(_claim_measures(base, base.join(keys, "claim_id"), totals, encounters, lookups))


def _fact_columns(measures: DataFrame) -> DataFrame:
    return measures.select(
        "claim_key",
        "claim_id",
        "patient_key",
        "payer_key",
        date_key(F.col("service_day")).alias("service_date_key"),
        "encounter_class",
        "claim_status",
        "total_claim_cost",
        "payer_coverage",
        "patient_oop",
        "total_outstanding",
        "total_payments",
        "total_adjustments",
        "avg_days_to_payment",
    )


# --- encounters ----------------------------------------------------------


def fresh_acute_encounters(encounters: DataFrame) -> DataFrame:
    """Ids of inpatient and emergency encounters that are *not* readmissions.

    An encounter is a readmission when the patient's previous encounter, of any
    class, started at most 30 days before it. Only the first encounter of a
    patient's day can fail that test, since any later one follows another on
    the same day. So each patient-day is reduced to its first encounter and its
    last start, map-side, and lag() runs over days: a patient with a third of
    all encounters still has no more rows here than the calendar has days.
    """
    return fresh_of_days(patient_days(encounters))


def patient_days(encounters: DataFrame) -> DataFrame:
    """First encounter and last start of each patient's day."""
    starts = encounters.where("start_ts is not null")
    return starts.groupBy("patient_id", F.col("start_ts").cast("date").alias("day")).agg(
        F.min(F.struct("start_ts", "id", "encounter_class")).alias("first"),
        F.max("start_ts").alias("last_start"),
    )


def fresh_of_days(days: DataFrame) -> DataFrame:
    """`fresh_acute_encounters` of all days of some patients."""
    by_patient = Window.partitionBy("patient_id").orderBy("day")
    previous = F.lag("last_start").over(by_patient)
    limit = F.col("first.start_ts") - F.expr(f"interval {READMISSION_DAYS} days")
    return (
        days.withColumn("is_readmission", F.coalesce(previous >= limit, F.lit(False)))
        .where(F.col("first.encounter_class").isin(*ACUTE_CLASSES) & ~F.col("is_readmission"))
        .select(F.col("first.id").alias("encounter_id"), F.lit(True).alias("is_fresh"))
    )


def earliest_active_plan(careplans: DataFrame) -> DataFrame:
    """Per patient: when the first of the still active care plans started.

    A plan is active at an encounter when it started by that day, so the
    earliest start answers for all plans of the patient.
    """
    return (
        careplans.where("is_active and patient_id is not null")
        .groupBy("patient_id")
        .agg(F.min("start_date").alias("plan_start"))
    )


def patient_profile(dim_patients: DataFrame, careplans: DataFrame) -> DataFrame:
    """Per patient: surrogate key and start of the earliest active care plan.

    Both are looked up by patient, so they travel together in one table and the
    encounters are shuffled by patient once. Patients may miss in either input.
    """
    keys = dim_patients.select(
        "patient_id", "patient_key", F.lit(None).cast("date").alias("plan_start")
    )
    plans = careplans.where("is_active and patient_id is not null").select(
        "patient_id", F.lit(None).cast("bigint").alias("patient_key"),
        F.col("start_date").alias("plan_start"),
    )
    return (
        keys.unionByName(plans)
        .groupBy("patient_id")
        .agg(F.max("patient_key").alias("patient_key"), F.min("plan_start").alias("plan_start"))
    )


def encounter_measures(
    encounters: DataFrame, conditions: DataFrame, profile: DataFrame,
    lookups: Sequence[Lookup] = (), numbered: bool = False,
) -> DataFrame:
    """One row per encounter with a start, with its measures and what is looked up.

    `profile` holds one row per patient with `plan_start`, and whatever else is
    to be looked up by patient.
    """
    base = _started(encounters)
    rows = _with_keys(base, "encounter_id", "encounter_key") if numbered else base
    return _encounter_measures(
        base, rows, condition_counts(conditions), fresh_acute_encounters(encounters), profile, lookups)


def _started(encounters: DataFrame) -> DataFrame:
    return encounters.where("start_ts is not null").select(
        F.col("id").alias("encounter_id"),
        "patient_id",
        "payer_id",
        F.col("start_ts").cast("date").alias("start_day"),
        "encounter_class",
        "duration_minutes",
        "total_claim_cost",
        "patient_oop",
    )


def condition_counts(conditions: DataFrame) -> DataFrame:
    return (
        conditions.where("encounter_id is not null")
        .groupBy("encounter_id")
        .agg(F.count(F.lit(1)).alias("condition_count"))
    )


def _encounter_measures(
    base: DataFrame, rows: DataFrame, counts: DataFrame, fresh: DataFrame, profile: DataFrame,
    lookups: Sequence[Lookup],
) -> DataFrame:
    # Encounter ids are unique on all sides: plain joins, one partitioning.
    rows = rows.join(counts, "encounter_id", "left").join(fresh, "encounter_id", "left")
    by_patient = (profile, ["patient_id"])
    rows = balanced_lookups(
        rows, [by_patient, *lookups], spread_by=F.col("encounter_id"), probe=base
    )
    acute = F.coalesce(F.col("encounter_class").isin(*ACUTE_CLASSES), F.lit(False))
    planned = F.coalesce(F.col("plan_start") <= F.col("start_day"), F.lit(False))
    return rows.withColumns({
        "condition_count": F.coalesce("condition_count", F.lit(0).cast("bigint")),
        "has_active_careplan": planned,
        "is_readmission": acute & F.col("is_fresh").isNull(),
    })


def fact_encounters(
    encounters: DataFrame, conditions: DataFrame, careplans: DataFrame,
    dim_patients: DataFrame, dim_payers: DataFrame,
) -> DataFrame:
    """One row per encounter with a start."""
    profile = patient_profile(dim_patients, careplans)
    lookups = [payer_lookup(dim_payers)]
    return _encounter_columns(
        encounter_measures(encounters, conditions, profile, lookups, numbered=True))


def fact_encounters_of(
    encounters: DataFrame, counts: DataFrame, fresh: DataFrame, careplans: DataFrame,
    dim_patients: DataFrame, dim_payers: DataFrame, keys: DataFrame,
) -> DataFrame:
    """The same from condition counts, fresh acute encounters and keys (encounter_id, encounter_key) that are known."""
    base, profile = _started(encounters), patient_profile(dim_patients, careplans)
    rows = base.join(keys, "encounter_id")
    return _encounter_columns(
        _encounter_measures(base, rows, counts, fresh, profile, [payer_lookup(dim_payers)]))


def _encounter_columns(measures: DataFrame) -> DataFrame:
    return measures.select(
        "encounter_key",
        "encounter_id",
        "patient_key",
        "payer_key",
        date_key(F.col("start_day")).alias("date_key"),
        "encounter_class",
        "duration_minutes",
        "total_claim_cost",
        "patient_oop",
        "condition_count",
        "has_active_careplan",
        "is_readmission",
    )
