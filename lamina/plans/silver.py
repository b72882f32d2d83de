"""Silver: newest version of each record, cleaned, de-identified, flagged."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions.columns import (
    elapsed_days, elapsed_minutes, lower_trim, moment, money, or_zero, upper_trim,
)
from lamina.operators.latest import latest_version
from lamina.operators.quality import Check, gte_zero, in_set, not_null, passed_rows
from lamina.operators.versions import newest_of_stored


def _flags(note: Column) -> list[Column]:
    """Row status and note. Every warning has a note, so the note decides."""
    return [
        F.when(note.isNotNull(), "WARN").otherwise("PASS").alias("_dq_status"),
        note.alias("_dq_notes"),
    ]


def _processed(as_of: datetime) -> Column:
    return moment(as_of).alias("_silver_processed_at")


def _encounters(as_of: datetime) -> list[Column | str]:
    note = F.when(F.col("total_claim_cost") < 0, "negative total_claim_cost").when(
        F.col("stop") < F.col("start"), "stop timestamp before start"
    )
    return [
        "id",
        F.col("patient").alias("patient_id"),
        F.col("payer").alias("payer_id"),
        lower_trim("encounterclass").alias("encounter_class"),
        F.col("start").alias("start_ts"),
        F.col("stop").alias("stop_ts"),
        elapsed_minutes("start", "stop").alias("duration_minutes"),
        "base_encounter_cost",
        "total_claim_cost",
        "payer_coverage",
        money(or_zero("total_claim_cost") - or_zero("payer_coverage")).alias("patient_oop"),
        *_flags(note),
        _processed(as_of),
    ]


def _payers(as_of: datetime) -> list[Column | str]:
    """Payers carry no row flags."""
    return [
        "id",
        F.trim("name").alias("name"),
        upper_trim("ownership").alias("ownership"),
        "amount_covered",
        "amount_uncovered",
        _processed(as_of),
    ]


def _claims(as_of: datetime) -> list[Column | str]:
    """A claim is closed only when all three statuses say so.

    Statuses are upper-cased but not trimmed: ' CLOSED' counts as open, and so
    does a missing status.
    """
    closed = (
        (F.upper("status1") == "CLOSED")
        & (F.upper("status2") == "CLOSED")
        & (F.upper("statusp") == "CLOSED")
    )
    due = or_zero("outstanding1") + or_zero("outstanding2") + or_zero("outstandingp")
    return [
        "id",
        F.col("patientid").alias("patient_id"),
        F.col("primarypatientinsuranceid").alias("payer_id"),
        F.col("servicedate").alias("service_date"),
        F.when(closed, "CLOSED").otherwise("OPEN").alias("claim_status"),
        money(due).alias("total_outstanding"),
        F.col("lastbilleddate1").alias("last_billed_date"),
        *_flags(F.when(F.col("patientid").isNull(), "missing patient_id")),
        _processed(as_of),
    ]


def _claims_transactions(as_of: datetime) -> list[Column | str]:
    note = F.when(F.col("claimid").isNull(), "missing claim_id").when(
        F.col("amount") < 0, "negative amount"
    )
    days = F.when(upper_trim("type") == "PAYMENT", elapsed_days("fromdate", "todate"))
    return [
        "id",
        F.col("claimid").alias("claim_id"),
        F.col("patientid").alias("patient_id"),
        upper_trim("type").alias("transaction_type"),
        "amount",
        upper_trim("method").alias("payment_method"),
        F.col("fromdate").alias("from_date"),
        F.col("todate").alias("to_date"),
        days.alias("days_to_payment"),
        "payments",
        "adjustments",
        "outstanding",
        *_flags(note),
        _processed(as_of),
    ]


# Oldest age of each group but the last.
_AGE_GROUPS = ((17, "0-17"), (34, "18-34"), (50, "35-50"), (65, "51-65"))
_OLDEST_GROUP = "65+"


def _age_group(birth_year: Column, as_of: datetime) -> Column:
    """Group by year difference. An unknown birth year lands in the oldest group."""
    age = F.lit(as_of.year) - birth_year
    (limit, name), *others = _AGE_GROUPS
    group = F.when(age <= limit, name)
    for limit, name in others:
        group = group.when(age <= limit, name)
    return group.otherwise(_OLDEST_GROUP)


def _patients(as_of: datetime) -> list[Column | str]:
    """Exact birth and death dates do not leave bronze."""
    sex = upper_trim("gender")
    return [
        "id",
        F.year("birthdate").alias("birth_year"),
        _age_group(F.year("birthdate"), as_of).alias("age_group"),
        F.when(sex.isin("M", "MALE"), "Male")
        .when(sex.isin("F", "FEMALE"), "Female")
        .otherwise("Unknown")
        .alias("gender"),
        F.trim("race").alias("race"),
        F.trim("ethnicity").alias("ethnicity"),
        F.col("deathdate").isNotNull().alias("is_deceased"),
        *_flags(F.when(F.col("birthdate").isNull(), "missing birthdate — age_group unknown")),
        _processed(as_of),
    ]


_NO_ENCOUNTER = "missing encounter_id"


def _conditions(as_of: datetime) -> list[Column | str]:
    """No id in the source: patient, encounter and the untrimmed code name a record."""
    return [
        F.col("patient").alias("patient_id"),
        F.col("encounter").alias("encounter_id"),
        F.trim("code").alias("code"),
        F.trim("description").alias("description"),
        F.col("start").alias("start_date"),
        F.col("stop").alias("end_date"),
        F.col("stop").isNull().alias("is_active"),
        *_flags(F.when(F.col("encounter").isNull(), _NO_ENCOUNTER)),
        _processed(as_of),
    ]


def _careplans(as_of: datetime) -> list[Column | str]:
    """Newest per id first, then the patient test: plans without id share one slot."""
    return [
        "id",
        F.col("patient").alias("patient_id"),
        F.col("encounter").alias("encounter_id"),
        F.trim("code").alias("code"),
        F.trim("description").alias("description"),
        F.col("start").alias("start_date"),
        F.col("stop").alias("end_date"),
        F.col("stop").isNull().alias("is_active"),
        F.trim("reasoncode").alias("reason_code"),
        F.trim("reasondescription").alias("reason_description"),
        *_flags(F.when(F.col("encounter").isNull(), _NO_ENCOUNTER)),
        _processed(as_of),
    ]


@dataclass(frozen=True)
class Silver:
    """How a silver table follows from bronze: newest row of each key, then columns row by row."""

    columns: Callable[[datetime], list[Column | str]]
    keys: tuple[str, ...] = ("id",)
    known: str | None = "id is not null"  # bronze rows that take part
    wanted: str | None = None  # newest rows that stay


SILVER = {
    "encounters": Silver(_encounters),
    "payers": Silver(_payers),
    "claims": Silver(_claims),
    "claims_transactions": Silver(_claims_transactions),
    "patients": Silver(_patients),
    "conditions": Silver(_conditions, ("patient", "encounter", "code"), "patient is not null"),
    "careplans": Silver(_careplans, known=None, wanted="patient is not null"),
}


def newest(bronze: DataFrame, table: str) -> DataFrame:
    """Newest version of each record, as bronze has it. Taking it of parts and then of what is left changes nothing."""
    return latest_version(known(bronze, table), SILVER[table].keys)


def newest_stored(bronze: DataFrame, table: str) -> DataFrame:
    """The same of stored bronze, or of rows of it; runs jobs to see which records have several versions."""
    return newest_of_stored(known(bronze, table), SILVER[table].keys)


def known(bronze: DataFrame, table: str) -> DataFrame:
    """Bronze rows that take part."""
    wanted = SILVER[table].known
    return bronze.where(wanted) if wanted else bronze


def shaped(rows: DataFrame, table: str, as_of: datetime, *more: str) -> DataFrame:
    """Silver columns of newest rows, after the columns `more`."""
    spec = SILVER[table]
    return (rows.where(spec.wanted) if spec.wanted else rows).select(*more, *spec.columns(as_of))


def _builder(table: str) -> Callable[[DataFrame, datetime], DataFrame]:
    return lambda bronze, as_of: shaped(newest(bronze, table), table, as_of)


BUILDERS = {table: _builder(table) for table in SILVER}
encounters, payers, claims, claims_transactions, patients, conditions, careplans = BUILDERS.values()

# The checks logged for each silver table.
_ENCOUNTER_CLASSES = (
    "wellness", "ambulatory", "outpatient", "urgentcare", "emergency",
    "inpatient", "home", "snf", "hospice", "virtual",
)
CHECKS: dict[str, list[Check]] = {
    "encounters": [
        Check(None, "completeness", passed_rows(), 95),
        Check("id", "completeness", not_null("id"), 100),
        Check("patient_id", "completeness", not_null("patient_id"), 100),
        Check("encounter_class", "validity", in_set("encounter_class", _ENCOUNTER_CLASSES), 95),
        Check("total_claim_cost", "accuracy", gte_zero("total_claim_cost"), 99),
    ],
    "payers": [
        Check("id", "completeness", not_null("id"), 100),
        Check("ownership", "validity", in_set("ownership", ("GOVERNMENT", "PRIVATE")), 90),
    ],
    "claims": [
        Check(None, "completeness", passed_rows(), 95),
        Check("id", "completeness", not_null("id"), 100),
        Check("patient_id", "completeness", not_null("patient_id"), 95),
        Check("claim_status", "validity", in_set("claim_status", ("OPEN", "CLOSED")), 100),
        Check("total_outstanding", "accuracy", gte_zero("total_outstanding"), 99),
    ],
    "claims_transactions": [
        Check(None, "completeness", passed_rows(), 95),
        Check("claim_id", "completeness", not_null("claim_id"), 99),
        Check("transaction_type", "validity",
              in_set("transaction_type", ("CHARGE", "PAYMENT", "TRANSFERIN", "TRANSFEROUT")), 99),
        Check("amount", "accuracy", gte_zero("amount"), 95),
    ],
    "patients": [
        Check(None, "completeness", passed_rows(), 95),
        Check("id", "completeness", not_null("id"), 100),
        Check("birth_year", "completeness", not_null("birth_year"), 95),
        Check("birth_year", "validity", in_set("birth_year", range(1900, 2027)), 99),
        Check("gender", "validity", in_set("gender", ("Male", "Female", "Unknown")), 100),
        Check("age_group", "validity",
              in_set("age_group", [g for _, g in _AGE_GROUPS] + [_OLDEST_GROUP]), 100),
    ],
    "conditions": [
        Check(None, "completeness", passed_rows(), 95),
        Check("patient_id", "completeness", not_null("patient_id"), 100),
        Check("code", "completeness", not_null("code"), 100),
        Check("start_date", "completeness", not_null("start_date"), 95),
    ],
    "careplans": [
        Check(None, "completeness", passed_rows(), 95),
        Check("patient_id", "completeness", not_null("patient_id"), 100),
        Check("code", "completeness", not_null("code"), 100),
    ],
}
