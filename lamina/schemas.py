"""Table layouts: raw sources, bronze column choices, keys and references."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(15, 2)

_TYPES: dict[str, T.DataType] = {
    "uuid": T.StringType(),
    "text": T.StringType(),
    "money": MONEY,
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
}

# The raw table layouts, in load order (parents before children).
RAW_LAYOUTS: dict[str, str] = {
    "organizations": """
        id uuid, name text, address text, city text, state text, zip text,
        lat double, lon double, phone text, revenue money, utilization int,
        location text""",
    "payers": """
        id uuid, name text, ownership text, address text, city text,
        state_headquartered text, zip text, phone text, amount_covered money,
        amount_uncovered money, revenue money, covered_encounters int,
        uncovered_encounters int, covered_medications int,
        uncovered_medications int, covered_procedures int,
        uncovered_procedures int, covered_immunizations int,
        uncovered_immunizations int, unique_customers int, qols_avg double,
        member_months int""",
    "patients": """
        id uuid, birthdate date, deathdate date, ssn text, drivers text,
        passport text, prefix text, first text, last text, suffix text,
        maiden text, marital text, race text, ethnicity text, gender text,
        birthplace text, address text, city text, state text, county text,
        fips text, zip text, lat double, lon double, healthcare_expenses money,
        healthcare_coverage money, income int, location text""",
    "providers": """
        id uuid, organization uuid, name text, gender text, speciality text,
        address text, city text, state text, zip text, lat double, lon double,
        utilization int, location text""",
    "encounters": """
        id uuid, start timestamp, stop timestamp, patient uuid,
        organization uuid, provider uuid, payer uuid, encounterclass text,
        code text, description text, base_encounter_cost money,
        total_claim_cost money, payer_coverage money, reasoncode text,
        reasondescription text""",
    "conditions": """
        start date, stop date, patient uuid, encounter uuid, code text,
        description text""",
    "medications": """
        start timestamp, stop timestamp, patient uuid, payer uuid,
        encounter uuid, code text, description text, base_cost money,
        payer_coverage money, dispenses int, totalcost money, reasoncode text,
        reasondescription text""",
    "procedures": """
        start timestamp, stop timestamp, patient uuid, encounter uuid,
        code text, description text, base_cost money, reasoncode text,
        reasondescription text""",
    "observations": """
        date timestamp, patient uuid, encounter uuid, category text, code text,
        description text, value text, units text, type text""",
    "allergies": """
        start date, stop date, patient uuid, encounter uuid, code text,
        system text, description text, type text, category text,
        reaction1 text, description1 text, severity1 text, reaction2 text,
        description2 text, severity2 text""",
    "immunizations": """
        date timestamp, patient uuid, encounter uuid, code text,
        description text, base_cost money""",
    "careplans": """
        id uuid, start date, stop date, patient uuid, encounter uuid,
        code text, description text, reasoncode text, reasondescription text""",
    "imaging_studies": """
        id uuid, date timestamp, patient uuid, encounter uuid, series_uid text,
        bodysite_code text, bodysite_description text, modality_code text,
        modality_description text, instance_uid text, sop_code text,
        sop_description text, procedure_code text""",
    "devices": """
        start timestamp, stop timestamp, patient uuid, encounter uuid,
        code text, description text, udi text""",
    "supplies": """
        date date, patient uuid, encounter uuid, code text, description text,
        quantity int""",
    "payer_transitions": """
        patient uuid, memberid uuid, start_date timestamp, end_date timestamp,
        payer uuid, secondary_payer uuid, plan_ownership text,
        owner_name text""",
    "claims": """
        id uuid, patientid uuid, providerid uuid,
        primarypatientinsuranceid uuid, secondarypatientinsuranceid uuid,
        departmentid int, patientdepartmentid int, diagnosis1 text,
        diagnosis2 text, diagnosis3 text, diagnosis4 text, diagnosis5 text,
        diagnosis6 text, diagnosis7 text, diagnosis8 text,
        referringproviderid uuid, appointmentid uuid,
        currentillnessdate timestamp, servicedate timestamp,
        supervisingproviderid uuid, status1 text, status2 text, statusp text,
        outstanding1 money, outstanding2 money, outstandingp money,
        lastbilleddate1 timestamp, lastbilleddate2 timestamp,
        lastbilleddatep timestamp, healthcareclaimtypeid1 int,
        healthcareclaimtypeid2 int""",
    "claims_transactions": """
        id uuid, claimid uuid, chargeid int, patientid uuid, type text,
        amount money, method text, fromdate timestamp, todate timestamp,
        placeofservice uuid, procedurecode text, modifier1 text,
        modifier2 text, diagnosisref1 int, diagnosisref2 int,
        diagnosisref3 int, diagnosisref4 int, units int, departmentid int,
        notes text, unitamount money, transferoutid uuid, transfertype text,
        payments money, adjustments money, transfers money, outstanding money,
        appointmentid uuid, linenote text, patientinsuranceid uuid,
        feescheduleid int, providerid uuid, supervisingproviderid uuid""",
}

# Raw tables whose id is a primary key.
RAW_PRIMARY_KEYS = (
    "organizations", "payers", "patients", "providers", "encounters",
    "careplans", "imaging_studies", "claims", "claims_transactions",
)

# Raw references, child.column -> parent (always parent.id).
RAW_REFERENCES: dict[str, dict[str, str]] = {
    "providers": {"organization": "organizations"},
    "encounters": {
        "patient": "patients", "organization": "organizations",
        "provider": "providers", "payer": "payers",
    },
    "conditions": {"patient": "patients", "encounter": "encounters"},
    "medications": {"patient": "patients", "payer": "payers", "encounter": "encounters"},
    "procedures": {"patient": "patients", "encounter": "encounters"},
    "observations": {"patient": "patients", "encounter": "encounters"},
    "allergies": {"patient": "patients", "encounter": "encounters"},
    "immunizations": {"patient": "patients", "encounter": "encounters"},
    "careplans": {"patient": "patients", "encounter": "encounters"},
    "imaging_studies": {"patient": "patients", "encounter": "encounters"},
    "devices": {"patient": "patients", "encounter": "encounters"},
    "supplies": {"patient": "patients", "encounter": "encounters"},
    "payer_transitions": {
        "patient": "patients", "payer": "payers", "secondary_payer": "payers",
    },
    "claims": {
        "patientid": "patients", "providerid": "providers",
        "primarypatientinsuranceid": "payers", "appointmentid": "encounters",
        "supervisingproviderid": "providers",
    },
    "claims_transactions": {
        "claimid": "claims", "patientid": "patients",
        "placeofservice": "organizations", "appointmentid": "encounters",
        "providerid": "providers", "supervisingproviderid": "providers",
    },
}


@dataclass(frozen=True)
class RawColumn:
    name: str
    type: T.DataType
    is_uuid: bool


def raw_columns(table: str) -> list[RawColumn]:
    columns = []
    for item in RAW_LAYOUTS[table].split(","):
        name, kind = item.split()
        columns.append(RawColumn(name, _TYPES[kind], kind == "uuid"))
    return columns


def raw_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c.name, c.type) for c in raw_columns(table)])


@dataclass(frozen=True)
class BronzeSpec:
    """Which raw columns bronze keeps, and which of them name one record."""

    columns: tuple[str, ...]
    record_key: tuple[str, ...]
    source_file: str


# Columns copied to bronze. Everything else (names, addresses,
# identity numbers, ...) never leaves the raw layer.
BRONZE: dict[str, BronzeSpec] = {
    "encounters": BronzeSpec(
        ("id", "patient", "payer", "encounterclass", "start", "stop",
         "base_encounter_cost", "total_claim_cost", "payer_coverage"),
        ("id",), "encounters.csv"),
    "payers": BronzeSpec(
        ("id", "name", "ownership", "amount_covered", "amount_uncovered"),
        ("id",), "payers.csv"),
    "claims": BronzeSpec(
        ("id", "patientid", "primarypatientinsuranceid", "servicedate",
         "status1", "status2", "statusp", "outstanding1", "outstanding2",
         "outstandingp", "lastbilleddate1"),
        ("id",), "claims.csv"),
    "claims_transactions": BronzeSpec(
        ("id", "claimid", "patientid", "type", "amount", "method", "fromdate",
         "todate", "payments", "adjustments", "transfers", "outstanding"),
        ("id",), "claims_transactions.csv"),
    "patients": BronzeSpec(
        ("id", "birthdate", "deathdate", "gender", "race", "ethnicity"),
        ("id",), "patients.csv"),
    "conditions": BronzeSpec(
        ("patient", "encounter", "code", "description", "start", "stop"),
        ("patient", "encounter", "code"), "conditions.csv"),
    "careplans": BronzeSpec(
        ("id", "patient", "encounter", "code", "description", "start", "stop",
         "reasoncode", "reasondescription"),
        ("id",), "careplans.csv"),
}

LINEAGE = ("_ingested_at", "_source_file", "_row_hash")


def bronze_schema(table: str) -> T.StructType:
    raw = {c.name: c.type for c in raw_columns(table)}
    fields = [T.StructField(name, raw[name]) for name in BRONZE[table].columns]
    fields += [
        T.StructField("_ingested_at", T.TimestampNTZType()),
        T.StructField("_source_file", T.StringType()),
        T.StructField("_row_hash", T.StringType()),
    ]
    return T.StructType(fields)


DQ_LOG = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("metric_type", T.StringType()),
    T.StructField("metric_value", T.DoubleType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("checked_at", T.TimestampNTZType()),
])
