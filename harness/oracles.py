"""DuckDB counterparts of the registered queries.

Written from the meaning of each step, in the most literal form (lag over whole
patients, EXISTS for care plans, two separate encounter matches), so that they
also check the rewrites made on the Spark side.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from harness.adapters import REFERENCES, source_sql
from harness.catalog import AS_OF, DAY_BEFORE, RUN_ID, filled_transactions
from lamina.schemas import RAW_LAYOUTS, RAW_PRIMARY_KEYS, RAW_REFERENCES, raw_columns


class _Source(NamedTuple):
    columns: tuple[str, ...]
    record_key: tuple[str, ...]
    source_file: str


# Fixed values, stated here once more: were they the engine's own, a wrong one would go unseen.
BRONZE = {
    "encounters": _Source(tuple("id patient payer encounterclass start stop base_encounter_cost total_claim_cost payer_coverage".split()), ("id",), "encounters.csv"),
    "payers": _Source(tuple("id name ownership amount_covered amount_uncovered".split()), ("id",), "payers.csv"),
    "claims": _Source(tuple("id patientid primarypatientinsuranceid servicedate status1 status2 statusp outstanding1 outstanding2 outstandingp lastbilleddate1".split()), ("id",), "claims.csv"),
    "claims_transactions": _Source(tuple("id claimid patientid type amount method fromdate todate payments adjustments transfers outstanding".split()), ("id",), "claims_transactions.csv"),
    "patients": _Source(tuple("id birthdate deathdate gender race ethnicity".split()), ("id",), "patients.csv"),
    "conditions": _Source(tuple("patient encounter code description start stop".split()), ("patient", "encounter", "code"), "conditions.csv"),
    "careplans": _Source(tuple("id patient encounter code description start stop reasoncode reasondescription".split()), ("id",), "careplans.csv"),
}
CHRONIC_WORDS = (
    "chronic disorder disease syndrome diabetes hypertension asthma failure obesity depression anxiety cancer leukemia anemia"
).split()
GOLD_REFERENCES = (
    ("fact_claims", "patient_key", "dim_patients", "patient_key"),
    ("fact_claims", "payer_key", "dim_payers", "payer_key"),
    ("fact_claims", "service_date_key", "dim_date", "date_key"),
    ("fact_encounters", "patient_key", "dim_patients", "patient_key"),
    ("fact_encounters", "payer_key", "dim_payers", "payer_key"),
    ("fact_encounters", "date_key", "dim_date", "date_key"),
)
GOLD_NATURAL_KEYS = (("dim_date", "date_key"), ("dim_patients", "patient_id"), ("dim_payers", "payer_id"), ("dim_conditions", "code"))
GOLD_FLAGS = (("fact_encounters", "has_active_careplan"), ("fact_encounters", "is_readmission"), ("dim_conditions", "condition_category"))
PASS_RATE = 95.0

_NOW = f"timestamp '{AS_OF.isoformat(sep=' ')}'"
_YESTERDAY = f"timestamp '{DAY_BEFORE.isoformat(sep=' ')}'"


def _half_up(numerator: str, denominator: str, digits: int) -> str:
    """Exact division in integers, rounded half away from zero."""
    n, d, p = f"cast({numerator} as hugeint)", f"cast({denominator} as hugeint)", 10**digits
    return f"cast(sign({n}) * ((2 * abs({n}) * {p} + {d}) // (2 * {d})) as double) / {p}"


def _cents(column: str) -> str:
    return f"cast({column} * 100 as hugeint)"


# --- named steps; a step may use any other as a table ------------------------


def _bronze(table: str, rows: str, arrived: str) -> str:
    columns = BRONZE[table].columns
    text = ", ".join(f"cast({c} as varchar)" for c in columns)
    return (
        f"select {', '.join(columns)}, {arrived} as _ingested_at, "
        f"'{BRONZE[table].source_file}' as _source_file, "
        f"md5(concat_ws('|', {text})) as _row_hash from {rows}"
    )


def _latest(table: str, rows: str | None = None) -> str:
    spec = BRONZE[table]
    rest = ", ".join(c for c in spec.columns if c not in spec.record_key)
    return (
        f"(select * from {rows or 'b_' + table} qualify row_number() over ("
        f"partition by {', '.join(spec.record_key)} "
        f"order by _ingested_at desc nulls last, _row_hash, {rest}) = 1)"
    )


def _flags(note: str) -> str:
    return (
        f"case when ({note}) is null then 'PASS' else 'WARN' end as _dq_status, "
        f"{note} as _dq_notes, {_NOW} as _silver_processed_at"
    )


def _silver_claims(rows: str | None = None) -> str:
    return f"""
select id, patientid as patient_id, primarypatientinsuranceid as payer_id,
  servicedate as service_date,
  case when list_unique([upper(status1), upper(status2), upper(statusp)]) = 1
    and upper(status1) = 'CLOSED' and status2 is not null and statusp is not null
    then 'CLOSED' else 'OPEN' end as claim_status,
  cast(ifnull(outstanding1, 0) + ifnull(outstanding2, 0) + ifnull(outstandingp, 0)
    as decimal(15,2)) as total_outstanding,
  lastbilleddate1 as last_billed_date,
  {_flags("case when patientid is null then 'missing patient_id' end")}
from {_latest("claims", rows)} where id is not null"""


def _calendar(first_day: str) -> str:
    return f"""
select cast(strftime(d, '%Y%m%d') as integer) as date_key, d as full_date,
  rpad(strftime(d, '%A'), 9, ' ') as day_of_week, cast(day(d) as integer) as day_of_month,
  cast(week(d) as integer) as week_of_year, cast(month(d) as integer) as month,
  rpad(strftime(d, '%B'), 9, ' ') as month_name, cast(quarter(d) as integer) as quarter,
  cast(year(d) as integer) as year, isodow(d) >= 6 as is_weekend
from (select cast(unnest(generate_series({first_day},
  cast({_NOW} as timestamp), interval 1 day)) as date) as d)"""


def _check_rows(table: str, checks: list[tuple]) -> str:
    parts = []
    for i, (column, kind, hits, base, threshold) in enumerate(checks):
        name = "cast(null as varchar)" if column is None else f"'{column}'"
        parts.append(
            f"select cast({i + 1} as bigint) as id, 'silver_{table}' as table_name, "
            f"{name} as column_name, '{kind}' as metric_type, "
            f"coalesce(100.0::double * count(*) filter (where {hits}) / "
            f"nullif(count(*) filter (where {base}), 0), 0.0::double) as metric_value, "
            f"{float(threshold)}::double as threshold from s_{table}"
        )
    return (
        "select *, case when metric_value >= threshold then 'PASSED' else 'FAILED' end as status "
        f"from ({' union all '.join(parts)})"
    )


def _pass(threshold: int = 95) -> tuple:
    return (None, "completeness", "_dq_status = 'PASS'", "true", threshold)


def _filled(column: str, threshold: int) -> tuple:
    return (column, "completeness", f"{column} is not null", "true", threshold)


def _one_of(column: str, threshold: int, *values: str) -> tuple:
    quoted = ", ".join(f"'{v}'" for v in values)
    return (column, "validity", f"cast({column} as varchar) in ({quoted})", "true", threshold)


def _no_negative(column: str, threshold: int) -> tuple:
    return (column, "accuracy", f"{column} >= 0", f"{column} is not null", threshold)


# The checks of each table.
_CHECKS = {
    "encounters": [
        _pass(), _filled("id", 100), _filled("patient_id", 100),
        _one_of("encounter_class", 95, "wellness", "ambulatory", "outpatient", "urgentcare",
                "emergency", "inpatient", "home", "snf", "hospice", "virtual"),
        _no_negative("total_claim_cost", 99),
    ],
    "payers": [_filled("id", 100), _one_of("ownership", 90, "GOVERNMENT", "PRIVATE")],
    "claims": [
        _pass(), _filled("id", 100), _filled("patient_id", 95),
        _one_of("claim_status", 100, "OPEN", "CLOSED"), _no_negative("total_outstanding", 99),
    ],
    "claims_transactions": [
        _pass(), _filled("claim_id", 99),
        _one_of("transaction_type", 99, "CHARGE", "PAYMENT", "TRANSFERIN", "TRANSFEROUT"),
        _no_negative("amount", 95),
    ],
    "patients": [
        _pass(), _filled("id", 100), _filled("birth_year", 95),
        _one_of("birth_year", 99, *[str(y) for y in range(1900, 2027)]),
        _one_of("gender", 100, "Male", "Female", "Unknown"),
        _one_of("age_group", 100, "0-17", "18-34", "35-50", "51-65", "65+"),
    ],
    "conditions": [
        _pass(), _filled("patient_id", 100), _filled("code", 100), _filled("start_date", 95),
    ],
    "careplans": [_pass(), _filled("patient_id", 100), _filled("code", 100)],
}


def _steps() -> dict[str, str]:
    steps = {f"a_{t}": source_sql(t) for t in BRONZE}
    for t in BRONZE:
        arrived = "fromdate" if t == "claims_transactions" else _NOW
        steps[f"b_{t}"] = _bronze(t, f"a_{t}", arrived)

    steps["a_claims_open"] = "select * replace ('OPEN' as status1) from a_claims"
    steps["b_claims_first"] = _bronze("claims", "a_claims_open", _YESTERDAY)
    steps["b_claims_increment"] = (
        "select * from b_claims where _row_hash not in (select _row_hash from b_claims_first)"
    )
    steps["b_claims_history"] = (
        "select * from b_claims_first union all select * from b_claims_increment"
    )

    tomorrow = f"{_NOW} + interval 1 day"
    steps["b_load_1"] = _bronze("claims", "(select * from a_claims_open where id % 3 <> 0)", _YESTERDAY)
    steps["b_load_2"] = "select * from b_claims where _row_hash not in (select _row_hash from b_load_1)"
    steps["b_load_3_all"] = _bronze("claims", "a_claims_open", tomorrow)
    steps["b_load_3"] = ("select * from b_load_3_all where _row_hash not in "
                         "(select _row_hash from b_load_1 union all select _row_hash from b_load_2)")
    steps["b_loads"] = "select * from b_load_1 union all select * from b_load_2 union all select * from b_load_3"
    steps["b_late"] = _bronze("claims", "(select * replace ('LATE' as status2) from a_claims where id % 2 = 0)", _YESTERDAY)
    steps["b_same"] = _bronze("claims", "(select * replace ('SAME' as status2) from a_claims where id % 5 = 0)", _NOW)
    steps["b_merged"] = ("select * from b_load_1 union all select * from b_load_2 "
                         "union all select * from b_late union all select * from b_same")
    steps["s_merged"] = _silver_claims("b_merged")

    steps["s_encounters"] = f"""
select id, patient as patient_id, payer as payer_id, lower(trim(encounterclass)) as encounter_class,
  start as start_ts, stop as stop_ts,
  cast(cast(round_even((epoch_us(stop) - epoch_us(start)) / 1000000, 0) as bigint) // 60
    as integer) as duration_minutes,
  base_encounter_cost, total_claim_cost, payer_coverage,
  cast(ifnull(total_claim_cost, 0) - ifnull(payer_coverage, 0) as decimal(15,2)) as patient_oop,
  {_flags("case when total_claim_cost < 0 then 'negative total_claim_cost' "
          "when stop < start then 'stop timestamp before start' end")}
from {_latest("encounters")} where id is not null"""
    steps["s_payers"] = f"""
select id, trim(name) as name, upper(trim(ownership)) as ownership, amount_covered,
  amount_uncovered, {_NOW} as _silver_processed_at
from {_latest("payers")} where id is not null"""
    steps["s_claims"] = _silver_claims()
    steps["s_claims_history"] = _silver_claims("b_claims_history")
    steps["s_claims_transactions"] = f"""
select id, claimid as claim_id, patientid as patient_id, upper(trim(type)) as transaction_type,
  amount, upper(trim(method)) as payment_method, fromdate as from_date, todate as to_date,
  case when upper(trim(type)) = 'PAYMENT'
    then cast((epoch_us(todate) - epoch_us(fromdate)) // 86400000000 as integer)
  end as days_to_payment,
  payments, adjustments, outstanding,
  {_flags("case when claimid is null then 'missing claim_id' "
          "when amount < 0 then 'negative amount' end")}
from {_latest("claims_transactions")} where id is not null"""
    age = f"({AS_OF.year} - year(birthdate))"
    steps["s_patients"] = f"""
select id, cast(year(birthdate) as integer) as birth_year,
  case when {age} < 18 then '0-17' when {age} < 35 then '18-34' when {age} < 51 then '35-50'
    when {age} < 66 then '51-65' else '65+' end as age_group,
  case when upper(trim(gender)) in ('M', 'MALE') then 'Male'
    when upper(trim(gender)) in ('F', 'FEMALE') then 'Female' else 'Unknown' end as gender,
  trim(race) as race, trim(ethnicity) as ethnicity, deathdate is not null as is_deceased,
  {_flags("case when birthdate is null then 'missing birthdate — age_group unknown' end")}
from {_latest("patients")} where id is not null"""
    no_encounter = _flags("case when encounter is null then 'missing encounter_id' end")
    steps["s_conditions"] = f"""
select patient as patient_id, encounter as encounter_id, trim(code) as code,
  trim(description) as description, start as start_date, stop as end_date,
  stop is null as is_active, {no_encounter}
from {_latest("conditions")} where patient is not null"""
    steps["s_careplans"] = f"""
select id, patient as patient_id, encounter as encounter_id, trim(code) as code,
  trim(description) as description, start as start_date, stop as end_date,
  stop is null as is_active, trim(reasoncode) as reason_code,
  trim(reasondescription) as reason_description, {no_encounter}
from {_latest("careplans")} where patient is not null"""

    for t, checks in _CHECKS.items():
        steps[f"c_{t}"] = _check_rows(t, checks)
    steps["dq_log_all"] = " union all ".join(
        f"select id, '{RUN_ID}' as run_id, * exclude (id), {_NOW} as checked_at from c_{t}"
        for t in BRONZE
    )

    steps["d_date_claims"] = _calendar("(select min(service_date)::date from s_claims)")
    steps["d_date_encounters"] = _calendar("(select min(start_ts)::date from s_encounters)")
    steps["d_date"] = _calendar(
        "(select least((select min(service_date)::date from s_claims), "
        "(select min(start_ts)::date from s_encounters)))"
    )
    steps["d_patients"] = """
select row_number() over (order by id) as patient_key, id as patient_id, age_group, gender, race,
  ethnicity, is_deceased from s_patients"""
    steps["d_payers"] = """
select row_number() over (order by id) as payer_key, id as payer_id, name, ownership
from s_payers"""
    chronic = " or ".join(f"description ilike '%{w}%'" for w in CHRONIC_WORDS)
    steps["d_conditions"] = f"""
select row_number() over (order by code) as condition_key, *,
  case when {chronic} then 'Chronic' else 'Acute' end as condition_category
from (select distinct on (code) code, description from s_conditions
  where code is not null order by code, description nulls last)"""

    steps["claim_payments"] = f"""
select claim_id, sum(payments) as paid, sum(adjustments) as adjusted,
  {_half_up("sum(days_to_payment) filter (where transaction_type = 'PAYMENT')",
            "count(days_to_payment) filter (where transaction_type = 'PAYMENT')", 2)} as avg_days
from s_claims_transactions group by claim_id"""
    steps["claim_class"] = """
select c.id as claim_id, arg_min(e.encounter_class, (e.start_ts, e.id)) as encounter_class
from s_claims c join s_encounters e
  on e.patient_id = c.patient_id and e.start_ts::date = c.service_date::date
group by c.id"""
    steps["day_money"] = """
select patient_id, start_ts::date as day, total_claim_cost, payer_coverage, patient_oop
from s_encounters
qualify row_number() over (partition by patient_id, start_ts::date order by start_ts, id) = 1"""
    steps["f_claims"] = """
select row_number() over (order by c.id) as claim_key, c.id as claim_id, p.patient_key,
  y.payer_key, cast(strftime(c.service_date, '%Y%m%d') as integer) as service_date_key,
  coalesce(k.encounter_class, 'unknown') as encounter_class, c.claim_status,
  m.total_claim_cost, m.payer_coverage, m.patient_oop, c.total_outstanding,
  coalesce(t.paid, 0) as total_payments, coalesce(t.adjusted, 0) as total_adjustments,
  t.avg_days as avg_days_to_payment
from s_claims c
  left join d_patients p on p.patient_id = c.patient_id
  left join d_payers y on y.payer_id = c.payer_id
  left join claim_class k on k.claim_id = c.id
  left join day_money m on m.patient_id = c.patient_id and m.day = c.service_date::date
  left join claim_payments t on t.claim_id = c.id
where c.service_date is not null"""

    steps["returns"] = """
select id, encounter_class in ('inpatient', 'emergency') and coalesce(start_ts - interval 30 day
  <= lag(start_ts) over (partition by patient_id order by start_ts, id), false) as is_readmission
from s_encounters"""
    steps["f_encounters"] = """
select row_number() over (order by e.id) as encounter_key, e.id as encounter_id, p.patient_key,
  y.payer_key, cast(strftime(e.start_ts, '%Y%m%d') as integer) as date_key, e.encounter_class,
  e.duration_minutes, e.total_claim_cost, e.patient_oop,
  (select count(*) from s_conditions c where c.encounter_id = e.id) as condition_count,
  exists (select 1 from s_careplans cp where cp.patient_id = e.patient_id and cp.is_active
    and cp.start_date <= e.start_ts::date) as has_active_careplan,
  coalesce(r.is_readmission, false) as is_readmission
from s_encounters e
  left join d_patients p on p.patient_id = e.patient_id
  left join d_payers y on y.payer_id = e.payer_id
  left join returns r on r.id = e.id
where e.start_ts is not null"""
    return steps


def _revenue() -> str:
    days = _half_up(f"sum({_cents('f.avg_days_to_payment::decimal(12,2)')})",
                    "(100 * count(f.avg_days_to_payment))", 1)
    return f"""
select y.name as payer, y.ownership, f.encounter_class, {days} as avg_days_to_payment,
  sum(f.total_outstanding)::double as total_outstanding
from f_claims f join d_payers y on y.payer_key = f.payer_key
where f.claim_status = 'OPEN' group by all order by total_outstanding desc nulls first"""


def _settlement() -> str:
    days = _half_up(f"sum({_cents('f.avg_days_to_payment::decimal(12,2)')})", "(100 * count(*))", 1)
    return f"""
select y.ownership, {days} as avg_days
from f_claims f join d_payers y on y.payer_key = f.payer_key
where f.avg_days_to_payment is not null group by y.ownership order by avg_days nulls last"""


def _readmission(rows: str, rate: str, digits: int) -> str:
    back = "count(*) filter (where is_readmission)"
    return f"""
select has_active_careplan, count(*) as {rows}, {back} as readmissions,
  {_half_up(f"100 * {back}", "count(*)", digits)} as {rate}
from f_encounters where encounter_class in ('inpatient', 'emergency')
group by has_active_careplan"""


def _duplicates() -> str:
    parts = []
    for table, spec in BRONZE.items():
        keys = ", ".join(spec.record_key)
        parts.append(
            f"select '{table}' as table_name, '{','.join(spec.record_key)}' as key_columns, "
            f"count(*) as duplicate_keys, cast(coalesce(sum(n - 1), 0) as bigint) as surplus_rows "
            f"from (select count(*) as n from a_{table} group by {keys} having count(*) > 1)"
        )
    return " union all ".join(parts)


def _orphans() -> str:
    return " union all ".join(
        f"select '{child}' as child_table, '{column}' as child_column, "
        f"'{parent}' as parent_table, count(distinct {column}) as orphan_keys, "
        f"count(*) as orphan_rows from a_{child} "
        f"where {column} is not null and {column} not in (select id from a_{parent})"
        for child, column, parent in REFERENCES
    )


def _check(check: str, table: str, value: str, ok: str, rows: str) -> str:
    return (
        f"select '{check}' as \"check\", '{table}' as table_name, "
        f"cast({value} as double) as value, {ok} as ok from {rows}"
    )


def _gold_checks() -> str:
    names = {
        "dim_date": "d_date", "dim_patients": "d_patients", "dim_payers": "d_payers",
        "dim_conditions": "d_conditions", "fact_claims": "f_claims",
        "fact_encounters": "f_encounters",
    }
    parts = []
    for fact, column, dim, key in GOLD_REFERENCES:
        lost = (
            f"count(*) filter (where {column} is not null and "
            f"{column} not in (select {key} from {names[dim]}))"
        )
        parts.append(_check(f"{column} resolves", fact, lost, f"{lost} = 0", names[fact]))
    for table, key in GOLD_NATURAL_KEYS:
        surplus = f"count(*) - count(distinct {key})"
        parts.append(_check(f"{key} unique", table, surplus, f"{surplus} = 0", names[table]))
    for table, column in GOLD_FLAGS:
        unset = f"count(*) filter (where {column} is null)"
        parts.append(_check(f"{column} set", table, unset, f"{unset} = 0", names[table]))
    return " union all ".join(parts)


def _gold_meaning() -> str:
    """Keys of facts against the natural keys of their records."""
    parts = []
    for fact, own, record in (("fact_claims", "claim_id", "s_claims"), ("fact_encounters", "encounter_id", "s_encounters")):
        for natural, key, dim in (("payer_id", "payer_key", "d_payers"), ("patient_id", "patient_key", "d_patients")):
            wrong = f"count(*) filter (where r.{natural} is distinct from d.{natural})"
            parts.append(_check(
                f"{key} means {natural}", fact, wrong, f"{wrong} = 0",
                f"f_{fact.split('_')[1]} f join {record} r on r.id = f.{own} left join {dim} d on d.{key} = f.{key} where f.{key} is not null"))
    return " union all ".join(parts)


def _raw_duplicates() -> str:
    """Tables that the test data has none of are empty."""
    return " union all ".join(
        f"select '{t}' as table_name, 'id' as key_columns, count(*) as duplicate_keys, "
        f"cast(coalesce(sum(n - 1), 0) as bigint) as surplus_rows from "
        + (f"(select count(*) as n from a_{t} group by id having count(*) > 1)" if t in BRONZE else "(select 1 as n where false)")
        for t in RAW_PRIMARY_KEYS)


def _raw_orphans() -> str:
    parts = []
    for child, references in RAW_REFERENCES.items():
        for column, parent in references.items():
            there = child in BRONZE and column in BRONZE[child].columns
            known = f"(select id from a_{parent})" if parent in BRONZE else "(select null where false)"
            parts.append(
                f"select '{child}' as child_table, '{column}' as child_column, '{parent}' as parent_table, "
                + (f"count(distinct {column}) as orphan_keys, count(*) as orphan_rows from a_{child} "
                   f"where {column} is not null and {column} not in {known}" if there
                   else "cast(0 as bigint) as orphan_keys, cast(0 as bigint) as orphan_rows"))
    return " union all ".join(parts)


def _in_order() -> str:
    def placed(name: str, rows: str, item: str, order: str) -> str:
        return (f"select '{name}' as answer, concat_ws('|', {item}) as item, rank() over (order by {order}) as place "
                f"from ({rows})")

    return " union all ".join([
        placed("revenue_cycle", _revenue(), "payer, ownership, encounter_class", "total_outstanding desc nulls first"),
        placed("payer_settlement", _settlement(), "ownership", "avg_days nulls last"),
        placed("failed_checks", "select * from dq_log_all where status = 'FAILED'", "table_name, column_name, metric_type",
               "checked_at desc nulls first"),
        placed("check_trend", "select table_name, status from dq_log_all group by table_name, status", "table_name, status", "table_name"),
    ])


def _csv_texts() -> str:
    return """
select cast(doc_id as varchar) as code, lang as category, source as description,
  md5(text) as value_md5, 'text' as type, cast(null as varchar) as units from documents"""


def _csv_transactions() -> str:
    """Identifiers come back as text, as in the raw layout."""
    uuids = {c.name for c in raw_columns("claims_transactions") if c.is_uuid}
    columns = ", ".join(
        f"cast({c} as varchar) as {c}" if c in uuids else c
        for c in BRONZE["claims_transactions"].columns
    )
    return f"select {columns} from a_claims_transactions"


# Money columns are handed over as doubles; see catalog.comparable().
_MONEY = sorted(
    {c.name for t in RAW_LAYOUTS for c in raw_columns(t) if c.type.typeName() == "decimal"}
    | {"patient_oop", "total_outstanding", "total_payments", "total_adjustments"}
)


def _with_doubles(final: str, columns: str) -> str:
    """Cast the money columns of a step's result."""
    used = [c for c in _MONEY if re.search(rf"\b{c}\b", columns)]
    casts = ", ".join(f"cast({c} as double) as {c}" for c in used)
    return f"select * replace ({casts}) from ({final})" if used else final


def oracle_sql() -> dict[str, str]:
    steps = _steps()

    def money(step: str, columns: str) -> str:
        return _with_doubles(f"select * from {step}", columns)

    bronze_money = {t: " ".join(spec.columns) for t, spec in BRONZE.items()}
    silver_money = {
        "encounters": "base_encounter_cost total_claim_cost payer_coverage patient_oop",
        "payers": "amount_covered amount_uncovered",
        "claims": "total_outstanding",
        "claims_transactions": "amount payments adjustments outstanding",
    }
    finals = {f"bronze_{t}": money(f"b_{t}", bronze_money[t]) for t in BRONZE}
    finals["anti_join_rehash"] = money("b_claims_increment", bronze_money["claims"])
    finals |= {f"silver_{t}": money(f"s_{t}", silver_money.get(t, "")) for t in BRONZE}
    finals["latest_version"] = money("s_claims_history", silver_money["claims"])
    finals |= {f"dq_{t}": f"select * from c_{t}" for t in BRONZE}
    finals |= {
        "dim_date_claims": "select * from d_date_claims",
        "dim_date_encounters": "select * from d_date_encounters",
        "dim_date": "select * from d_date",
        "dim_patients": "select * from d_patients",
        "dim_payers": "select * from d_payers",
        "dim_conditions": "select * from d_conditions",
        "fact_claims": money(
            "f_claims", "total_claim_cost payer_coverage patient_oop total_outstanding "
            "total_payments total_adjustments"),
        "fact_encounters": money("f_encounters", "total_claim_cost patient_oop"),
        "q1_revenue_cycle": _revenue(),
        "payer_settlement": _settlement(),
        "q2_readmission": _readmission("total_encounters", "readmission_rate_pct", 2),
        "q2_readmission_preview": _readmission("encounters", "readmission_pct", 1),
        "dq_failed": """
select run_id, table_name, column_name, metric_type, round(metric_value, 1) as value, threshold
from dq_log_all where status = 'FAILED' order by checked_at desc""",
        "dq_trend": """
select table_name, status, count(*) as checks, round(avg(metric_value), 1) as avg_value
from dq_log_all group by table_name, status order by table_name""",
        "dq_log": "select * from dq_log_all",
        "duplicate_keys": _duplicates(),
        "fk_orphans": _orphans(),
        "duplicate_hashes": " union all ".join(
            _check("no duplicate row hash", t, "count(*) - count(distinct _row_hash)",
                   "count(*) = count(distinct _row_hash)", f"b_{t}") for t in BRONZE),
        "check_populated": " union all ".join(
            _check("has rows", t, "count(*)", "count(*) > 0", f"b_{t}") for t in BRONZE),
        "check_pass_rates": " union all ".join(
            _check("pass rate", t, "metric_value", f"metric_value >= {PASS_RATE}", f"c_{t}")
            + " where column_name is null" for t in BRONZE if t != "payers"),
        "check_dq_log": """
select 'logged checks passed' as "check", table_name,
  cast(count(*) filter (where status = 'FAILED') as double) as value,
  count(*) filter (where status = 'FAILED') = 0 as ok
from dq_log_all group by table_name""",
        "check_gold": _gold_checks(),
        "stored_revenue_cycle": _revenue(),
        "keys_after_new_payer": _revenue(),
        "stored_readmission": _readmission("total_encounters", "readmission_rate_pct", 2),
        "refresh_twice": money("s_encounters", silver_money["encounters"]),
        "stored_second_load": " union all ".join(
            f"select '{t}' as table_name, count(*) as stored_rows, cast(0 as bigint) as added_rows from b_{t}" for t in BRONZE),
        "stored_log_of_two_runs": """
select 'run-1' as run_id, count(*) as checks, cast(1 as bigint) as first_id, count(*) as last_id from dq_log_all
union all select 'run-2', count(*), count(*) + 1, 2 * count(*) from dq_log_all""",
        "raw_populated": " union all ".join(
            _check("has rows", t, "count(*)", "count(*) > 0", f"a_{t}" if t in BRONZE else "(select 1 where false)")
            for t in RAW_LAYOUTS),
        "csv_roundtrip": _with_doubles(
            _csv_transactions(), bronze_money["claims_transactions"]),
        "csv_roundtrip_text": _csv_texts(),
        "csv_all_columns": _with_doubles(f"select {filled_transactions()} from a_claims_transactions",
                                         " ".join(c.name for c in raw_columns("claims_transactions"))),
        "bronze_three_loads": money("b_loads", bronze_money["claims"]),
        "silver_merge": money("s_merged", silver_money["claims"]),
        "fact_claims_merged": _with_doubles(
            "select * exclude (claim_key) from f_claims", "total_claim_cost payer_coverage patient_oop total_outstanding "
            "total_payments total_adjustments"),
        "fact_encounters_merged": _with_doubles("select * exclude (encounter_key) from f_encounters", "total_claim_cost patient_oop"),
        "keys_after_a_gap": "select payer_id, payer_key from d_payers union all select -5, count(*) + 1 from d_payers",
        "csv_folder_load": " union all ".join(
            f"select '{t}' as table_name, n as loaded, cast(0 as bigint) as loaded_again, n > 0 as is_loaded, n as stored from "
            + (f"(select count(*) as n from a_{t})" if t in BRONZE else "(select cast(0 as bigint) as n)") for t in RAW_LAYOUTS),
        "run_summary": """
select table_name, count(*) filter (where status = 'PASSED') as passed,
  count(*) as checks, true as one_run from dq_log_all group by table_name""",
        "answers_in_order": _in_order(),
        "raw_duplicates": _raw_duplicates(),
        "raw_orphans": _raw_orphans(),
        "gold_meaning": _gold_meaning(),
    }
    return {name: _assemble(final, steps) for name, final in finals.items()}


def _assemble(final: str, steps: dict[str, str]) -> str:
    """Put the steps a query uses, and those they use, before it."""
    order: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\w+", text)):
            if word in steps and word not in order:
                visit(steps[word])
                order.append(word)

    visit(final)
    if not order:
        return final.strip()
    return "with " + ",\n".join(f"{s} as ({steps[s].strip()})" for s in order) + "\n" + final.strip()
