"""The seven source tables, derived from the generated test tables.

Each text is valid as it stands in Spark SQL and in DuckDB. `{name}` marks the
test table: a Parquet path in Spark, a view in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ADAPTERS: dict[str, str] = {
    "payers": """
select s_suppkey id, concat(' ', s_name, '  ') name,
  case when s_nationkey%10=9 then 'NO_INSURANCE' when s_nationkey%2=0 then 'Government' else ' private ' end ownership,
  cast(s_acctbal as decimal(15,2)) amount_covered, cast(s_suppkey as decimal(15,2)) amount_uncovered
from {supplier}""",
    "patients": """
select c_custkey id,
  case when c_custkey%97=0 then null else cast(date '1930-01-01' + interval '1' day * (c_custkey*37%32000) as date) end birthdate,
  case when c_acctbal<0 then cast(date '2010-01-01' + interval '1' day * (c_custkey%3000) as date) end deathdate,
  case c_custkey%5 when 0 then 'M' when 1 then ' female ' when 2 then 'F' when 3 then 'male' else 'x' end gender,
  concat(lower(c_mktsegment),' ') race, cast(c_nationkey as varchar(10)) ethnicity
from {customer}""",
    "encounters": """
select o_orderkey id, o_custkey patient, case when o_orderkey%50=0 then null else o_custkey%10 end payer,
  case substring(o_orderpriority,1,1) when '1' then 'EMERGENCY' when '2' then ' Inpatient' when '3' then 'ambulatory ' when '4' then 'Wellness' else 'outpatient' end encounterclass,
  o_orderdate + interval '1' minute * (o_orderkey%1440) start,
  o_orderdate + interval '1' minute * (o_orderkey%1440 + o_orderkey%600 - 5) stop,
  cast(100 as decimal(15,2)) base_encounter_cost,
  cast(case when o_orderkey%101=0 then -o_totalprice else o_totalprice end as decimal(15,2)) total_claim_cost,
  cast(case when o_orderkey%13=0 then null else floor(o_totalprice/2) end as decimal(15,2)) payer_coverage
from {orders}""",
    "claims": """
select o_orderkey id, case when o_orderkey%113=0 then null else o_custkey end patientid,
  o_custkey%10 primarypatientinsuranceid, o_orderdate servicedate,
  case when o_orderstatus='F' then 'Closed' else 'OPEN' end status1,
  case when o_orderkey%7=0 then null else 'CLOSED' end status2,
  case when o_orderkey%2=0 then 'CLOSED' else 'closed' end statusp,
  cast(case when o_orderstatus='O' then o_totalprice else 0 end as decimal(15,2)) outstanding1,
  cast(case when o_orderkey%4=0 then o_orderkey%11 end as decimal(15,2)) outstanding2, cast(o_orderkey%3 as decimal(15,2)) outstandingp,
  o_orderdate + interval '1' day * (o_orderkey%60) lastbilleddate1
from {orders}""",
    "claims_transactions": """
select concat(cast(l_orderkey as varchar(20)),'-',cast(l_linenumber as varchar(20))) id,
  case when l_partkey%100=0 then null else l_orderkey end claimid, case when l_linenumber>3 then null else l_suppkey end patientid,
  case l_returnflag when 'A' then 'CHARGE' when 'N' then ' payment' else 'TransferOut' end type,
  cast(case when l_suppkey%40=0 then -l_extendedprice else l_extendedprice end as decimal(15,2)) amount,
  case when l_linestatus='F' then ' echeck ' else null end method, l_shipdate fromdate,
  l_shipdate + interval '1' minute * (l_partkey*l_linenumber*997%60000 - 3000) todate,
  case when l_returnflag='N' then cast(l_extendedprice as decimal(15,2)) end payments,
  cast(floor(l_discount*100) as decimal(15,2)) adjustments, cast(0 as decimal(15,2)) transfers,
  cast(l_quantity as decimal(15,2)) outstanding
from {lineitem}""",
    "conditions": """
select user_id patient, case when event_id%61=0 then null else event_id%1500 end encounter,
  concat(' ',event_type) code,
  case event_type when 'view' then 'Essential HYPERTENSION (finding)' when 'click' then 'Fracture of arm' when 'error' then 'Chronic pain' when 'signup' then 'Stress (finding)' else 'Diabetes mellitus type 2 (disorder)' end description,
  cast(ts as date) start, case when event_id%3=0 then null else cast(ts + interval '10' day as date) end stop
from {events}""",
    "careplans": """
select event_id id, user_id patient, case when event_id%50=0 then null else event_id%1500 end encounter,
  props code, event_type description,
  cast(date '1995-01-01' + interval '1' day * (event_id*7%2400) as date) start,
  case when event_id%3=0 then null else date '2002-01-01' end stop,
  case when event_id%3=0 then event_type end reasoncode, event_type reasondescription
from {events}""",
}

# Columns that reference another source table, among those the adapters have.
REFERENCES = (
    ("encounters", "patient", "patients"),
    ("encounters", "payer", "payers"),
    ("conditions", "patient", "patients"),
    ("conditions", "encounter", "encounters"),
    ("careplans", "patient", "patients"),
    ("careplans", "encounter", "encounters"),
    ("claims", "patientid", "patients"),
    ("claims", "primarypatientinsuranceid", "payers"),
    ("claims_transactions", "claimid", "claims"),
    ("claims_transactions", "patientid", "patients"),
)

_TEST_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One source table as a Spark frame."""
    paths = {t: f"parquet.`{sf_dir.rstrip('/')}/{t}.parquet`" for t in _TEST_TABLES}
    return spark.sql(ADAPTERS[table].format(**paths))


def source_sql(table: str) -> str:
    """The same for DuckDB, over its views."""
    return ADAPTERS[table].format(**{t: t for t in _TEST_TABLES})
