"""The stored warehouse, built from the test tables and from CSV files."""

from datetime import datetime, timedelta

import pytest

from harness import catalog
from harness.adapters import source
from lamina.plans import silver
from lamina.plans.warehouse import GOLD_TABLES, LOG, Warehouse
from lamina.schemas import BRONZE
from lamina.sources.tables import Tables

SF = "/root/testdata/sf0.001"
AS_OF = datetime(2024, 6, 30)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    lines = []
    house = Warehouse(Tables(spark, str(tmp_path_factory.mktemp("house")), lines.append))
    raw = {t: source(spark, SF, t) for t in BRONZE}
    run = house.build(raw, AS_OF, "run-1")
    return house, raw, run, lines


def test_rows_are_reported(built):
    house, _, run, lines = built
    assert run == "run-1"
    assert "  bronze.claims: 1500 rows" in lines
    assert any(line.startswith("  checks [silver_payers]: ") for line in lines)


def test_facts_have_one_row_per_dated_record(built):
    house = built[0]
    for fact, table, dated in (("fact_claims", "claims", "service_date"),
                               ("fact_encounters", "encounters", "start_ts")):
        expected = house.tables.read("silver", table).where(f"{dated} is not null").count()
        assert house.tables.read("gold", fact).count() == expected > 0


def test_answers_match_the_unstored_queries(built, spark):
    """Same answers from stored tables as from one plan over the sources."""
    house = built[0]
    for name, stored in (("q2_readmission", house.readmission()),
                         ("q2_readmission_preview", house.readmission_preview())):
        direct = catalog.queries()[name](spark, SF)
        assert sorted(catalog.comparable(stored).collect()) == sorted(direct.collect())
    assert house.revenue_cycle().count() > 0 and house.payer_settlement().count() > 0


PUBLISHED = {
    "revenue_cycle": """
        select p.name as payer, p.ownership, f.encounter_class,
          round(avg(f.avg_days_to_payment), 1) as avg_days_to_payment,
          round(sum(f.total_outstanding), 2) as total_outstanding
        from dw_gold.fact_claims f join dw_gold.dim_payers p on p.payer_key = f.payer_key
        where f.claim_status = 'OPEN' group by p.name, p.ownership, f.encounter_class""",
    "payer_settlement": """
        select p.ownership, round(avg(f.avg_days_to_payment), 1) as avg_days
        from dw_gold.fact_claims f join dw_gold.dim_payers p on p.payer_key = f.payer_key
        where f.avg_days_to_payment is not null group by p.ownership""",
    "readmission": """
        select has_active_careplan, count(*) as total_encounters,
          sum(is_readmission::int) as readmissions,
          round(100.0 * sum(is_readmission::int) / count(*), 2) as readmission_rate_pct
        from dw_gold.fact_encounters where encounter_class in ('inpatient', 'emergency')
        group by has_active_careplan""",
    "failed_checks": """
        select run_id, table_name, column_name, metric_type, round(metric_value, 1) as value,
          threshold from metadata.dq_log_results where status = 'FAILED'""",
    "check_trend": """
        select table_name, status, count(*) as checks, round(avg(metric_value), 1) as avg_value
        from metadata.dq_log_results group by table_name, status""",
}


def test_published_tables_answer_sql(built, spark):
    house = built[0]
    names = house.publish()
    assert len(names) == 7 + 7 + 6 + 1 and "dw_silver.careplans" in names
    for method, sql in PUBLISHED.items():
        ours = catalog.comparable(getattr(house, method)())
        theirs = catalog.comparable(spark.sql(sql))
        assert ours.columns == theirs.columns
        assert sorted(map(str, ours.collect())) == sorted(map(str, theirs.collect()))
    assert house.publish() == names  # again, over the same files
    assert spark.table("dw_gold.fact_claims").count() > 0


def _raising(spark, df):
    """A plan that fails once it runs."""
    return df.where("cast(raise_error('broken') as boolean)")


def test_failed_refresh_leaves_the_table(spark, tmp_path):
    tables = Tables(spark, str(tmp_path), lambda line: None)
    with pytest.raises(Exception, match="broken"):
        tables.refresh("silver", "payers", _raising(spark, spark.range(5)))
    assert tables.find("silver", "payers") is None  # a first write that failed
    tables.refresh("silver", "payers", spark.range(11))
    for write in (tables.refresh, tables.append):
        with pytest.raises(Exception, match="broken"):
            write("silver", "payers", _raising(spark, spark.range(5)))
        assert tables.read("silver", "payers").count() == 11


def test_joint_changes_are_seen_together_or_not_at_all(spark, tmp_path):
    tables, other = (Tables(spark, str(tmp_path), lambda line: None) for _ in range(2))
    tables.refresh("silver", "a", spark.range(1))
    with pytest.raises(ZeroDivisionError):
        with tables.together():
            tables.refresh("silver", "a", spark.range(5))
            tables.append("silver", "b", spark.range(5))
            assert tables.read("silver", "a").count() == 5 and other.read("silver", "a").count() == 1
            assert other.find("silver", "b") is None
            raise ZeroDivisionError
    assert tables.read("silver", "a").count() == 1 and tables.find("silver", "b") is None
    with tables.together():
        tables.refresh("silver", "a", spark.range(2))
        tables.append("silver", "b", spark.range(3))
        tables.append("silver", "b", spark.range(4))
    assert other.read("silver", "a").count() == 2 and other.read("silver", "b").count() == 7


def test_writes_of_two_writers_all_stay(spark, tmp_path):
    writers = [Tables(spark, str(tmp_path), lambda line: None) for _ in range(2)]
    for i in range(6):
        writers[i % 2].append("bronze", "t", spark.range(1))
    assert writers[0].read("bronze", "t").count() == 6


def test_a_refresh_may_read_its_table_and_old_folders_go(spark, tmp_path):
    tables = Tables(spark, str(tmp_path), lambda line: None)
    tables.refresh("gold", "t", spark.range(3))
    for _ in range(5):
        before = tables.read("gold", "t")
        tables.refresh("gold", "t", before.unionByName(before.limit(1)))
        assert before.count() < tables.read("gold", "t").count()  # readers of the version before go on
    assert tables.read("gold", "t").count() == 8
    assert len(list((tmp_path / "gold" / "t").iterdir())) <= 2


def test_second_load_adds_no_bronze_rows(built):
    house, raw, *_ = built
    for table in BRONZE:
        before = house.tables.read("bronze", table).count()
        assert house.load_bronze(table, raw[table], AS_OF + timedelta(days=1)) == 0
        assert house.tables.read("bronze", table).count() == before


def test_refresh_is_repeatable_and_keys_are_stable(built):
    house = built[0]
    before = {t: sorted(house.tables.read("gold", t).collect(), key=str) for t in GOLD_TABLES}
    for table in GOLD_TABLES:
        house.load_gold(table, AS_OF)
    for table in GOLD_TABLES:
        assert sorted(house.tables.read("gold", table).collect(), key=str) == before[table]


def test_a_new_payer_moves_no_money(spark, tmp_path, built):
    """A payer that sorts first comes; only its dimension is loaded; the answers by payer stay."""
    raw = built[1]
    house = Warehouse(Tables(spark, str(tmp_path), lambda line: None))
    house.build(raw, AS_OF, "run-1")

    def answer():
        return sorted(map(str, house.revenue_cycle().collect()))

    before, keys = answer(), {r.payer_id: r.payer_key for r in house.tables.read("gold", "dim_payers").collect()}
    first = raw["payers"].limit(1).selectExpr(
        "cast(-5 as bigint) id", *[c for c in raw["payers"].columns if c != "id"])
    later = AS_OF + timedelta(days=1)
    assert house.load_bronze("payers", first, later) == 1
    house.load_silver("payers", later, "run-2")
    house.load_gold("dim_payers", later)
    now = {r.payer_id: r.payer_key for r in house.tables.read("gold", "dim_payers").collect()}
    (new,) = now.keys() - keys.keys()
    assert {k: v for k, v in now.items() if k != new} == keys and now[new] == max(keys.values()) + 1
    assert answer() == before
    assert all(r.ok for r in house.verify("gold").collect())
    house.load_gold("fact_claims", later)
    assert answer() == before


def test_a_key_that_means_another_payer_is_seen(spark, tmp_path, built):
    house = Warehouse(Tables(spark, str(tmp_path), lambda line: None))
    house.build(built[1], AS_OF, "run-1")
    payers = house.tables.read("gold", "dim_payers")
    last = payers.agg({"payer_key": "max"}).first()[0]
    house.tables.refresh("gold", "dim_payers", payers.withColumn(
        "payer_key", last + 1 - payers["payer_key"]))  # every key still resolves
    bad = {r.check for r in house.verify("gold").where("not ok").collect()}
    assert bad == {"payer_key means payer_id"}


def test_log_grows_by_29_rows_a_run(built):
    house = built[0]
    log = house.tables.read("metadata", LOG)
    ids = sorted(r.id for r in log.select("id").collect())
    assert ids == list(range(1, len(ids) + 1)) and len(ids) % 29 == 0
    house.log_checks(BRONZE, AS_OF + timedelta(days=1), "run-2")
    log = house.tables.read("metadata", LOG)
    assert log.count() == len(ids) + sum(len(c) for c in silver.CHECKS.values())
    assert log.where("run_id = 'run-2'").count() == 29
    assert log.select("id").distinct().count() == log.count()
    newest = house.failed_checks().first()
    assert newest.run_id == "run-2"
    assert house.check_trend().count() > 0


def test_layer_checks(built):
    house = built[0]
    bronze = {(r.check, r.table_name): r.ok for r in house.verify("bronze").collect()}
    assert all(bronze[("has rows", t)] for t in BRONZE)
    assert all(r.ok for r in house.verify("gold").collect())
    rates = {r.table_name: r for r in house.verify("silver").collect()}
    assert "payers" not in rates and rates["claims"].ok == (rates["claims"].value >= 95)
    assert {r.table_name for r in house.verify("dq").collect()} == {f"silver_{t}" for t in BRONZE}
    raw = house.verify("raw").collect()
    assert len(raw) == 18 and not any(r.ok for r in raw)  # built without a raw layer
    assert house.verify("all").count() > 40
    with pytest.raises(LookupError):
        house.verify("copper")


def test_one_changed_claim_makes_one_new_version(built, spark):
    house, raw, *_ = built
    from pyspark.sql import functions as F

    changed = raw["claims"].withColumn(
        "status1", F.when(F.col("id") == F.lit(1), "REOPENED").otherwise(F.col("status1")))
    ids = raw["claims"].where("id = 1").count()
    later = AS_OF + timedelta(days=2)
    assert house.load_bronze("claims", changed, later) == ids == 1
    house.load_silver("claims", later, "run-3")
    row = house.tables.read("silver", "claims").where("id = 1").collect()
    assert [r.claim_status for r in row] == ["OPEN"]


def test_empty_sources(spark, tmp_path, built):
    house = Warehouse(Tables(spark, str(tmp_path), lambda line: None))
    house.build({t: df.limit(0) for t, df in built[1].items()}, AS_OF, "empty")
    assert all(house.tables.read("gold", t).count() == 0 for t in GOLD_TABLES)
    log = house.tables.read("metadata", LOG).collect()
    assert len(log) == 29 and {(r.metric_value, r.status) for r in log} == {(0.0, "FAILED")}
    # A later run with data starts from these empty tables.
    assert house.load_bronze("payers", built[1]["payers"], AS_OF) > 0


def test_csv_folder_loads_once_and_skips_missing_files(spark, tmp_path):
    folder, lines = tmp_path / "in", []
    folder.mkdir()
    house = Warehouse(Tables(spark, str(tmp_path / "house"), lines.append))
    (folder / "payers.csv").write_text(
        "id,name,ownership,amount_covered\r\n"
        + "".join(f"{i},n{i},{'GOVERNMENT' if i < 3 else 'PRIVATE' if i < 9 else 'NO_INSURANCE'},1.50\r\n"
                  for i in range(10)))
    assert house.load_csv_folder(str(folder)) == {"payers": 10}
    assert "  SKIP patients: file not found" in lines
    (folder / "patients.csv").write_text("id,birthdate,ssn\nA,2000-01-01,1\n")
    assert house.load_csv_folder(str(folder)) == {"payers": 10, "patients": 1}
    assert house.load_csv_folder(str(folder)) == {}
    assert {r.table_name for r in house.raw_duplicates().collect()} >= {"payers", "claims"}
    orphans = house.raw_orphans().collect()
    assert len(orphans) == 40 and all(r.orphan_rows == 0 for r in orphans)
    # Nine of ten owners are known: exactly the threshold, which passes.
    house.load_bronze("payers", house.tables.read("raw", "payers"), AS_OF)
    house.load_silver("payers", AS_OF, "r")
    check = house.tables.read("metadata", LOG).where("column_name = 'ownership'").first()
    assert (check.metric_value, check.status) == (90.0, "PASSED")
    with pytest.raises(LookupError):
        house.tables.read("silver", "claims")
