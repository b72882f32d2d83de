"""Merges batch by batch against full builds over all rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from harness.adapters import source
from lamina.plans import bronze, gold, incremental, silver
from lamina.plans.warehouse import Warehouse
from lamina.schemas import BRONZE
from lamina.sources.tables import Tables

SF = "/root/testdata/sf0.001"
AS_OF = datetime(2024, 6, 30)


@pytest.fixture
def house(spark, tmp_path):
    return Warehouse(Tables(spark, str(tmp_path / "house"), lambda line: None), hash_buckets=4, key_buckets=4)


def rows_of(df, *without):
    return sorted(map(str, df.drop(*without).collect()))


def batches(spark, table, seed):
    """Three batches of a source, of some loads each: versions that are newer, late, of equal time, and new rows."""
    raw = source(spark, SF, table)
    part = F.pmod(F.xxhash64(*raw.columns, F.lit(seed)), F.lit(10))
    text = next(c for c, k in raw.dtypes if k == "string" and c not in silver.SILVER[table].keys) if table != "encounters" else "encounterclass"
    other = raw.withColumn(text, F.concat(F.col(text), F.lit(" new")))
    day = timedelta(days=1)
    return [[(raw.where(part < 6), AS_OF)], [(other.where(part.isin(1, 2, 7)), AS_OF + day), (raw.where(part.isin(7, 8)), AS_OF + day)],
            [(other.where(part.isin(3, 8, 9)), AS_OF - day), (other.where(part == 4), AS_OF)]]


@pytest.mark.parametrize("table", list(BRONZE))
@pytest.mark.parametrize("broadcast", [True, False])
def test_silver_by_merges_is_silver_of_all(spark, house, request, table, broadcast):
    if not broadcast:
        if table not in ("claims", "conditions"):
            pytest.skip("two tables are enough")
        request.getfixturevalue("no_broadcast")
    for loads in batches(spark, table, 1):
        for raw, at in loads:
            house.tables.append("bronze", table, bronze.stage(raw, table, at))
        house.merge_silver(table, AS_OF)
        whole = silver.BUILDERS[table](house.tables.read("bronze", table), AS_OF)
        assert rows_of(house.tables.read("silver", table)) == rows_of(whole)
    assert house.merge_silver(table, AS_OF) == 0
    house.tables.append("bronze", table, house.tables.read("bronze", table).limit(0))  # a load without new rows
    assert house.merge_silver(table, AS_OF) == 0


def test_only_touched_buckets_are_written(spark, house):
    raw = source(spark, SF, "claims")
    house.tables.append("bronze", "claims", bronze.stage(raw, "claims", AS_OF))
    assert house.merge_silver("claims", AS_OF) == 4
    before = {b: house.tables.folders("silver", "claims", [b]) for b in range(4)}
    one = raw.limit(1).withColumn("status1", F.lit("changed"))
    house.tables.append("bronze", "claims", bronze.stage(one, "claims", AS_OF + timedelta(days=1)))
    assert house.merge_silver("claims", AS_OF + timedelta(days=2)) == 1
    after = {b: house.tables.folders("silver", "claims", [b]) for b in range(4)}
    assert sum(before[b] != after[b] for b in range(4)) == 1
    late = house.tables.read("silver", "claims").where(F.col("_silver_processed_at") > F.lit(AS_OF)).count()
    assert 0 < late < raw.count()  # rows of the other buckets keep their time
    house.tables.refresh("silver", "claims", silver.claims(house.tables.read("bronze", "claims"), AS_OF))  # a full build between
    house.tables.append("bronze", "claims", bronze.stage(raw.limit(1).withColumn("status1", F.lit("again")), "claims", AS_OF + timedelta(days=3)))
    house.merge_silver("claims", AS_OF)
    assert rows_of(house.tables.read("silver", "claims")) == rows_of(silver.claims(house.tables.read("bronze", "claims"), AS_OF))


def test_a_merge_that_fails_changes_nothing(spark, house, monkeypatch):
    raw = source(spark, SF, "claims")
    house.tables.append("bronze", "claims", bronze.stage(raw.limit(900), "claims", AS_OF))
    house.merge_silver("claims", AS_OF)
    before = rows_of(house.tables.read("silver", "claims"))
    house.tables.append("bronze", "claims", bronze.stage(raw, "claims", AS_OF + timedelta(days=1)))
    shaped = silver.shaped
    monkeypatch.setattr(silver, "shaped", lambda *a: shaped(*a).where("cast(raise_error('broken') as boolean)"))
    with pytest.raises(Exception, match="broken"):
        house.merge_silver("claims", AS_OF)
    assert rows_of(house.tables.read("silver", "claims")) == before
    monkeypatch.undo()
    house.merge_silver("claims", AS_OF)
    assert rows_of(house.tables.read("silver", "claims")) == rows_of(silver.claims(house.tables.read("bronze", "claims"), AS_OF))


MERGES = {
    "fact_claims": (Warehouse.merge_fact_claims, gold.fact_claims, ("claims", "claims_transactions", "encounters"), "claim"),
    "fact_encounters": (Warehouse.merge_fact_encounters, gold.fact_encounters, ("encounters", "conditions", "careplans"), "encounter"),
}


def full_fact(house, fact="fact_claims"):
    _, build, names, _ = MERGES[fact]
    rows = [silver.BUILDERS[n](house.tables.read("bronze", n), AS_OF) for n in names]
    return build(*rows, *[house.tables.read("gold", d) for d in ("dim_patients", "dim_payers")])


@pytest.mark.parametrize("name", MERGES)
def test_fact_by_merges_is_the_fact_of_all(spark, house, name):
    merge, _, tables, entity = MERGES[name]
    tables = (*tables, "patients", "payers")
    sources = {t: batches(spark, t, 5) for t in tables}
    if name == "fact_encounters":  # encounters move to other days, also far back
        sources["encounters"] = [[(df.withColumn("start", F.col("start") - F.expr(f"interval {13 * k} days")), at) for df, at in loads]
                                 for k, loads in enumerate(sources["encounters"])]
    keys = {}
    for step in range(3):
        for table in tables:
            for raw, at in sources[table][step]:
                house.tables.append("bronze", table, bronze.stage(raw, table, at))
            house.merge_silver(table, AS_OF)
        for dim in ("dim_patients", "dim_payers"):
            house.load_gold(dim, AS_OF)
        merge(house)
        fact = house.tables.read("gold", name)
        assert rows_of(fact, f"{entity}_key") == rows_of(full_fact(house, name), f"{entity}_key")
        given = dict(fact.select(f"{entity}_id", f"{entity}_key").collect())
        assert len(set(given.values())) == len(given) and all(given[i] == k for i, k in keys.items() if i in given)
        keys |= given
    assert merge(house) == 0


def test_one_changed_transaction_computes_one_claim(spark, house):
    for table in BRONZE:
        house.tables.append("bronze", table, bronze.stage(source(spark, SF, table), table, AS_OF))
        house.merge_silver(table, AS_OF)
    for dim in ("dim_patients", "dim_payers"):
        house.load_gold(dim, AS_OF)
    house.merge_fact_claims()
    before = rows_of(house.tables.read("gold", "fact_claims"))
    one = source(spark, SF, "claims_transactions").where("claimid is not null").orderBy("id").limit(1).withColumn("payments", F.lit(77).cast("decimal(15,2)"))
    house.tables.append("bronze", "claims_transactions", bronze.stage(one, "claims_transactions", AS_OF + timedelta(days=1)))
    house.merge_silver("claims_transactions", AS_OF)
    assert house.merge_fact_claims() == 1
    after = rows_of(house.tables.read("gold", "fact_claims"))
    assert len(set(before) - set(after)) == 1 and after == rows_of(full_fact(house))


def test_build_by_merges(spark, tmp_path):
    """Two runs by merges, and one full run, answer alike."""
    houses = [Warehouse(Tables(spark, str(tmp_path / n), lambda line: None), key_buckets=3) for n in ("a", "b")]
    raw = {t: source(spark, SF, t) for t in BRONZE}
    houses[0].build({t: df.where(F.pmod(F.xxhash64(*df.columns), F.lit(2)) == 0) for t, df in raw.items()}, AS_OF, "1", by_merges=True)
    houses[0].build(raw, AS_OF, "2", by_merges=True)
    houses[1].build(raw, AS_OF, "2")
    for answer in ("revenue_cycle", "payer_settlement", "readmission"):
        assert rows_of(getattr(houses[0], answer)()) == rows_of(getattr(houses[1], answer)())
    assert houses[0].verify("gold").where("not ok").collect() == houses[1].verify("gold").where("not ok").collect()


def test_states_add_up(spark):
    """Totals of states are those of the rows, whatever came and went."""
    rng = random.Random(3)
    ddl = "claim_id long, transaction_type string, days_to_payment int, payments decimal(15,2), adjustments decimal(15,2), sign int"
    made = [(rng.choice([1, 2, 3, None]), rng.choice(["PAYMENT", "CHARGE"]), rng.choice([None, 3, -4]), rng.choice([None, rng.randint(-9, 9)]),
             rng.choice([None, rng.randint(0, 5)])) for _ in range(60)]
    went = made[:25]
    rows = [(*r, 1) for r in made] + [(*r, -1) for r in went]
    frame = spark.createDataFrame([tuple(str(v) if v is not None else None for v in r) for r in rows], ", ".join(f"{c.split()[0]} string" for c in ddl.split(", ")))
    frame = frame.select(*[F.col(c.split()[0]).cast(c.split()[1]).alias(c.split()[0]) for c in ddl.split(", ")])
    plain = gold.transaction_totals(frame.where("sign = 1").exceptAll(frame.where("sign = -1").withColumn("sign", F.lit(1))))
    assert rows_of(incremental.totals_of(incremental.transaction_states(frame))) == rows_of(plain)


def test_a_back_dated_encounter_concerns_its_own_and_the_next_day(spark, house):
    ddl = "id long, patient long, payer long, encounterclass string, start timestamp_ntz, stop timestamp_ntz, base_encounter_cost decimal(15,2), total_claim_cost decimal(15,2), payer_coverage decimal(15,2)"

    def load(*rows, day=0):
        frame = spark.createDataFrame([(i, p, 1, c, datetime(2024, m, d), None, None, None, None) for i, p, c, m, d in rows], ddl)
        house.tables.append("bronze", "encounters", bronze.stage(frame, "encounters", AS_OF + timedelta(days=day)))
        house.merge_silver("encounters", AS_OF)
        done = house.merge_fact_encounters()
        assert rows_of(house.tables.read("gold", "fact_encounters"), "encounter_key") == rows_of(full_fact(house, "fact_encounters"), "encounter_key")
        return done

    for table in ("patients", "payers", "conditions", "careplans"):
        house.tables.append("bronze", table, bronze.stage(source(spark, SF, table), table, AS_OF))
        house.merge_silver(table, AS_OF)
    for dim in ("dim_patients", "dim_payers"):
        house.load_gold(dim, AS_OF)
    load(*[(k, 1, "emergency", k, 1) for k in range(1, 10, 2)], (20, None, "inpatient", 1, 1), (21, None, "inpatient", 3, 1), (30, 2, "inpatient", 1, 1))
    assert load((40, 1, "wellness", 4, 25)) == 2  # itself and that of 1 May, a readmission now
    assert load((40, 1, "wellness", 6, 25), day=1) == 3  # itself, 1 May and 1 July
    assert load((41, None, "emergency", 2, 20)) == 2
    assert load((50, 2, "inpatient", 1, 1)) == 2


def test_empty_tables(spark, house):
    for table in BRONZE:
        house.tables.append("bronze", table, bronze.stage(source(spark, SF, table).limit(0), table, AS_OF))
        assert house.merge_silver(table, AS_OF) == 0 and house.tables.read("silver", table).count() == 0
    for dim in ("dim_patients", "dim_payers"):
        house.load_gold(dim, AS_OF)
    for _ in range(2):
        assert house.merge_fact_claims() == 0 and house.merge_fact_encounters() == 0
    assert house.tables.read("gold", "fact_claims").count() == house.tables.read("gold", "fact_encounters").count() == 0
