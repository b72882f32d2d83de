"""Hand-made edge rows and brute-force comparisons for the gold layer."""

import random
from collections import Counter
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lamina.operators import skew
from lamina.operators.skew import balanced_join, heavy_hitters, heavy_hitters_of
from lamina.operators.surrogate import dense_keys, ensure_checkpoint_dir
from lamina.plans import answers, gold

AS_OF = datetime(2024, 6, 30)
ENC = ("id string, patient_id string, payer_id string, encounter_class string, "
       "start_ts timestamp_ntz, duration_minutes int, total_claim_cost decimal(15,2), "
       "payer_coverage decimal(15,2), patient_oop decimal(15,2)")
CLM = ("id string, patient_id string, payer_id string, service_date timestamp_ntz, "
       "claim_status string, total_outstanding decimal(15,2)")
TXN = ("id string, claim_id string, transaction_type string, days_to_payment int, "
       "payments decimal(15,2), adjustments decimal(15,2)")
CND = "encounter_id string, code string, description string"
CP = "patient_id string, start_date date, is_active boolean"
PAT = "patient_key bigint, patient_id string"
PAY = "payer_key bigint, payer_id string, name string, ownership string"
D0 = datetime(2020, 1, 1, 8)


def enc(id, patient="p", at=D0, cls="emergency", cost=1, payer="y"):
    return (id, patient, payer, cls, at, 5, cost, 1, 0)


def facts(rows, encounters, conditions=(), careplans=()):
    df = gold.fact_encounters(
        rows(ENC, *encounters), rows(CND, *conditions), rows(CP, *careplans),
        rows(PAT, (1, "p")), rows(PAY, (1, "y", "n", "o")))
    return {r.encounter_id: r for r in df.collect()}


# --- encounters ---


def test_readmission_window_is_inclusive_and_any_class_counts(rows):
    got = facts(rows, [
        enc("a", at=D0, cls="wellness"),
        enc("b", at=D0 + timedelta(days=30)),
        enc("c", at=D0 + timedelta(days=60, seconds=1), cls="inpatient"),
        enc("d", at=D0 + timedelta(days=61), cls="home"),
    ])
    assert [got[k].is_readmission for k in "abcd"] == [False, True, False, False]


def test_readmission_ties_and_same_day(rows):
    got = facts(rows, [
        enc("a"), enc("b"), enc("c", at=D0 + timedelta(hours=1), cls="inpatient"),
        enc("n1", patient=None), enc("n2", patient=None, at=D0 + timedelta(days=3)),
    ])
    assert {k: r.is_readmission for k, r in got.items()} == {
        "a": False, "b": True, "c": True, "n1": False, "n2": True}


def test_care_plan_must_be_open_and_started_by_that_day(rows):
    day = D0.date()
    for plan, expected in [
        ((day - timedelta(days=9), False), False),
        ((day, True), True),
        ((day + timedelta(days=1), True), False),
        ((None, True), False),
    ]:
        got = facts(rows, [enc("a"), enc("b", patient=None)], careplans=[("p", *plan), (None, day, True)])
        assert got["a"].has_active_careplan is expected
        assert got["b"].has_active_careplan is False


def test_condition_counts_and_missing_keys(rows):
    got = facts(rows, [enc("a"), enc("b", patient="?", payer=None), enc("c", at=None)],
                conditions=[("a", "x", "d"), ("a", "y", "d"), (None, "z", "d")])
    assert set(got) == {"a", "b"}
    assert (got["a"].condition_count, got["b"].condition_count) == (2, 0)
    assert (got["a"].patient_key, got["a"].payer_key, got["a"].date_key) == (1, 1, 20200101)
    assert (got["b"].patient_key, got["b"].payer_key) == (None, None)
    assert sorted(r.encounter_key for r in got.values()) == [1, 2]


# --- claims ---


def claim_facts(rows, claims, encounters=(), transactions=()):
    df = gold.fact_claims(
        rows(CLM, *claims), rows(TXN, *transactions), rows(ENC, *encounters),
        rows(PAT, (1, "p")), rows(PAY, (1, "y", "n", "o")))
    return {r.claim_id: r for r in df.collect()}


def claim(id, patient="p", at=D0, payer="y"):
    return (id, patient, payer, at, "OPEN", 3)


def test_claim_takes_the_first_encounter_of_the_day(rows):
    got = claim_facts(
        rows,
        [claim("a"), claim("b", at=D0 + timedelta(days=1)), claim("c", patient=None), claim("d", at=None)],
        [enc("late", at=D0 + timedelta(hours=3), cls="home", cost=9),
         enc("early", at=D0 - timedelta(hours=3), cls="snf", cost=7),
         enc("nobody", patient=None)])
    assert set(got) == {"a", "b", "c"}
    assert (got["a"].encounter_class, got["a"].total_claim_cost) == ("snf", Decimal("7.00"))
    for other in "bc":
        assert (got[other].encounter_class, got[other].total_claim_cost) == ("unknown", None)
    assert got["b"].service_date_key == 20200102


def test_claim_without_transactions(rows):
    got = claim_facts(rows, [claim("a")], transactions=[("t", None, "PAYMENT", 4, 5, 6)])["a"]
    assert (got.total_payments, got.total_adjustments, got.avg_days_to_payment) == (0, 0, None)


def test_mean_days_counts_payments_only(rows):
    pay = [(str(i), "a", "PAYMENT", d, 1, None) for i, d in enumerate((1, 2, 2, None))]
    got = claim_facts(rows, [claim("a")], transactions=[*pay, ("x", "a", "CHARGE", 90, None, 2)])["a"]
    assert got.avg_days_to_payment == Decimal("1.67")
    assert (got.total_payments, got.total_adjustments) == (Decimal("4.00"), Decimal("2.00"))


# --- dimensions ---


def test_condition_category(rows):
    texts = {"s": "Stress (finding)", "a": "ASTHMA", "x": "X (disorder)", "n": None}
    df = rows(CND, *[(None, c, d) for c, d in texts.items()],
              (None, "m", None), (None, "m", "b"), (None, "m", "a"), (None, None, "lost"))
    got = {r.code: r for r in gold.dim_conditions(df).collect()}
    assert {c: got[c].condition_category for c in texts} == {
        "s": "Acute", "a": "Chronic", "x": "Chronic", "n": "Acute"}
    assert got["m"].description == "a"
    assert [got[c].condition_key for c in sorted(got)] == [1, 2, 3, 4, 5]


def test_calendar(rows, spark):
    days = {r.full_date: r for r in gold.dim_date(rows("first_day date", (date(2021, 1, 3),)), AS_OF).collect()}
    sunday = days[date(2021, 1, 3)]
    assert (sunday.date_key, sunday.week_of_year, sunday.is_weekend) == (20210103, 53, True)
    assert (sunday.day_of_week, sunday.month_name) == ("Sunday   ", "January  ")
    assert max(days) == AS_OF.date() and len(days) == (AS_OF.date() - date(2021, 1, 3)).days + 1


@pytest.mark.parametrize("start", [None, date(2030, 1, 1)])
def test_calendar_without_a_start_is_empty(rows, start):
    assert gold.dim_date(rows("first_day date", (start,)), AS_OF).count() == 0


def test_first_day_over_no_rows(rows):
    assert gold.dim_date(gold.first_claim_day(rows(CLM)), AS_OF).count() == 0
    both = gold.first_warehouse_day(rows(CLM), rows(ENC, enc("a")))
    assert both.first().first_day == D0.date()


def test_insert_ignore_keeps_one_row_per_key(rows):
    df = rows("id string, name string, ownership string", ("b", "z", "o"), ("b", "a", "o"), (None, "x", "o"), ("a", "m", "o"))
    got = [(r.payer_key, r.payer_id, r.name) for r in gold.dim_payers(df).orderBy("payer_key").collect()]
    assert got == [(1, "a", "m"), (2, "b", "a")]


# --- surrogate keys ---


def test_dense_keys_follow_the_natural_order(spark):
    ids = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("k")).repartition(7)
    got = dense_keys(ids, "k", "n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 20_001))
    assert [r.k for r in got] == sorted(r.k for r in got)


def test_numbering_sorts_in_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keyed = dense_keys(spark.range(10_000).select(F.col("id").alias("k")), "k", "n")
        assert keyed.select(F.spark_partition_id()).distinct().count() > 1
        assert keyed.where("n <> k + 1").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_cluster_without_shared_folder_is_an_error():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda name, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


# --- skew ---


def _skewed(spark, n=6000):
    """Half of the rows: a third under one key, a sixth NULL."""
    key = (F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 6 == 1, F.lit(None))
           .otherwise((F.col("id") % 50).cast("string")))
    return spark.range(n).select("id", key.alias("k"))


@pytest.mark.parametrize("how", ["left", "left_anti", "left_semi"])
def test_balanced_join_equals_plain_join(spark, no_broadcast, how):
    left = _skewed(spark)
    right = spark.createDataFrame([("hot", 1), ("2", 2), ("5", 3), ("none", 4)], "k string, v int")
    joined = balanced_join(left, right, ["k"], how, F.col("id"), min_rows=500)
    assert "_salt" in joined._jdf.queryExecution().toString()
    plain = left.join(right, ["k"], how)
    assert joined.columns == plain.columns
    assert Counter(map(tuple, joined.collect())) == Counter(map(tuple, plain.collect()))


def test_hot_rows_are_spread(spark, no_broadcast):
    """No join partition keeps the third of the rows that share one key."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        left, right = _skewed(spark), spark.createDataFrame([("hot", 1)], "k string, v int")
        joined = balanced_join(left, right, ["k"], "left", F.col("id"), min_rows=500)
        sizes = joined.where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) == 4 and max(r["count"] for r in sizes) < 1000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_no_sketch_and_no_salt_for_small_sides(spark):
    right = spark.sql("select 'hot' as k, 1 as v")
    joined = balanced_join(_skewed(spark), right, ["k"], "left", F.col("id"), min_rows=1)
    assert "_salt" not in joined._jdf.queryExecution().toString()


def test_heavy_hitters_are_bounded(spark):
    even = spark.range(10_000).select((F.col("id") % 1000).alias("k"))
    assert heavy_hitters(even, ["k"], min_rows=100) == []
    assert len(heavy_hitters(_skewed(spark), ["k"], min_rows=800)) == 2


def test_heavy_hitters_of_several_keys(spark):
    df = _skewed(spark).withColumn("even", F.col("id") % 2)
    several = heavy_hitters_of(df, [["k"], ["id"], ["even"], ["k", "even"]], min_rows=800)
    assert several == [sorted(heavy_hitters(df, k, min_rows=800), key=several[i].index)
                       for i, k in enumerate((["k"], ["id"], ["even"], ["k", "even"]))]
    assert [len(found) for found in several] == [2, 0, 2, 3]


# --- brute force with one patient on a third of everything ---


@pytest.fixture(params=[3, 11])
def crowd(request):
    rnd = random.Random(request.param)

    def patient():
        return rnd.choice(["hot", "hot", None, "p1", "p2", "p3", "gone"])

    def moment():
        return D0 + timedelta(days=rnd.choice((0, 1, 29, 30, 31, 45, 90)), hours=rnd.randrange(4))

    encounters = [
        enc(f"e{i:03}", patient(), rnd.choice((None, *[moment() for _ in range(9)])),
            rnd.choice(("emergency", "inpatient", "home", None)), i, rnd.choice(("y", "z", None)))
        for i in range(300)
    ]
    plans = [(patient(), (D0 + timedelta(days=rnd.randrange(60))).date(), rnd.random() < .3)
             for _ in range(12)]
    conditions = [(f"e{rnd.randrange(300):03}", "c", "d") for _ in range(200)]
    claims = [claim(f"c{i:03}", patient(), moment(), rnd.choice(("y", None))) for i in range(200)]
    return encounters, conditions, plans, claims


@pytest.fixture
def salted(monkeypatch, no_broadcast):
    monkeypatch.setattr(skew, "HOT_MIN_ROWS", 20)


DIM_PATIENTS = [(i + 1, p) for i, p in enumerate(("hot", "p1", "p2", "p3"))]


def test_encounter_fact_against_brute_force(rows, crowd, salted):
    encounters, conditions, plans, _ = crowd
    df = gold.fact_encounters(rows(ENC, *encounters), rows(CND, *conditions), rows(CP, *plans),
                              rows(PAT, *DIM_PATIENTS), rows(PAY, (1, "y", "n", "o")))
    assert "_salt" in df._jdf.queryExecution().toString()
    keys = {p: k for k, p in DIM_PATIENTS}
    dated = sorted((e for e in encounters if e[4]), key=lambda e: (e[4], e[0]))
    last, expected = {}, {}
    for id, patient, payer, cls, at, *_ in dated:
        before = last.get(patient)
        last[patient] = at
        expected[id] = (
            keys.get(patient), 1 if payer == "y" else None,
            sum(c[0] == id for c in conditions),
            patient is not None and any(p == patient and a and s <= at.date() for p, s, a in plans),
            cls in ("emergency", "inpatient") and before is not None and at - before <= timedelta(days=30),
        )
    got = {r.encounter_id: (r.patient_key, r.payer_key, r.condition_count, r.has_active_careplan,
                            r.is_readmission) for r in df.collect()}
    assert got == expected


def test_claim_fact_against_brute_force(rows, crowd, salted):
    encounters, _, _, claims = crowd
    df = gold.fact_claims(rows(CLM, *claims), rows(TXN), rows(ENC, *encounters),
                          rows(PAT, *DIM_PATIENTS), rows(PAY, (1, "y", "n", "o")))
    assert "_salt" in df._jdf.queryExecution().toString()
    expected = {}
    for id, patient, _, at, *_ in claims:
        same = [e for e in encounters
                if patient and e[1] == patient and e[4] and e[4].date() == at.date()]
        first = min(same, key=lambda e: (e[4], e[0]), default=None)
        expected[id] = (
            {p: k for k, p in DIM_PATIENTS}.get(patient),
            (first[3] if first else None) or "unknown",
            Decimal(first[6]) if first else None,
        )
    got = {r.claim_id: (r.patient_key, r.encounter_class, r.total_claim_cost) for r in df.collect()}
    assert got == expected


# --- answers ---


def test_revenue_answer_rounds_once_and_merges_equal_names(rows):
    fact = rows("payer_key bigint, encounter_class string, claim_status string, "
                "avg_days_to_payment decimal(10,2), total_outstanding decimal(15,2)",
                (1, "a", "OPEN", "1.00", 5), (2, "a", "OPEN", "1.10", 6), (1, "a", "CLOSED", 9, 9),
                (None, "a", "OPEN", 9, 9), (1, "b", "OPEN", None, None), (1, "c", "OPEN", None, 1))
    dim = rows(PAY, (1, "x", "n", "o"), (2, "y", "n", "o"))
    got = [tuple(r) for r in answers.revenue_cycle(fact, dim).collect()]
    assert got == [("n", "o", "b", None, None), ("n", "o", "a", Decimal("1.1"), Decimal("11.00")),
                   ("n", "o", "c", None, Decimal("1.00"))]
    assert [tuple(r) for r in answers.payer_settlement(fact, dim).collect()] == [("o", Decimal("3.7"))]


def test_readmission_answer(rows):
    fact = rows("encounter_class string, has_active_careplan boolean, is_readmission boolean",
                *[("inpatient", True, i == 0) for i in range(8)], ("home", True, False))
    assert [tuple(r) for r in answers.readmission(fact).collect()] == [(True, 8, 1, Decimal("12.50"))]
    assert answers.readmission_preview(fact).first().readmission_pct == Decimal("12.5")


def test_gold_checks_compute_each_silver_table_once(spark, monkeypatch):
    from pyspark.sql import functions as F

    from harness import catalog
    from lamina.plans import silver
    from lamina.schemas import raw_schema

    def few(session, _, table):
        return session.range(3).select(*[
            (F.col("id") if f.name in ("id", "patient") else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in raw_schema(table).fields])

    def counted(name, build):
        return lambda *args: (built.append(name), build(*args))[1]

    built = []
    monkeypatch.setattr(catalog, "source", few)
    monkeypatch.setattr(silver, "BUILDERS", {t: counted(t, b) for t, b in silver.BUILDERS.items()})
    assert catalog.queries()["check_gold"](spark, "").count() > 0
    assert built and len(built) == len(set(built))
