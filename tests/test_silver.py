"""Hand-made edge rows for the silver layer."""

from datetime import date, datetime
from decimal import Decimal

from lamina.plans import bronze, silver

T0, T1 = datetime(2024, 1, 1), datetime(2024, 6, 30)

RAW = {
    "encounters": "id string, patient string, payer string, encounterclass string, "
                  "start timestamp_ntz, stop timestamp_ntz, base_encounter_cost decimal(15,2), "
                  "total_claim_cost decimal(15,2), payer_coverage decimal(15,2)",
    "claims": "id string, patientid string, primarypatientinsuranceid string, "
              "servicedate timestamp_ntz, status1 string, status2 string, statusp string, "
              "outstanding1 decimal(15,2), outstanding2 decimal(15,2), outstandingp decimal(15,2), "
              "lastbilleddate1 timestamp_ntz",
    "claims_transactions": "id string, claimid string, patientid string, type string, "
                           "amount decimal(15,2), method string, fromdate timestamp_ntz, "
                           "todate timestamp_ntz, payments decimal(15,2), adjustments decimal(15,2), "
                           "transfers decimal(15,2), outstanding decimal(15,2)",
    "patients": "id string, birthdate date, deathdate date, gender string, race string, "
                "ethnicity string",
    "conditions": "patient string, encounter string, code string, description string, "
                  "start date, stop date",
    "careplans": "id string, patient string, encounter string, code string, description string, "
                 "start date, stop date, reasoncode string, reasondescription string",
    "payers": "id string, name string, ownership string, amount_covered decimal(15,2), "
              "amount_uncovered decimal(15,2)",
}


def build(rows, table, *tuples, at=T1):
    return bronze.stage(rows(RAW[table], *tuples), table, at)


def result(table, frame):
    return {r.id: r for r in silver.BUILDERS[table](frame, T1).collect()}


def encounter(id, start="2020-01-01 00:00:00", stop=None, cost=None, cover=None, cls="x"):
    return (id, "p", "y", cls, start, stop, None, cost, cover)


def test_latest_version_wins_and_null_id_is_dropped(rows):
    old = build(rows, "encounters", encounter("a", cls=" OLD "), encounter(None), at=T0)
    new = build(rows, "encounters", encounter("a", cls=" New "), at=T1)
    got = result("encounters", old.unionByName(new))
    assert list(got) == ["a"]
    assert got["a"].encounter_class == "new"


def test_first_warning_wins(rows):
    got = result("encounters", build(
        rows, "encounters",
        encounter("both", stop="2019-12-31 00:00:00", cost=-5),
        encounter("late", stop="2019-12-31 00:00:00", cost=5),
        encounter("fine", stop="2020-01-02 00:00:00", cost=5),
    ))
    assert (got["both"]._dq_status, got["both"]._dq_notes) == ("WARN", "negative total_claim_cost")
    assert (got["late"]._dq_status, got["late"]._dq_notes) == ("WARN", "stop timestamp before start")
    assert (got["fine"]._dq_status, got["fine"]._dq_notes) == ("PASS", None)


def test_minutes_round_seconds_then_truncate(rows, spark):
    frame = build(
        rows, "encounters",
        encounter("up", stop="2020-01-01 00:01:59.6"),
        encounter("back", stop="2019-12-31 23:58:29"),
        encounter("open"),
        encounter("half", stop="2020-01-01 00:01:59.5"),
    )
    expected = {"up": 2, "back": -1, "open": None, "half": 2}
    assert {k: r.duration_minutes for k, r in result("encounters", frame).items()} == expected


def test_elapsed_time_ignores_the_session_zone(rows, spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:  # clocks went forward at 02:00 on 2020-03-08
        frame = build(rows, "encounters",
                      encounter("e", start="2020-03-08 01:00:00", stop="2020-03-08 04:00:00"))
        got = result("encounters", frame)["e"]
        assert got.duration_minutes == 180
        assert got.start_ts == datetime(2020, 3, 8, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_out_of_pocket_treats_missing_as_zero(rows):
    got = result("encounters", build(rows, "encounters", encounter("a", cover=10)))
    assert got["a"].patient_oop == Decimal("-10.00")


def test_claim_is_closed_only_when_all_three_are(rows):
    def claim(id, *statuses):
        return (id, "p", "y", "2020-01-01 00:00:00", *statuses, 1, None, 2, None)

    got = result("claims", build(
        rows, "claims",
        claim("any case", "closed", "CLOSED", "Closed"),
        claim("missing", "CLOSED", None, "CLOSED"),
        claim("padded", " CLOSED", "CLOSED", "CLOSED"),
    ))
    assert {k: r.claim_status for k, r in got.items()} == {
        "any case": "CLOSED", "missing": "OPEN", "padded": "OPEN"}
    assert got["any case"].total_outstanding == Decimal("3.00")


def test_days_to_payment_only_for_payments(rows):
    def txn(id, kind, start="2020-01-02 05:00:00", end="2020-01-01 00:00:00", claim="c", amount=1):
        return (id, claim, None, kind, amount, " cash ", start, end, 1, 1, 0, 0)

    got = result("claims_transactions", build(
        rows, "claims_transactions",
        txn("pay", " payment "), txn("charge", "CHARGE"), txn("undated", "PAYMENT", end=None),
        txn("lost", "CHARGE", claim=None, amount=-1), txn("neg", "CHARGE", amount=-1),
    ))
    assert (got["pay"].transaction_type, got["pay"].days_to_payment) == ("PAYMENT", -1)
    assert got["pay"].payment_method == "CASH"
    assert got["charge"].days_to_payment is None
    assert got["undated"].days_to_payment is None
    assert got["lost"]._dq_notes == "missing claim_id"
    assert got["neg"]._dq_notes == "negative amount"


def test_ages(rows):
    years = {2007: "0-17", 2006: "18-34", 1990: "18-34", 1989: "35-50", 1974: "35-50",
             1973: "51-65", 1959: "51-65", 1958: "65+"}
    people = [(str(y), date(y, 12, 31), None, "F", " r ", "e") for y in years]
    got = result("patients", build(rows, "patients", *people, ("none", None, "2020-01-01", "x", "r", "e")))
    assert {int(k): r.age_group for k, r in got.items() if k != "none"} == years
    unknown = got["none"]
    assert (unknown.birth_year, unknown.age_group, unknown._dq_status) == (None, "65+", "WARN")
    assert unknown._dq_notes == "missing birthdate — age_group unknown"
    assert unknown.is_deceased and not got["2007"].is_deceased
    assert got["2007"].race == "r"


def test_gender(rows):
    given = {" m ": "Male", "FEMALE": "Female", "x": "Unknown", None: "Unknown"}
    people = [(str(g), date(2000, 1, 1), None, g, None, None) for g in given]
    got = result("patients", build(rows, "patients", *people))
    assert {k: r.gender for k, r in got.items()} == {str(g): v for g, v in given.items()}


def test_exact_dates_do_not_leave_bronze(rows):
    frame = build(rows, "patients", ("a", date(2000, 1, 1), None, "F", None, None))
    assert not {"birthdate", "deathdate"} & set(silver.patients(frame, T1).columns)


def test_conditions_without_encounter_share_a_record(rows):
    frame = build(
        rows, "conditions",
        ("p", None, "c", "first", "2020-01-01", None),
        ("p", None, "c", "second", "2020-01-01", None),
        ("p", None, " c", "other code until trimmed", "2020-01-01", "2020-02-01"),
        (None, "e", "c", "nobody", "2020-01-01", None),
    )
    got = silver.conditions(frame, T1).collect()
    assert len(got) == 2 and {r.code for r in got} == {"c"}
    assert {r._dq_notes for r in got} == {"missing encounter_id"}
    assert sorted(r.is_active for r in got) == [False, True]


def test_careplans_without_id_share_a_record(rows):
    def plan(id, patient, at):
        return build(rows, "careplans", (id, patient, "e", "c", "d", "2020-01-01", None, " r ", None), at=at)

    frame = plan(None, "p1", T0).unionByName(plan(None, "p2", T1)).unionByName(plan("a", None, T1))
    got = silver.careplans(frame, T1).collect()
    assert [(r.id, r.patient_id, r.reason_code) for r in got] == [(None, "p2", "r")]
    # The newest row decides, even when it is dropped for having no patient.
    gone = plan(None, "p1", T0).unionByName(plan(None, None, T1))
    assert silver.careplans(gone, T1).count() == 0


def test_payers(rows):
    got = result("payers", build(rows, "payers", ("a", " Name ", " Private ", 1, 2)))["a"]
    assert (got.name, got.ownership) == ("Name", "PRIVATE")
    assert "_dq_status" not in got.asDict()


def test_rows_with_equal_hash_still_have_one_winner(rows):
    """NULLs are skipped by the hash, so these two collide; the order is total."""
    a, b = ("p", "e", "c", "d", "2020-01-01", None), ("p", "e", "c", "d", None, "2020-01-01")
    winners = set()
    for pair in ((a, b), (b, a)):
        row = silver.conditions(build(rows, "conditions", *pair), T1).first()
        winners.add((row.start_date, row.end_date))
    assert winners == {(date(2020, 1, 1), None)}
