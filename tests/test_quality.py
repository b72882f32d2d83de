from datetime import datetime, timezone

import pytest

from lamina.operators import quality
from lamina.operators.quality import Check, gte_zero, in_set, not_null, passed_rows
from lamina.plans import silver

AS_OF = datetime(2024, 6, 30)


def measured(df, *checks):
    return [(r.metric_value, r.status) for r in quality.measure(df, "t", checks).collect()]


def test_nulls_count_as_a_rule_says(rows):
    df = rows("v int, _dq_status string", (None, "PASS"), (1, "WARN"), (-1, "PASS"))
    got = measured(
        df,
        Check("v", "accuracy", gte_zero("v"), 50),
        Check("v", "completeness", not_null("v"), 70),
        Check("v", "validity", in_set("v", (1, -1)), 0),
        Check(None, "completeness", passed_rows(), 60),
    )
    assert [round(v, 2) for v, _ in got] == [50.0, 66.67, 66.67, 66.67]
    assert [s for _, s in got] == ["PASSED", "FAILED", "PASSED", "PASSED"]


def test_empty_table_fails_everything(rows):
    df = rows("v int, _dq_status string")
    got = measured(
        df, Check("v", "accuracy", gte_zero("v"), 50),
        Check("v", "completeness", not_null("v"), 70),
        Check("v", "validity", in_set("v", (1,)), 1),
        Check(None, "completeness", passed_rows(), 60))
    assert got == [(0.0, "FAILED")] * 4


def test_all_checks_share_one_scan_and_one_aggregate(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    rows("id string, patient_id string, encounter_class string, total_claim_cost decimal(15,2), "
         "_dq_status string", ("a", "p", "home", 1, "PASS")).write.parquet(path)
    plan = quality.measure(spark.read.parquet(path), "t", silver.CHECKS["encounters"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1


def test_values_are_quoted(rows):
    df = rows("v string", ("it's",), ("back\\slash",), ("x",))
    got = measured(df, Check("v", "validity", in_set("v", ("it's", "back\\slash")), 66))
    assert round(got[0][0], 2) == 66.67


def test_every_check_is_registered():
    assert sum(len(c) for c in silver.CHECKS.values()) == 29


def test_log_rows(rows):
    df = rows("v int", (1,))
    checks = [Check("v", "completeness", not_null("v"), 100)]
    row = quality.log_rows(quality.measure(df, "t", checks), "run", AS_OF).first()
    assert (row.id, row.run_id, row.checked_at) == (1, "run", AS_OF)


def test_run_label():
    from lamina.plans.warehouse import run_label

    at = datetime(2024, 6, 30, 1, 2, 3, tzinfo=timezone.utc)
    prefix, stamp, tail = run_label("silver", at).split("/")
    assert (prefix, stamp, len(tail)) == ("silver", "2024-06-30T01:02:03Z", 36)
    assert run_label("silver", at) != run_label("silver", at)


@pytest.mark.parametrize("hits,status", [(9, "PASSED"), (8, "FAILED")])
def test_threshold_is_inclusive(rows, hits, status):
    df = rows("v string", *[("a",)] * hits, *[("b",)] * (10 - hits))
    got = measured(df, Check("v", "validity", in_set("v", ("a",)), 90))
    assert got[0][1] == status
