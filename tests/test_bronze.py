import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lamina.operators import append
from lamina.plans import bronze
from tests.test_silver import RAW

AS_OF = datetime(2024, 6, 30)
CND = RAW["conditions"]


def test_nulls_are_skipped_by_the_hash(rows):
    first = bronze.stage(rows(CND, ("a", None, "b", None, None, None)), "conditions", AS_OF)
    second = rows(CND, ("a", "b", None, None, None, None))
    assert bronze.increment(second, first, "conditions", AS_OF).count() == 0
    assert first.first()._row_hash == hashlib.md5(b"a|b").hexdigest()


def test_copies_in_one_batch_all_load_and_reload_adds_none(rows):
    raw = rows(CND, *[("a", "b", "c", "d", None, None)] * 2)
    empty = bronze.stage(raw.limit(0), "conditions", AS_OF)
    loaded = bronze.increment(raw, empty, "conditions", AS_OF)
    assert loaded.count() == 2
    assert bronze.increment(raw, None, "conditions", AS_OF).count() == 2
    assert bronze.increment(raw, None, "conditions", AS_OF, dedup_within_batch=True).count() == 1
    assert bronze.increment(raw, loaded, "conditions", AS_OF).count() == 0
    assert bronze.increment(raw, empty, "conditions", AS_OF, dedup_within_batch=True).count() == 1


def test_lineage_and_column_choice(rows):
    row = bronze.stage(rows(CND + ", extra string", ("a", "b", "c", "d", None, None, "secret")),
                       "conditions", AS_OF).first().asDict()
    assert "extra" not in row
    assert (row["_ingested_at"], row["_source_file"]) == (AS_OF, "conditions.csv")


def _copied(spark):
    """A third of the rows is one row copied."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("patient"),
        *[F.lit("x").alias(c) for c in ("encounter", "code", "description")],
        *[F.lit(None).cast("date").alias(c) for c in ("start", "stop")],
    )


@pytest.mark.parametrize("seen", [True, False])
@pytest.mark.parametrize("broadcast", [True, False])
def test_copies_against_a_large_target_stay_whole(spark, request, seen, broadcast):
    """All copies load, or none, whether the target's hashes are broadcast or not."""
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    staged = bronze.stage(_copied(spark), "conditions", AS_OF)
    known = staged.where("patient = 'hot'" if seen else "patient in ('1', '2')")
    new = append.new_rows(staged, known)
    assert new.count() == (2000 if seen else 2998)
    assert new.columns == staged.columns
    assert append.new_rows(staged, known, dedup_within_batch=True).count() == (2000 if seen else 1999)


def test_append_is_one_lazy_plan(spark, no_broadcast):
    """No job runs while it is planned, nothing is salted, checkpointed or made distinct."""
    staged = bronze.stage(_copied(spark), "conditions", AS_OF)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "append")
    new = append.new_rows(staged, staged.where("patient <> '7'"))
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert tracker.getJobIdsForGroup("planning") == []
    assert plan.count("Join") == 1 and "Aggregate" not in plan and "_salt" not in plan
    assert [r.patient for r in new.collect()] == ["7"]
