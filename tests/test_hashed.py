"""The bucketed hash history: exact appends, and plans that leave the history where it is."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lamina.plans import bronze
from lamina.plans.warehouse import Warehouse
from lamina.sources.hashed import HashHistory
from lamina.sources.tables import Tables

AS_OF = datetime(2024, 6, 30)


@pytest.fixture
def house(spark, tmp_path):
    return Warehouse(Tables(spark, str(tmp_path / "house"), lambda line: None), hash_buckets=4)


def conditions(spark, ids, hot=0):
    frame = spark.range(1).select(F.explode(F.array(*[F.lit(f"p{i}") for i in [*ids, *[0] * hot]])).alias("patient")) if ids or hot else \
        spark.range(0).select(F.col("id").cast("string").alias("patient"))
    return frame.select("patient", *[F.lit("x").alias(c) for c in ("encounter", "code", "description")],
                        *[F.lit(None).cast("date").alias(c) for c in ("start", "stop")])


def patients(house):
    return sorted(r["patient"] for r in house.tables.read("bronze", "conditions").collect())


@pytest.mark.parametrize("broadcast", [True, False])
def test_overlapping_loads(spark, house, request, broadcast):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    loads = [(range(5), 3), (range(3, 8), 4), ([], 0), (range(10), 50), (range(10), 0)]
    held = []
    for k, (ids, hot) in enumerate(loads):
        batch = [f"p{i}" for i in [*ids, *[0] * hot]]
        new = [p for p in batch if p not in held]  # copies within a batch all load
        assert house.load_bronze("conditions", conditions(spark, list(ids), hot), AS_OF + timedelta(days=k)) == len(new)
        held += new
        assert patients(house) == sorted(held)
    assert house.load_bronze("conditions", conditions(spark, [77, 77]), AS_OF, dedup_within_batch=True) == 1


def test_a_repeated_load_moves_only_hashes(spark, house, no_broadcast):
    """Its rows meet the hashes that aren't stored: none. Its own hashes are exchanged once."""
    house.load_bronze("conditions", conditions(spark, range(9)), AS_OF)
    history = HashHistory(house.tables, 4)
    batch = spark.range(9).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("hash"))
    plan = history.unknown(batch, "bronze", "conditions")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") + plan.count("REPARTITION_BY_NUM") == 2  # the same exchange, named by both
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    again = bronze.increment_by_history(conditions(spark, range(9)), history, "conditions", AS_OF)
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "Exchange hashpartitioning" not in plan and again.count() == 0


def exchanges_above_scans(plan):
    """Whether an exchange stands between the history's scan and its join."""
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if "lamina_hashes_" in line)
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    above, level = [], depth[at]
    for i in range(at, -1, -1):
        if depth[i] < level:
            level = depth[i]
            above.append(lines[i].strip(" :+-").split(" ")[0])
            if "Join" in above[-1]:
                return "Exchange" in above, lines[at]
    raise AssertionError(plan)


def test_the_history_is_not_moved(spark, house, no_broadcast, capsys):
    for k in range(3):
        house.load_bronze("conditions", conditions(spark, list(range(3 * k, 3 * k + 6))), AS_OF + timedelta(days=k))
    history = HashHistory(house.tables, 4)
    batch = spark.range(9).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("hash"))
    history.known(batch, "bronze", "conditions").explain()
    moved, scan = exchanges_above_scans(capsys.readouterr().out)
    assert not moved and "Bucketed: true" in scan


def test_companions_are_written_once_and_mended(spark, house, tmp_path):
    house.load_bronze("conditions", conditions(spark, [1, 2]), AS_OF)
    house.load_bronze("conditions", conditions(spark, [2, 3]), AS_OF)
    base = tmp_path / "house" / "_hashes" / "bronze-conditions-4"
    files = {p: p.stat().st_mtime_ns for p in base.rglob("*.parquet")}
    assert len(list(base.iterdir())) == 1  # of the folder before the last; the last one's comes with the next load
    house.load_bronze("conditions", conditions(spark, [3, 4]), AS_OF)
    assert all(p.stat().st_mtime_ns == t for p, t in files.items()) and len(list(base.iterdir())) == 2
    for p in [*base.rglob("_SUCCESS")][:1]:  # as a write leaves it that broke off
        p.unlink()
        next(p.parent.glob("*.parquet")).unlink()
    assert house.load_bronze("conditions", conditions(spark, [1, 2, 3, 4, 5]), AS_OF) == 1
    assert patients(house) == ["p1", "p2", "p3", "p4", "p5"]
