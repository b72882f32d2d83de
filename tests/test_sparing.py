"""What a warehouse leaves on the disk and sends through the driver."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from harness.adapters import source
from lamina.operators.skew import will_broadcast
from lamina.operators.surrogate import dense_keys, ensure_checkpoint_dir, step, stored_once
from lamina.plans import incremental
from lamina.plans.warehouse import Warehouse
from lamina.schemas import BRONZE
from lamina.sources import hashed
from lamina.sources.tables import Tables

AS_OF = datetime(2024, 6, 30)


def local(spark):
    ensure_checkpoint_dir(spark)
    return Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))


def left(spark):
    return {p for p in local(spark).iterdir() if p.name.startswith(("stored-", "rdd-"))}


def shuffles(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {p for f in folders for p in Path(f).rglob("shuffle_*.data")}


@pytest.mark.parametrize("by_merges", [False, True])
def test_a_build_leaves_its_tables_alone(spark, tmp_path, by_merges):
    house, before, files = Warehouse(Tables(spark, str(tmp_path / "house"), lambda line: None)), left(spark), shuffles(spark)
    raws = {t: source(spark, "/root/testdata/sf0.001", t) for t in BRONZE}
    for day in range(2):
        house.build(raws, AS_OF + timedelta(days=day), f"run-{day}", by_merges=by_merges)
    assert left(spark) == before and not shuffles(spark) - files
    assert house.tables.read("gold", "fact_claims").count() == house.tables.read("silver", "claims").where("service_date is not null").count()


def test_a_failed_step_leaves_nothing_and_frames_outside_stay(spark):
    outside, before = stored_once(spark.range(3)), left(spark)
    with pytest.raises(ValueError), step(spark):
        with step(spark):
            stored_once(spark.range(4))
        assert left(spark) == before
        dense_keys(spark.range(4), "id", "key")
        raise ValueError
    assert left(spark) == before and outside.count() == 3


def test_a_frame_counts_twice_after_its_shuffles_went(spark, tmp_path):
    Tables(spark, str(tmp_path / "house"))
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert sorted(df.collect()) == sorted(df.collect()) and df.count() == 7


def test_a_packed_table_is_no_small_one(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "house"), lambda line: None)
    tables.refresh("gold", "dim_patients", spark.range(2_000_000).select("id", F.col("id").alias("patient_key")))
    assert not will_broadcast(tables.read("gold", "dim_patients"))
    tables.refresh("gold", "dim_payers", spark.range(2_000).select("id", F.col("id").alias("payer_key")))
    assert will_broadcast(tables.read("gold", "dim_payers"))


def test_few_buckets_are_no_tasks(spark):
    def plan(buckets):
        rows = spark.range(9).select("id", incremental.bucket_of(["id"], buckets))
        return incremental._dealt(rows, buckets)._jdf.queryExecution().executedPlan().toString()

    assert "Exchange" not in plan(4) and "Exchange" in plan(incremental.FEW_BUCKETS + 1)


def test_hashes_have_more_buckets_as_a_table_grows(spark, tmp_path, monkeypatch):
    house = Warehouse(Tables(spark, str(tmp_path / "house"), lambda line: None), hash_buckets=2)
    raw = source(spark, "/root/testdata/sf0.001", "claims")
    monkeypatch.setattr(hashed, "BUCKET_BYTES", 5_000)
    assert house.load_bronze("claims", raw.where("id % 2 = 0"), AS_OF) == raw.where("id % 2 = 0").count()
    assert house.load_bronze("claims", raw, AS_OF) == raw.where("id % 2 <> 0").count()
    assert house.load_bronze("claims", raw.union(raw), AS_OF) == 0
    folders = house.tables.folders("bronze", "claims")
    size = sum(hashed.folder_bytes(spark, f) for f in folders)
    number = hashed.HashHistory(house.tables, 2).number(folders)
    assert number > 2 and number // 2 * 5_000 < size <= number * 5_000
