"""Queries that run the stored warehouse end to end, in a folder of the shared store."""

from __future__ import annotations

import re
import uuid
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harness.adapters import source
from lamina.operators.surrogate import ensure_checkpoint_dir
from lamina.plans import answers, bronze, checks, silver
from lamina.plans.warehouse import LOG, Warehouse, run_label
from lamina.schemas import BRONZE, RAW_LAYOUTS, raw_schema
from lamina.sources.tables import Tables


def _empty_house(flow, report=lambda line: None) -> Warehouse:
    ensure_checkpoint_dir(flow.spark)
    root = f"{flow.spark.sparkContext.getCheckpointDir()}/house-{uuid.uuid4().hex}"
    return Warehouse(Tables(flow.spark, root, report), hash_buckets=8, key_buckets=4)


def _new_house(flow, report=lambda line: None) -> Warehouse:
    house = _empty_house(flow, report)
    # Transactions say themselves when they arrived, so their versions have an order.
    table = "claims_transactions"
    house.tables.append("bronze", table, bronze.increment(
        source(flow.spark, flow.sf_dir, table), None, table, F.col("fromdate")))
    return house


def _store_raw(flow, house: Warehouse) -> None:
    """The raw layer as a CSV load would store it: all columns of the layout, those that the source lacks NULL."""
    for table in BRONZE:
        raw = source(flow.spark, flow.sf_dir, table)
        house.tables.refresh("raw", table, raw.select(*[
            (F.col(f.name) if f.name in raw.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in raw_schema(table).fields]))


def _raw_house(flow) -> Warehouse:
    """A warehouse with its raw layer, for the reports that read no other."""
    house = _empty_house(flow)
    _store_raw(flow, house)
    return house


def _house(flow, as_of) -> Warehouse:
    """A warehouse with everything stored: raw, all layers built, and built again a day later.

    Each query has its own. One kept for a session would make a query's work depend on whether another ran before it.
    """
    house = _new_house(flow)
    _store_raw(flow, house)
    raws = {t: source(flow.spark, flow.sf_dir, t) for t in BRONZE}
    house.build(raws, as_of, "run-1")
    house.build(raws, as_of, "run-2")
    return house


def revenue_cycle(flow, as_of) -> DataFrame:
    return _house(flow, as_of).revenue_cycle()


def readmission(flow, as_of) -> DataFrame:
    return _house(flow, as_of).readmission()


def second_load(flow, as_of) -> DataFrame:
    """Bronze rows after two loads of the same source, and how many rows a third one adds."""
    house, rows = _house(flow, as_of), []
    for table in BRONZE:
        raw = source(flow.spark, flow.sf_dir, table)
        stored = house.tables.read("bronze", table).count()
        rows.append((table, stored, house.load_bronze(table, raw, as_of + timedelta(days=1))))
    return flow.spark.createDataFrame(rows, "table_name string, stored_rows long, added_rows long")


def log_of_two_runs(flow, as_of) -> DataFrame:
    log = _house(flow, as_of).tables.read("metadata", LOG)
    return log.groupBy("run_id").agg(F.count("*").alias("checks"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


def raw_populated(flow, as_of) -> DataFrame:
    house = _raw_house(flow)
    return checks.populated({
        t: house.tables.read_or_empty("raw", t, raw_schema(t)) for t in RAW_LAYOUTS})


def keys_after_new_payer(flow, as_of) -> DataFrame:
    """Answers by payer after a payer that sorts first came and only its dimension was loaded."""
    house = _new_house(flow)
    raw = {t: source(flow.spark, flow.sf_dir, t) for t in BRONZE}
    house.build(raw, as_of, "run-1")
    later = as_of + timedelta(days=1)
    others = [c for c in raw["payers"].columns if c != "id"]
    house.load_bronze("payers", raw["payers"].limit(1).select(F.lit(-5).cast("bigint").alias("id"), *others), later)
    house.load_silver("payers", later, "run-2")
    house.load_gold("dim_payers", later)
    return house.revenue_cycle()


def refresh_twice(flow, as_of) -> DataFrame:
    """Silver encounters refreshed, refreshed again by a plan that fails, and refreshed once more."""
    house = _new_house(flow)
    house.load_bronze("encounters", source(flow.spark, flow.sf_dir, "encounters"), as_of)
    house.refresh_silver("encounters", as_of)
    built = silver.BUILDERS["encounters"](house.tables.read("bronze", "encounters"), as_of)
    try:
        house.tables.refresh("silver", "encounters", built.where("cast(raise_error('broken') as boolean)"))
    except Exception as error:  # whatever a failing job raises: the table must be as it was
        if "broken" not in str(error):
            raise
    if house.tables.read("silver", "encounters").isEmpty() and not built.isEmpty():
        raise AssertionError("a failed refresh lost the table")
    house.refresh_silver("encounters", as_of)
    return house.tables.read("silver", "encounters")


# --- batch by batch ---


def _claims(flow):
    """Claims as they are, and as they were while all were open."""
    raw = source(flow.spark, flow.sf_dir, "claims")
    return raw, raw.withColumn("status1", F.lit("OPEN"))


def three_loads(flow, as_of) -> DataFrame:
    """Bronze claims after three loads that overlap; hashes stored before are found in their buckets."""
    house, (raw, opened), day = _empty_house(flow), _claims(flow), timedelta(days=1)
    for load, at in ((opened.where("id % 3 <> 0"), as_of - day), (raw, as_of), (opened, as_of + day)):
        house.load_bronze("claims", load, at)
    return house.tables.read("bronze", "claims")


def silver_merge(flow, as_of) -> DataFrame:
    """Silver claims merged after each of four batches: first rows, all rows, late versions, versions of equal time."""
    house, (raw, opened), day = _empty_house(flow), _claims(flow), timedelta(days=1)
    for load, at in (
        (opened.where("id % 3 <> 0"), as_of - day), (raw, as_of),
        (raw.where("id % 2 = 0").withColumn("status2", F.lit("LATE")), as_of - day),
        (raw.where("id % 5 = 0").withColumn("status2", F.lit("SAME")), as_of),
    ):
        house.load_bronze("claims", load, at)
        house.merge_silver("claims", as_of)
    return house.tables.read("silver", "claims")


def _merged_house(flow, as_of) -> Warehouse:
    """A warehouse whose facts took in two batches, the second by computing what it concerns."""
    house = _empty_house(flow)
    for part in (F.pmod("number", F.lit(3)) == 0, F.pmod("number", F.lit(3)) != 0):
        for table in BRONZE:
            raw = source(flow.spark, flow.sf_dir, table)
            if table not in ("patients", "payers"):  # whole at once, so that keys are those of a full build
                raw = raw.withColumn("number", F.xxhash64(*raw.columns)).where(part).drop("number")
            if table == "claims_transactions":  # they say themselves when they arrived
                house.tables.append("bronze", table, bronze.stage(raw, table, F.col("fromdate")))
            else:
                house.load_bronze(table, raw, as_of)
            house.merge_silver(table, as_of)
        for dim in ("dim_patients", "dim_payers"):
            house.load_gold(dim, as_of)
        house.merge_fact_claims()
        house.merge_fact_encounters()
    return house


def fact_claims_merged(flow, as_of) -> DataFrame:
    return _merged_house(flow, as_of).tables.read("gold", "fact_claims").drop("claim_key")


def fact_encounters_merged(flow, as_of) -> DataFrame:
    return _merged_house(flow, as_of).tables.read("gold", "fact_encounters").drop("encounter_key")


def keys_after_a_gap(flow, as_of) -> DataFrame:
    """Payer keys after a load without every third payer and one with them and a new one, that sorts first."""
    house, day = _empty_house(flow), timedelta(days=1)
    raw = source(flow.spark, flow.sf_dir, "payers")
    new = raw.orderBy("id").limit(1).withColumn("id", F.lit(-5).cast("bigint"))
    for load in (raw, raw.where("id % 3 <> 0"), raw.unionByName(new)):
        staged = bronze.stage(load, "payers", as_of)
        house.tables.refresh("silver", "payers", silver.payers(staged, as_of + day))
        house.load_gold("dim_payers", as_of)
    return house.tables.read("gold", "dim_payers").select("payer_id", "payer_key")


# --- loads, reports, order ---


def folder_load(flow, as_of) -> DataFrame:
    """A folder of CSV files loaded twice: rows of each load, and rows stored."""
    house = _empty_house(flow)
    folder = f"{house.tables.root}-csv"
    for table in BRONZE:
        raw = source(flow.spark, flow.sf_dir, table)
        written = raw.withColumns({c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'") for c, k in raw.dtypes if k.startswith("timestamp")})
        written.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False).csv(f"{folder}/{table}.csv")
    first, again = house.load_csv_folder(folder), house.load_csv_folder(folder)
    rows = [(t, first.get(t, 0), again.get(t, 0), house.tables.is_loaded("raw", t),
             house.tables.read_or_empty("raw", t, raw_schema(t)).count()) for t in RAW_LAYOUTS]
    return flow.spark.createDataFrame(rows, "table_name string, loaded long, loaded_again long, is_loaded boolean, stored long")


def run_summary(flow, as_of) -> DataFrame:
    """What a run reports of its checks, and whether its log rows carry one well-formed run id."""
    lines: list[str] = []
    house, run = _new_house(flow, lines.append), run_label("silver", as_of)
    for table in BRONZE:
        if table != "claims_transactions":
            house.load_bronze(table, source(flow.spark, flow.sf_dir, table), as_of)
        house.load_silver(table, as_of, run)
    ids = [r["run_id"] for r in house.tables.read("metadata", LOG).select("run_id").distinct().collect()]
    good = ids == [run] and re.fullmatch(r"silver/\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ/[0-9a-f-]{36}", run) is not None
    said = [m.groups() for m in (re.fullmatch(r"  checks \[(\w+)\]: (\d+)/(\d+) passed", x) for x in lines) if m]
    return flow.spark.createDataFrame([(t, int(a), int(b), good) for t, a, b in said],
                                      "table_name string, passed long, checks long, one_run boolean")


def answers_in_order(flow, as_of) -> DataFrame:
    """Place of each answer's row in the order it is given in; rows that are equal in what they are ordered by share one."""
    def placed(name: str, df: DataFrame, item: list[str], by: str) -> DataFrame:
        rows = df.withColumn("_at", F.monotonically_increasing_id())  # reports: a row for each payer and class at most
        rows = rows.withColumn("_place", F.row_number().over(Window.orderBy("_at")))
        return rows.select(F.lit(name).alias("answer"), F.concat_ws("|", *item).alias("item"),
                           F.min("_place").over(Window.partitionBy(by)).cast("bigint").alias("place"))

    house, log = _house(flow, as_of), flow.log()
    return reduce(DataFrame.unionByName, [
        placed("revenue_cycle", house.revenue_cycle(), ["payer", "ownership", "encounter_class"], "total_outstanding"),
        placed("payer_settlement", house.payer_settlement(), ["ownership"], "avg_days"),
        placed("failed_checks", answers.failed_checks(log).withColumn("_one", F.lit(1)), ["table_name", "column_name", "metric_type"], "_one"),
        placed("check_trend", answers.check_trend(log), ["table_name", "status"], "table_name"),
    ])


def raw_duplicates(flow, as_of) -> DataFrame:
    return _raw_house(flow).raw_duplicates()


def raw_orphans(flow, as_of) -> DataFrame:
    return _raw_house(flow).raw_orphans()


def gold_meaning(flow, as_of) -> DataFrame:
    """Keys of the stored facts against the natural keys of their records."""
    return _house(flow, as_of).verify("gold").where("check like '% means %'")
