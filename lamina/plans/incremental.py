"""Silver and the facts kept up to date batch by batch, without going through the history again.

Silver. The newest bronze row of each key lies in `current`, in buckets by key. A batch is reduced to the newest
row of each of its keys; only the buckets of these keys are read, merged and written, in `current` and in silver. Newest of
parts and then of what is left is newest of all, so late and equal-time versions need no special case. Every merge also
stores what it changed: silver rows that went (sign -1) and came (sign 1).

Claim fact. Payments and adjustments of a claim are sums and counts, which add up: a change of transactions adds the rows
that came and subtracts those that went, exactly, as they are decimals and whole numbers. A claim is dirty if it changed, if
its totals did, if an encounter of its patient's day did, or if a key it lacked has come. Only dirty claims are computed anew, by the
same code as a full build, and only their buckets are written.

Encounter fact. Its states are patient-days and condition counts; see `merge_fact_encounters`.

A step's results, the marks of what it took in, and the changes it found become visible together. A step that fails
is done again from the same state.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions.columns import exact_ratio, money
from lamina.operators.latest import first_per_key, packed_hash, packed_order, unpacked_hash
from lamina.operators.skew import will_broadcast
from lamina.operators.surrogate import stable_keys, stored_once
from lamina.plans import gold, silver
from lamina.sources.tables import Tables

# The changes that a fact needs to know of.
CLAIM_CHANGES = ("claims", "claims_transactions", "encounters")
ENCOUNTER_CHANGES = ("encounters", "conditions", "careplans")
FEW_BUCKETS = 16  # up to which each task may write a file for every bucket


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket")


def _dealt(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows as they go to their buckets' files: many buckets have a task each; few are written by the tasks that hold the rows,
    as one task would have to sort a large part of the table."""
    return rows if buckets <= FEW_BUCKETS else rows.repartition("bucket")


def _numbers(df: DataFrame) -> list[int]:
    """The buckets that occur: no more than there are."""
    return sorted(r["bucket"] for r in df.select("bucket").distinct().collect())


def _matching(rows: DataFrame, keys: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join by keys that may be NULL."""
    renamed = keys.select(*[F.col(n).alias(f"_{n}") for n in names])
    same = [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in names]
    return rows.join(renamed, same, how)


def merge_silver(tables: Tables, table: str, as_of: datetime, buckets: int) -> int:
    """Take the bronze folders in that silver hasn't seen. Returns the number of buckets written.

    Rows of other buckets stay as they are, their processing time included. Ages depend on the year, so a new
    year shapes all patients anew.
    """
    spark, keys = tables.spark, silver.SILVER[table].keys
    done = tables.noted(f"silver/{table}")
    fresh = [f for f in tables.folders("bronze", table) if _name(f) not in done]
    if not fresh:
        return 0
    with tables.together():
        tables.note(f"silver/{table}", [_name(f) for f in fresh])
        rows = silver.known(spark.read.parquet(*fresh), table)
        touched = _numbers(rows.select(bucket_of(keys, buckets)))
        if not touched:  # loads without rows that count
            if tables.find("silver", table) is None:
                tables.refresh("silver", table, silver.BUILDERS[table](rows, as_of))
            return 0
        current = tables.find("current", table, touched)
        shared = None if current is None else stored_once(_matching(current.select(*keys), rows, keys, "left_semi"))
        if shared is not None and not will_broadcast(shared):
            merged, gone, came = _all_ordered(current, rows, keys, buckets)
        else:
            batch = stored_once(silver.newest_stored(rows, table).select("*", bucket_of(keys, buckets)))
            merged, gone, came = _dealt(batch, buckets), None, batch
            if current is not None:
                merged, gone, came = _few_ordered(current, batch, shared, keys, buckets)
        tables.refresh_buckets("current", table, merged, touched)
        shape = touched
        if not tables.in_buckets("silver", table) or table == "patients":
            shape = range(buckets)
        held = tables.find("current", table, shape)
        shaped = silver.shaped(held.select("*", bucket_of(keys, buckets)), table, as_of, "bucket")
        tables.refresh_buckets("silver", table, shaped, shape)
        if table in CLAIM_CHANGES + ENCOUNTER_CHANGES:
            changed = silver.shaped(came.withColumn("sign", F.lit(1)), table, as_of, "sign")
            if gone is not None:
                changed = changed.unionByName(silver.shaped(gone.withColumn("sign", F.lit(-1)), table, as_of, "sign"))
            tables.append("changes", table, changed)
    return len(touched)


def _few_ordered(
    current: DataFrame, batch: DataFrame, shared: DataFrame, keys: Sequence[str], buckets: int,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Newest rows of buckets, and which went and came, where a batch shares few keys with them.

    Wide rows aren't shuffled for the shared keys, and most are passed through, stored ones where they are; only
    versions of the same record are ordered.
    """
    old = stored_once(_matching(current, shared, keys, "left_semi").withColumn("_new", F.lit(False)))
    both = old.unionByName(_matching(batch.drop("bucket"), shared, keys, "left_semi").withColumn("_new", F.lit(True)))
    packed = packed_hash(both)
    order = [*packed_order(packed.drop("_new"), keys), F.asc("_new")]
    won = stored_once(unpacked_hash(first_per_key(packed, keys, order)).select(*both.columns, bucket_of(keys, buckets)))
    newer = won.where("_new").drop("_new")
    gone = _matching(old.drop("_new"), newer, keys, "left_semi")
    added = _matching(batch, shared, keys, "left_anti")
    kept = _matching(current, shared, keys, "left_anti").select("*", bucket_of(keys, buckets))
    return kept.unionByName(_dealt(won.drop("_new").unionByName(added), buckets)), gone, newer.unionByName(added)


def _all_ordered(
    current: DataFrame, rows: DataFrame, keys: Sequence[str], buckets: int,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The same where they share many: stored and new rows meet in one shuffle.

    A stored row that isn't the first of its key has lost to a new one, as stored rows have no key twice.
    """
    both = current.withColumn("_new", F.lit(False)).unionByName(rows.withColumn("_new", F.lit(True)))
    packed = packed_hash(both)
    order = [*packed_order(packed.drop("_new"), keys), F.asc("_new")]
    ranked = packed.withColumn("_first", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) == 1)
    ordered = stored_once(unpacked_hash(ranked.where("_first or not _new")).select(*both.columns, "_first", bucket_of(keys, buckets)))
    first = ordered.where("_first").drop("_first")
    return (_dealt(first.drop("_new"), buckets), ordered.where("not _first").select(*current.columns),
            first.where("_new").drop("_new"))


def _name(folder: str) -> str:
    return folder.rstrip("/").rsplit("/", 1)[1]


# --- claim totals as states that add up --------------------------------------


def transaction_states(changed: DataFrame) -> DataFrame:
    """Sums and counts of each claim, over rows with a sign."""
    days = F.when(F.col("transaction_type") == "PAYMENT", F.col("days_to_payment")).cast("bigint")
    rows = changed.where("claim_id is not null").select(
        "claim_id", F.col("sign").cast("bigint").alias("n_rows"),
        *[column for name, value in (("payments", F.col("payments")), ("adjustments", F.col("adjustments")), ("days", days))
          for column in ((value * F.col("sign")).alias(name), F.when(value.isNotNull(), F.col("sign").cast("bigint")).alias(f"n_{name}"))])
    return _added(rows)


def _added(states: DataFrame) -> DataFrame:
    def sum_of(name: str, kind: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).cast(kind).alias(name)

    return states.groupBy("claim_id").agg(
        sum_of("n_rows", "bigint"), sum_of("payments", "decimal(38,2)"), sum_of("n_payments", "bigint"),
        sum_of("adjustments", "decimal(38,2)"), sum_of("n_adjustments", "bigint"), sum_of("days", "bigint"), sum_of("n_days", "bigint"))


def totals_of(states: DataFrame) -> DataFrame:
    """The columns of `gold.transaction_totals`."""
    return states.where("n_rows > 0").select(
        "claim_id",
        money(F.when(F.col("n_payments") > 0, F.col("payments"))).alias("total_payments"),
        money(F.when(F.col("n_adjustments") > 0, F.col("adjustments"))).alias("total_adjustments"),
        exact_ratio(F.when(F.col("n_days") > 0, F.col("days")), F.col("n_days"), 2).cast("decimal(10,2)").alias("avg_days_to_payment"))


# --- the claim fact ----------------------------------------------------------


def merge_fact_claims(tables: Tables, buckets: int) -> int:
    """Bring the claim fact up to the changes it hasn't taken in. Returns the number of claims computed.

    The first time all claims are computed. A claim keeps its key; new claims get new ones.
    """
    spark = tables.spark
    fresh = _unseen(tables, "fact_claims", CLAIM_CHANGES)
    dims = [tables.read("gold", name) for name in ("dim_patients", "dim_payers")]
    claims, encounters = tables.read("silver", "claims"), tables.read("silver", "encounters")
    fact = tables.find("gold", "fact_claims") if tables.in_buckets("gold", "fact_claims") else None
    with tables.together():
        for table, folders in fresh.items():
            tables.note(f"fact_claims/{table}", [_name(f) for f in folders])

        def changed(table: str) -> DataFrame:
            return spark.read.parquet(*fresh[table])

        deltas = None
        if fresh["claims_transactions"]:
            deltas = stored_once(transaction_states(changed("claims_transactions")).select("*", bucket_of(["claim_id"], buckets)))
            touched = _numbers(deltas)
            before = tables.find("state", "claim_totals", touched)
            states = deltas.drop("bucket") if before is None else _added(before.unionByName(deltas.drop("bucket")))
            tables.refresh_buckets("state", "claim_totals", _dealt(states.select("*", bucket_of(["claim_id"], buckets)), buckets), touched)
        states = tables.find("state", "claim_totals")
        totals = gold.transaction_totals(tables.read("silver", "claims_transactions")) if states is None else totals_of(states)
        if fact is None:
            dirty = None
        else:
            ids = [_resolved(fact, "claim_id", claims, dim, entity) for dim, entity in zip(dims, ("patient", "payer"), strict=True)]
            if fresh["claims"]:
                ids.append(changed("claims").select(F.col("id").alias("claim_id")))
            if deltas is not None:
                ids.append(deltas.select("claim_id"))
            if fresh["encounters"]:
                days = changed("encounters").select("patient_id", F.col("start_ts").cast("date").alias("day")).distinct()
                ids.append(claims.select(F.col("id").alias("claim_id"), "patient_id", F.col("service_date").cast("date").alias("day"))
                           .join(days, ["patient_id", "day"], "left_semi").select("claim_id"))
            dirty = stored_once(_union(ids).distinct().select("*", bucket_of(["claim_id"], buckets)))
            claims = claims.join(dirty, claims["id"] == dirty["claim_id"], "left_semi")
            totals = totals.join(dirty, "claim_id", "left_semi")
            wanted = claims.select("patient_id", F.col("service_date").cast("date").alias("_day")).distinct()
            encounters = encounters.withColumn("_day", F.col("start_ts").cast("date")).join(wanted, ["patient_id", "_day"], "left_semi").drop("_day")
        keyed = _keyed(tables, "fact_claims", claims.where("service_date is not null").select(F.col("id").alias("claim_id")), "claim_key")
        rows = gold.fact_claims_of(claims, totals, encounters, *dims, keys=keyed)
        return _stored(tables, "fact_claims", "claim_id", rows, dirty, buckets)


def _unseen(tables: Tables, fact: str, names: Sequence[str]) -> dict[str, list[str]]:
    """Folders of changes that a fact hasn't taken in."""
    return {t: [f for f in tables.folders("changes", t) if _name(f) not in tables.noted(f"{fact}/{t}")] for t in names}


def _keyed(tables: Tables, fact: str, ids: DataFrame, key: str) -> DataFrame:
    """Ids with their keys; new ones are registered."""
    known = tables.find("keys", fact)
    keyed = stored_once(stable_keys(ids, ids.columns[0], key, known=known))
    tables.append("keys", fact, (keyed if known is None else keyed.join(known, ids.columns[0], "left_anti")).select(*ids.columns, key))
    return keyed


def _stored(tables: Tables, fact: str, name: str, rows: DataFrame, dirty: DataFrame | None, buckets: int) -> int:
    """Put the rows of dirty ids (None: of all) in the place of what a fact has of them."""
    rows = rows.select("*", bucket_of([name], buckets))
    if dirty is None:
        return tables.refresh_buckets("gold", fact, _dealt(rows, buckets), range(buckets))
    touched = _numbers(dirty)
    if not touched:
        return 0
    held = tables.find("gold", fact, touched)
    rows = stored_once(rows)
    if held is not None:
        others = held.join(dirty, name, "left_anti").select(*held.columns, bucket_of([name], buckets))
        rows = others.unionByName(_dealt(rows, buckets))
    tables.refresh_buckets("gold", fact, rows, touched)
    return dirty.count()


def _resolved(fact: DataFrame, name: str, records: DataFrame, dim: DataFrame, entity: str) -> DataFrame:
    """Ids of facts that lacked a key which the dimension has by now."""
    lacking = fact.where(F.col(f"{entity}_key").isNull()).select(name)
    return (records.select(F.col("id").alias(name), f"{entity}_id").where(f"{entity}_id is not null")
            .join(lacking, name, "left_semi").join(dim, f"{entity}_id", "left_semi").select(name))


# --- the encounter fact ------------------------------------------------------


def merge_fact_encounters(tables: Tables, buckets: int) -> int:
    """Bring the encounter fact up to the changes it hasn't taken in. Returns the number of encounters computed.

    Readmission looks at the patient's previous day. So a day that changed concerns its own encounters and those of
    the next day the patient has, however far back it lies; patient-days are kept, and only changed ones are reduced
    anew. Condition counts add up. A changed care plan concerns the encounters of its patient.
    """
    spark, fresh = tables.spark, _unseen(tables, "fact_encounters", ENCOUNTER_CHANGES)
    dims = [tables.read("gold", name) for name in ("dim_patients", "dim_payers")]
    encounters, careplans = tables.read("silver", "encounters"), tables.read("silver", "careplans")
    fact = tables.find("gold", "fact_encounters") if tables.in_buckets("gold", "fact_encounters") else None
    with tables.together():
        for table, folders in fresh.items():
            tables.note(f"fact_encounters/{table}", [_name(f) for f in folders])

        def changed(table: str) -> DataFrame:
            return spark.read.parquet(*fresh[table])

        counted = _counts_merged(tables, changed("conditions"), buckets) if fresh["conditions"] else None
        moved = _days_merged(tables, changed("encounters"), encounters, buckets) if fresh["encounters"] else None
        counts, days = tables.find("state", "condition_counts"), tables.find("state", "patient_days")
        if counts is None:
            counts = gold.condition_counts(tables.read("silver", "conditions"))
        if days is None:
            days = gold.patient_days(encounters)
        if fact is None:
            dirty = None
        else:
            own = encounters.select(F.col("id").alias("encounter_id"), "patient_id", F.col("start_ts").cast("date").alias("day"))
            ids = [_resolved(fact, "encounter_id", encounters, dim, entity) for dim, entity in zip(dims, ("patient", "payer"), strict=True)]
            if counted is not None:
                ids.append(counted.select("encounter_id"))
            if moved is not None:
                ids.append(changed("encounters").select(F.col("id").alias("encounter_id")))
                ids.append(_matching(own, _concerned(days, moved), ["patient_id", "day"], "left_semi").select("encounter_id"))
            if fresh["careplans"]:
                ids.append(own.join(changed("careplans").select("patient_id").distinct(), "patient_id", "left_semi").select("encounter_id"))
            dirty = stored_once(_union(ids).distinct().select("*", bucket_of(["encounter_id"], buckets)))
            encounters = stored_once(encounters.join(dirty, encounters["id"] == dirty["encounter_id"], "left_semi"))
            patients = encounters.select("patient_id").distinct()
            counts = counts.join(dirty, "encounter_id", "left_semi")
            days = _matching(days, patients, ["patient_id"], "left_semi")
            careplans = careplans.join(patients, "patient_id", "left_semi")
        keyed = _keyed(tables, "fact_encounters", encounters.where("start_ts is not null").select(F.col("id").alias("encounter_id")), "encounter_key")
        rows = gold.fact_encounters_of(encounters, counts, gold.fresh_of_days(days), careplans, *dims, keys=keyed)
        return _stored(tables, "fact_encounters", "encounter_id", rows, dirty, buckets)


def _counts_merged(tables: Tables, changed: DataFrame, buckets: int) -> DataFrame:
    """Conditions of each encounter, kept as counts; returns what was added to whose."""
    def summed(rows: DataFrame, column: str) -> DataFrame:
        return rows.groupBy("encounter_id").agg(F.sum(column).cast("bigint").alias("condition_count"))

    deltas = summed(changed.where("encounter_id is not null"), "sign")
    deltas = stored_once(deltas.select("*", bucket_of(["encounter_id"], buckets)))
    touched = _numbers(deltas)
    held = tables.find("state", "condition_counts", touched)
    counts = deltas.drop("bucket")
    if held is not None:
        counts = summed(held.unionByName(counts), "condition_count")
    counts = counts.where("condition_count > 0").select("*", bucket_of(["encounter_id"], buckets))
    tables.refresh_buckets("state", "condition_counts", _dealt(counts, buckets), touched)
    return deltas


def _days_merged(tables: Tables, changed: DataFrame, encounters: DataFrame, buckets: int) -> DataFrame:
    """Patient-days, of which those that changed are reduced anew from their encounters; returns these, gone ones, too."""
    names = ["patient_id", "day"]
    moved = changed.where("start_ts is not null").select("patient_id", F.col("start_ts").cast("date").alias("day")).distinct()
    moved = stored_once(moved.select("*", bucket_of(["patient_id"], buckets)))
    touched = _numbers(moved)
    on_them = _matching(encounters.withColumn("day", F.col("start_ts").cast("date")), moved, names, "left_semi")
    days = _dealt(gold.patient_days(on_them).select("*", bucket_of(["patient_id"], buckets)), buckets)
    held = tables.find("state", "patient_days", touched)
    if held is not None:
        days = _matching(held, moved, names, "left_anti").select("*", bucket_of(["patient_id"], buckets)).unionByName(days)
    tables.refresh_buckets("state", "patient_days", days, touched)
    return moved


def _concerned(days: DataFrame, moved: DataFrame) -> DataFrame:
    """The days that moved, and the next day that each of their patients has after one."""
    own = _matching(days, moved.select("patient_id").distinct(), ["patient_id"], "left_semi")
    marked = own.select("patient_id", "day", F.lit(False).alias("moved")).unionByName(
        moved.select("patient_id", "day", F.lit(True).alias("moved"))).groupBy("patient_id", "day").agg(F.max("moved").alias("moved"))
    before = F.lag("moved").over(Window.partitionBy("patient_id").orderBy("day"))
    return marked.withColumn("after", F.coalesce(before, F.lit(False))).where("moved or after").select("patient_id", "day")


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    first, *others = frames
    for other in others:
        first = first.unionAll(other)
    return first
