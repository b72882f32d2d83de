"""Bronze: chosen raw columns plus lineage, appended by row hash."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions.columns import moment, row_hash
from lamina.operators.append import new_rows, those, without
from lamina.operators.skew import fits_broadcast
from lamina.operators.surrogate import stored_once
from lamina.schemas import BRONZE
from lamina.sources.hashed import HashHistory


def stage(raw: DataFrame, table: str, ingested_at: datetime | Column) -> DataFrame:
    """The rows a load would offer to bronze.

    `ingested_at` is one moment for the whole load, or a column when the raw
    data says itself when each row arrived.
    """
    spec = BRONZE[table]
    when = moment(ingested_at) if isinstance(ingested_at, datetime) else ingested_at
    return raw.select(
        *spec.columns,
        when.alias("_ingested_at"),
        F.lit(spec.source_file).alias("_source_file"),
        row_hash(spec.columns).alias("_row_hash"),
    )


def increment(
    raw: DataFrame, existing: DataFrame | None, table: str, ingested_at: datetime | Column,
    dedup_within_batch: bool = False,
) -> DataFrame:
    """Rows to append to a bronze table that already holds `existing` (None: nothing yet)."""
    staged = stage(raw, table, ingested_at)
    if existing is None:
        return staged.dropDuplicates(["_row_hash"]) if dedup_within_batch else staged
    return new_rows(staged, existing, dedup_within_batch)


def increment_by_history(
    raw: DataFrame, history: HashHistory, table: str, ingested_at: datetime | Column,
    dedup_within_batch: bool = False,
) -> DataFrame:
    """The same against stored bronze, whose hashes lie in buckets and don't move.

    The batch's distinct hashes go to the buckets first. Those not found there are written, so Spark knows how
    few they are: while they, or else those found, fit a broadcast, the wide rows of the batch aren't shuffled either.
    So a load that repeats what is stored moves no row, nor does one that brings little but new rows.
    """
    staged = stage(raw, table, ingested_at)
    hashes = staged.select(F.unhex("_row_hash").alias("hash"))
    unknown = history.unknown(hashes, "bronze", table)
    if unknown is None:
        return staged.dropDuplicates(["_row_hash"]) if dedup_within_batch else staged
    unknown = stored_once(unknown)
    if fits_broadcast(unknown):
        return those(staged, F.broadcast(unknown), dedup_within_batch)
    known = stored_once(history.known(hashes, "bronze", table))
    if fits_broadcast(known):
        return without(staged, F.broadcast(known), dedup_within_batch)
    return those(staged, unknown, dedup_within_batch)
