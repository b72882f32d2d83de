"""Append only rows whose hash the target does not hold yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_rows(staged: DataFrame, existing: DataFrame, dedup_within_batch: bool = False) -> DataFrame:
    """Rows of `staged` whose `_row_hash` is not in `existing`.

    Copies inside the batch are all kept unless `dedup_within_batch` is set:
    the test looks only at the target as it was before the load.

    One lazy plan for all sizes. Hashes meet as 16 bytes, not as 32 characters, and
    the history's need not be made distinct first: they nearly are, and an
    anti join asks only whether one is there. Spark broadcasts them where they are
    few, and splits the partition of a hash that many staged copies share.
    """
    return without(staged, existing.select(F.unhex("_row_hash").alias("hash")), dedup_within_batch)


def without(staged: DataFrame, known: DataFrame, dedup_within_batch: bool = False) -> DataFrame:
    """Rows of `staged` whose `_row_hash` is not among the 16-byte hashes `known`."""
    return _by_hash(staged, known, "left_anti", dedup_within_batch)


def those(staged: DataFrame, unknown: DataFrame, dedup_within_batch: bool = False) -> DataFrame:
    """Rows of `staged` whose `_row_hash` is among the 16-byte hashes `unknown`."""
    return _by_hash(staged, unknown, "left_semi", dedup_within_batch)


def _by_hash(staged: DataFrame, hashes: DataFrame, how: str, dedup_within_batch: bool) -> DataFrame:
    columns = staged.columns
    rows = staged.join(hashes, F.unhex(staged["_row_hash"]) == hashes["hash"], how)
    if dedup_within_batch:
        rows = rows.dropDuplicates(["_row_hash"])
    return rows.select(*columns)
