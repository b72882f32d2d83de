"""First row per key, in a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.schemas import LINEAGE


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key.

    Spark limits each group to one row per map task before the shuffle
    (WindowGroupLimit), so a key holding a third of all rows costs the reducer
    one row per map task. NULL keys form a group of their own.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def latest_version(bronze: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Newest version of each record by ingestion time.

    Rows of one batch share their ingestion time. The row hash decides between
    them; the remaining columns only matter for rows whose hashes collide
    because NULLs are skipped, and make the order total.
    """
    return first_per_key(bronze, keys, version_order(bronze, keys))


def packed_hash(rows: DataFrame) -> DataFrame:
    """Row hashes as 16 bytes in `_packed_hash`, which sort as their 32 characters do; other texts stay in `_row_hash`.

    For rows that are to be shuffled: hashes don't compress, so half their characters are half their volume.
    """
    packed = F.unhex("_row_hash")
    exact = F.coalesce((F.length("_row_hash") == 32) & (F.lower(F.hex(packed)) == F.col("_row_hash")), F.lit(False))
    return rows.withColumns({"_packed_hash": F.when(exact, packed), "_row_hash": F.when(~exact, F.col("_row_hash"))})


def unpacked_hash(rows: DataFrame) -> DataFrame:
    """Row hashes as text again."""
    text = F.coalesce(F.lower(F.hex("_packed_hash")), "_row_hash")
    return rows.withColumn("_row_hash", text).drop("_packed_hash")


def packed_order(packed: DataFrame, keys: Sequence[str]) -> list[Column]:
    """`version_order` of rows with packed hashes."""
    when, by_hash, *rest = version_order(packed.drop("_packed_hash"), keys)
    return [when, F.asc_nulls_last("_packed_hash"), by_hash, *rest]


def version_order(bronze: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Newest first, a total order of the versions of a record."""
    rest = [c for c in bronze.columns if c not in LINEAGE and c not in keys]
    return [F.desc_nulls_last("_ingested_at"), F.asc("_row_hash"), *[F.asc_nulls_last(c) for c in rest]]
