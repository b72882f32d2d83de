"""Newest version of each record of a stored table, moving only records that have several."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.operators.latest import first_per_key, packed_hash, packed_order, unpacked_hash
from lamina.operators.skew import fits_broadcast
from lamina.operators.surrogate import stored_once

FEW = 0.05  # share of rows up to which surplus versions are worth looking for


def newest_of_stored(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What `latest_version` returns, where most records have one version without a shuffle of wide rows.

    One scan of the key columns estimates how many rows are surplus. If these are few, the keys' hashes are counted
    by a shuffle of 8 bytes a row, and those that occur twice are written, so Spark knows how few they are: while
    they fit a broadcast, only their rows are ordered, and all others pass through. Two keys of one hash are both
    ordered, each by its own key, so the result is exact. Else all rows are ordered.
    """
    marked = rows.withColumn("_key", F.xxhash64(*keys))
    seen = marked.agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct("_key", 0.01).alias("keys")).first()
    if seen["rows"] - seen["keys"] > FEW * seen["rows"]:
        return _ordered(rows, keys)
    several = stored_once(marked.groupBy("_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_key"))
    if several.isEmpty():
        return rows
    if not fits_broadcast(several):
        return _ordered(rows, keys)
    several = F.broadcast(several)
    versions = _ordered(marked.join(several, "_key", "left_semi").select(*rows.columns), keys)
    return marked.join(several, "_key", "left_anti").select(*rows.columns).unionByName(versions)


def _ordered(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    packed = packed_hash(rows)
    return unpacked_hash(first_per_key(packed, keys, packed_order(packed, keys))).select(*rows.columns)
