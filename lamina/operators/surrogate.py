"""Dense surrogate keys 1..n in natural-key order, without a global sort."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamina.operators.latest import first_per_key

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row index below
_passing = threading.local()  # folders that a step of this thread has stored for itself


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named in spark.checkpoint.dir.

    Only a local session without one gets a folder of its own; a cluster
    without one is an error, since a machine-local folder would not survive.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not context.getCheckpointDir():
            context.setCheckpointDir(named)
        return
    if context.getCheckpointDir():
        return
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="lamina-checkpoint-"))


@contextmanager
def step(spark: SparkSession) -> Iterator[None]:
    """A step that writes all it computes: what `stored_once` stores for it in this thread goes when it ends."""
    outer, _passing.folders = getattr(_passing, "folders", None), []
    try:
        yield
    finally:
        folders, _passing.folders = _passing.folders, outer
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored_once(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read from then on: one evaluation, of known size."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/stored-{uuid.uuid4().hex}"
    if getattr(_passing, "folders", None) is not None:
        _passing.folders.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stable_keys(
    df: DataFrame, natural_key: str, key_name: str, first_by: Sequence[Column] | None = None,
    known: DataFrame | None = None,
) -> DataFrame:
    """As `dense_keys`, but natural keys of `known` keep the keys they have there.

    Only new natural keys are numbered, from the largest known key on. So rows that were stored
    with a key keep meeting the row it stood for when others come or go.
    """
    if known is None:
        return dense_keys(df, natural_key, key_name, first_by)
    if first_by is not None:
        df = first_per_key(df, [natural_key], first_by)
    known = known.select(natural_key, key_name)
    last = known.agg(F.max(key_name)).first()[0] or 0  # one number
    fresh = dense_keys(df.join(known, natural_key, "left_anti"), natural_key, key_name)
    kept = df.join(known, natural_key).select(key_name, *df.columns)
    return kept.unionByName(fresh.withColumn(key_name, F.col(key_name) + F.lit(last)))


def dense_keys(
    df: DataFrame, natural_key: str, key_name: str, first_by: Sequence[Column] | None = None
) -> DataFrame:
    """Add `key_name`, numbering rows 1..n by `natural_key` (unique, not NULL).

    With `first_by`, only the first row of each natural key in that order is
    kept (insert-ignore), before the rows are placed for numbering.

    Rows are range-partitioned and sorted in parallel; a row's key is its index
    in its partition plus the sizes of the partitions before it. Range bounds
    come from a sample, so the numbered rows are stored: both readers
    below, and any task run again, see one and the same placement.
    """
    rows = df if first_by is None else first_per_key(df, [natural_key], first_by)
    ranged = rows.repartitionByRange(F.col(natural_key))
    placed = stored_once(
        ranged.sortWithinPartitions(natural_key).withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", _ROW_BITS)
    # One row per partition, so the unpartitioned window and the broadcast are
    # bounded by the number of shuffle partitions.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    index = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(
            (F.col("_offset") + index + 1).alias(key_name),
            *[F.col(c) for c in df.columns],
        )
    )
