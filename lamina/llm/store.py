"""Intermediate tables in the folder all executors share, and the frame of a document."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; only a local session gets one of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="lamina-checkpoint-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def saved(df: DataFrame) -> DataFrame:
    """Write once, read from then on: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/lamina-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int) -> DataFrame:
    """Written and counted; broadcast up to `rows` rows, and joined by a shuffle beyond."""
    df = saved(df)
    return F.broadcast(df) if df.count() <= rows else df


#: Ids (16 bytes each in a hash table) that are sent to every executor at most.
BROADCAST_IDS = 4_000_000


#: Of an Arrow batch. Spark's own limit is 64 MB, and the JVM and the Python worker each hold a batch or two.
BATCH_BYTES = 4 << 20


def light_batches(spark: SparkSession) -> None:
    """Texts go to Python in batches of at most about `BATCH_BYTES` from here on in this session, or of less if it says so."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(name)
    if not (held.rstrip("b").isdigit() and int(held.rstrip("b")) <= BATCH_BYTES):
        spark.conf.set(name, str(BATCH_BYTES))


def documents(df: DataFrame, *more: str) -> DataFrame:
    """`row_key`, `doc_id`, `text` of a documents table, extra columns left out.

    Rows without a doc_id are no documents. `row_key` tells rows of one doc_id
    with different texts apart; rows repeated whole share it.
    """
    text = F.col("text").cast("string")
    return df.where("doc_id is not null").select(
        F.xxhash64(F.col("doc_id").cast("long"), text).alias("row_key"),
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), *more)
