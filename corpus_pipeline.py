"""A training corpus from `documents`: five stages, each over all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import decontam, minhash, packing, quality, substring
from lamina.llm.queries import table, tokenizer_file
from lamina.llm.store import BROADCAST_IDS, documents, light_batches, saved, small

#: Columns of `documents`, which all stages but the last return.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under the model of trusted text is usual for their language."""
    light_batches(spark)
    judged = quality.classify(docs, table(spark, sf_dir, "labels"), keep=COLUMNS)
    return _documents(judged.where("kept"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (five-word shingles, 0.8), that of its smallest doc_id.

    Rows are told apart by row_key, so a row that shares its doc_id with a duplicate stays. Of rows
    repeated whole one stays; only their texts are shuffled.
    """
    light_batches(spark)
    groups = saved(minhash.near_duplicates(docs, words=5, percent=80, with_keys=True).select("row_key", "first_key"))
    gone = small(groups.where("row_key <> first_key").select("row_key").distinct(), BROADCAST_IDS)
    twice = small(groups.where("row_key = first_key").groupBy("row_key").agg(F.count("*").alias("n"))
                  .where("n > 1").select("row_key"), BROADCAST_IDS)
    keyed = documents(docs, *(c for c in COLUMNS if c not in ("doc_id", "text"))).join(gone, "row_key", "left_anti")
    single = keyed.join(twice, "row_key", "left_anti")
    first = keyed.join(twice, "row_key", "left_semi").groupBy("row_key").agg(F.min(F.struct(*COLUMNS)).alias("row"))
    return _documents(single).unionByName(first.select("row.*"))


def cut_recurring_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words that recurring windows of 35 words cover; a document without words left goes."""
    light_batches(spark)
    cut = substring.remove_recurring(docs, length=35, with_text=True, keep=("lang", "source"))
    left = cut.where("n_removed < n_words").withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return _documents(left)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark items make up less than one word in twenty. Rows are told apart by row_key."""
    light_batches(spark)
    found = decontam.contamination(docs, table(spark, sf_dir, "benchmark"), window=13, with_keys=True)
    gone = small(found.where("contaminated").select("row_key").distinct(), BROADCAST_IDS)
    keyed = documents(docs, *(c for c in COLUMNS if c not in ("doc_id", "text")))
    return _documents(keyed.join(gone, "row_key", "left_anti"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenised documents, each with its place in a sequence of 1024 tokens."""
    light_batches(spark)
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("byte_bpe_50k.tiktoken"), capacity=1024, end_id=2)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", drop_low_quality),
    ("minhash_near_dedup", keep_one_of_each),
    ("substring_dedup", cut_recurring_passages),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]

#: Perplexities, signatures and packings are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result but the last is written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = saved(docs)
    return docs
