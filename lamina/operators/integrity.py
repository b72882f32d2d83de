"""Key and reference reports. They list violations; they do not enforce."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (rows with a NULL in the key included)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def duplicate_summary(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """One row: how many keys repeat, and how many rows are surplus."""
    return duplicate_keys(df, keys).agg(
        F.lit(table).alias("table_name"),
        F.lit(",".join(keys)).alias("key_columns"),
        F.count(F.lit(1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.col("row_count") - 1), F.lit(0)).cast("bigint").alias("surplus_rows"),
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys that no parent row has, with their row counts. NULL is no orphan.

    The child is counted per key first, so a key on a third of the rows reaches
    the join as one row.
    """
    keys = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("key"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    return keys.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti")


def orphan_summary(
    child: DataFrame, child_name: str, column: str, parent: DataFrame, parent_name: str,
    parent_key: str = "id",
) -> DataFrame:
    """One row: how many keys and rows of `child.column` point nowhere."""
    return orphans(child, column, parent, parent_key).agg(
        F.lit(child_name).alias("child_table"),
        F.lit(column).alias("child_column"),
        F.lit(parent_name).alias("parent_table"),
        F.count(F.lit(1)).alias("orphan_keys"),
        F.coalesce(F.sum("row_count"), F.lit(0)).cast("bigint").alias("orphan_rows"),
    )


def orphan_summaries(
    references: Sequence[tuple[str, str, str]], tables: Mapping[str, DataFrame], parent_key: str = "id",
) -> DataFrame:
    """`orphan_summary` of many references (child, column, parent) of one key type, in one plan.

    A child is read once for all its references, and a parent once for all that point at it. Their keys meet in
    a sort-merge join: estimates of one column of a wide table fall short, so a broadcast, one for each reference,
    would bring all the parents' keys to the driver.
    """
    parents = sorted({parent for _, _, parent in references})
    counted = []
    for child in dict.fromkeys(child for child, _, _ in references):
        pairs = F.array(*[
            F.struct(F.lit(i).alias("ref"), F.lit(parents.index(parent)).alias("parent"), F.col(column).alias("key"))
            for i, (name, column, parent) in enumerate(references) if name == child])
        counted.append(tables[child].select(F.inline(pairs)).where("key is not null")
                       .groupBy("ref", "parent", "key").agg(F.count(F.lit(1)).alias("row_count")))
    held = reduce(DataFrame.unionByName, [
        tables[name].select(F.lit(i).alias("parent"), F.col(parent_key).alias("key")) for i, name in enumerate(parents)])
    found = (
        reduce(DataFrame.unionByName, counted)
        .join(held.hint("merge"), ["parent", "key"], "left_anti")
        .groupBy("ref").agg(F.count(F.lit(1)).alias("orphan_keys"), F.sum("row_count").alias("orphan_rows"))
    )
    listed = found.sparkSession.createDataFrame(
        [(i, *names) for i, names in enumerate(references)],
        "ref int, child_table string, child_column string, parent_table string")
    return listed.join(found, "ref", "left").orderBy("ref").select(
        "child_table", "child_column", "parent_table",
        *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in ("orphan_keys", "orphan_rows")])
