"""Strict, typed CSV scan."""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamina.operators.surrogate import stored_once
from lamina.schemas import RawColumn, raw_columns

# Stands for a quoted empty field while reading, so that it stays an empty
# text, while an unquoted empty field is NULL.
_QUOTED_EMPTY = "\u0001empty\u0001"
_OPTIONS = {"escape": '"', "emptyValue": _QUOTED_EMPTY, "mode": "FAILFAST"}


def _quotes() -> Column:
    # Bytes, whose number is known, not characters, which would be counted twice a line.
    return F.octet_length("value") - F.octet_length(F.replace(F.col("value"), F.lit('"'), F.lit("")))


def spans_lines(spark: SparkSession, path: str) -> bool:
    """True when some quoted field contains a line break.

    Exactly then some line has an odd number of quote characters. The test is a
    parallel text scan.
    """
    return not spark.read.text(path).where(_quotes() % 2 == 1).limit(1).isEmpty()


def _plain(spark: SparkSession, path: str) -> DataFrame:
    """Every record is a line: Spark's reader, which splits files into many tasks.

    All columns are parsed, also unused ones, so that a record of the wrong
    length is always noticed.
    """
    strict = {"header": True, "enforceSchema": False, "columnPruning": False}
    return spark.read.options(**strict, **_OPTIONS).csv(path)


def _multiline(spark: SparkSession, path: str) -> DataFrame:
    """For files with line breaks inside quotes; read in blocks by many tasks as well.

    A line starts a record when an even number of quotes precedes it in its
    file. Quotes are summed by block first, and over the blocks of a file. Each
    task then gathers the records of its blocks as it reads them, so lines
    aren't shuffled. Only a record that crosses the border of a block, at most
    one for each border, is put together from its fragments afterwards.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
        _quotes().alias("quotes"),
    )
    header = F.rtrim("value", F.lit("\r"))
    expected = lines.where("block = 0").select(header.alias("text")).first().text
    names = next(csv.reader([expected]))

    # A block is bounded by the split size, and a file has few blocks.
    earlier_blocks = (
        Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    unclosed = F.raise_error(F.concat(F.lit("unterminated quoted field in "), F.col("file")))
    blocks = stored_once(
        lines.groupBy("file", "block")
        .agg(F.sum("quotes").alias("sum"))
        .withColumn("entry", (F.coalesce(F.sum("sum").over(earlier_blocks), F.lit(0)) % 2).cast("int"))
        .withColumn("in_file", F.sum("sum").over(Window.partitionBy("file")))
        .where(F.when(F.col("in_file") % 2 == 1, unclosed).otherwise(F.lit(True)))
        .select("file", "block", "entry", ((F.col("entry") + F.col("sum")) % 2 == 1).alias("crossed"),
                F.row_number().over(Window.orderBy("file", "block")).alias("run"))
    )
    placed = lines.join(F.broadcast(blocks), ["file", "block"]).select(
        "run", "entry", (F.col("block") == 0).alias("has_header"), "value", F.col("quotes").cast("int"))
    layout = "run int, kind int, text string"
    records = placed.mapInArrow(_gathered(expected, fragments=False), layout).select("text")
    if not blocks.where("crossed").limit(1).isEmpty():
        opened = Window.partitionBy("file").orderBy("run", "kind")
        begun = F.last(F.when(F.col("kind") == _TAIL, F.col("run")), ignorenulls=True).over(opened)
        crossing = (
            placed.mapInArrow(_gathered(expected, fragments=True), layout)
            .join(F.broadcast(blocks.select("run", "file")), "run")
            .withColumn("record", begun)
            .groupBy("file", "record")
            .agg(F.sort_array(F.collect_list(F.struct("run", "kind", "text"))).alias("parts"))
            .select(F.array_join("parts.text", "\n").alias("text"))
        )
        records = records.unionByName(crossing)
    columns = ", ".join(f"`{n}` string" for n in names)
    records = records.select(F.rtrim("text", F.lit("\r")).alias("text")).where("text <> ''")
    return records.select(F.from_csv("text", columns, _OPTIONS).alias("row")).select("row.*")


_RECORD, _HEAD, _TAIL = 0, 1, 2  # whole records; the lines before a block's first start; those after its last, if unclosed


def _gathered(expected: str, fragments: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Whole records of the lines of blocks, or the fragments at the borders of blocks."""

    def joined(parts: list[pa.Array]) -> pa.Array:
        values = pa.concat_arrays(parts)
        return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values), "\n")

    def batch(run: int, kind: int, texts: pa.Array) -> Iterator[pa.RecordBatch]:
        if len(texts) and fragments == (kind != _RECORD):
            same = [pa.array(np.full(len(texts), v, "int32")) for v in (run, kind)]
            yield pa.RecordBatch.from_arrays([*same, texts.cast(pa.string())], ["run", "kind", "text"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, parity, held, begun = None, 0, [], False  # held: lines of the record that is open, or before the first

        def ended() -> Iterator[pa.RecordBatch]:
            if held:
                yield from batch(run, (_TAIL if parity else _RECORD) if begun else _HEAD, joined(held))

        for lines in batches:
            runs, quotes = (lines.column(n).to_numpy(zero_copy_only=False) for n in ("run", "quotes"))
            borders = [0, *(np.flatnonzero(np.diff(runs)) + 1), len(runs)]
            for a, b in zip(borders, borders[1:]):
                if a == b:
                    continue
                values, fresh = lines.column("value").slice(a, b - a), runs[a] != run
                if fresh:
                    yield from ended()
                    run, parity, held, begun = int(runs[a]), lines.column("entry")[a].as_py(), [], False
                after = (parity + np.cumsum(quotes[a:b])) % 2
                starts = np.concatenate([[parity], after[:-1]]) == 0
                parity = int(after[-1])
                if fresh and lines.column("has_header")[a].as_py():
                    if values[0].as_py().rstrip("\r") != expected:
                        raise ValueError(f"files have different headers: {values[0].as_py()!r}, {expected!r}")
                    values, starts, begun = values.slice(1), starts[1:], True
                at = np.flatnonzero(starts)
                if not len(at):
                    held += [values] if len(values) else []
                    continue
                if at[0]:
                    held.append(values.slice(0, at[0]))
                if held:
                    yield from batch(run, _RECORD if begun else _HEAD, joined(held))
                inner = values.slice(at[0], at[-1] - at[0])
                whole = pa.ListArray.from_arrays(pa.array(at - at[0], pa.int32()), pa.concat_arrays([inner]))
                yield from batch(run, _RECORD, pc.binary_join(whole, "\n"))
                held, begun = [values.slice(at[-1])], True
        yield from ended()

    return gather


def _typed(table: str, column: RawColumn, present: bool) -> Column:
    if not present:
        return F.lit(None).cast(column.type).alias(column.name)
    text = F.col(f"`{column.name}`")
    text = F.when(text == _QUOTED_EMPTY, F.lit("")).otherwise(text)
    if column.is_uuid:
        return F.lower(F.trim(text)).alias(column.name)
    if column.type.typeName() == "string":
        return text.alias(column.name)
    value = text.try_cast(column.type)
    message = F.concat(F.lit(f"bad value for {table}.{column.name}: "), text)
    checked = F.when(text.isNotNull() & value.isNull(), F.raise_error(message)).otherwise(value)
    return checked.alias(column.name)


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Read one raw table from a CSV file, or from a folder of them.

    Columns are matched by header name, in any order, and cast to the table's
    layout; missing ones are NULL. An unknown column, a value that does not fit
    its type, or files with different headers are errors.
    """
    text = _multiline(spark, path) if spans_lines(spark, path) else _plain(spark, path)
    columns = raw_columns(table)
    unknown = set(text.columns) - {c.name for c in columns}
    if unknown:
        raise ValueError(f"{path}: {table} has no column {', '.join(sorted(unknown))}")
    return text.select(*[_typed(table, c, c.name in text.columns) for c in columns])
