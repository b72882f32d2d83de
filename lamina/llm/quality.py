"""Quality by perplexity: an interpolated modified Kneser-Ney model over characters.

Counting. N-grams of `ORDER` characters of all trusted documents are packed to 60-bit keys,
summed up for each slice of text and then by key: counts cover the whole trusted corpus and
their tables live in shuffled partitions. Lower orders follow by shifting keys:
continuation counts, contexts, and the discounts from the counts of counts.

Scoring. The probabilities and back-off weights of all orders are one table of (key, log value).
It is cut into shards by an n-gram's last but one character, so that all a character's
probability needs stands in one shard; a shard has at most `SHARD_ROWS` rows, or one such character. Every
shard is joined with all documents in turn (one broadcast of bounded size each, looked up in
numpy), giving partial sums for each row, which are added up. The number of
shards follows from the size of the model, which characters bound; it doesn't grow with
the scored documents.

Thresholds. A language's threshold is a high quantile of its trusted documents' perplexities, with a margin.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.store import BROADCAST_IDS, saved, small
from lamina.llm.texts import HashIndex, Slice, slices

ORDER = 5
BITS = 12
SHARD_ROWS = 4_000_000
SCORE_BYTES = 1 << 18  # of text scored at once: whole arrays of 8 bytes a character are made of it
BROADCAST_SUMS = BROADCAST_IDS // 4  # rows of two keys and two sums
_MASK = (1 << BITS) - 1
_PLAIN = 3500  # code points above share what is left of the 12 bits


def _symbols(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Symbols 1.. of a slice, ORDER - 1 zeros before each row, and where each row's own begin."""
    points = np.frombuffer(part.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum((part.data & 0xC0) != 0x80)])[part.offsets]
    symbols = np.where(points < _PLAIN, points + 1, _PLAIN + 1 + points % (_MASK - _PLAIN))
    shift = (ORDER - 1) * (np.arange(len(part)) + 1)
    out = np.zeros(len(symbols) + (ORDER - 1) * len(part), np.int64)
    out[np.arange(len(symbols)) + np.repeat(shift, np.diff(starts))] = symbols
    return out, starts[:-1] + shift


def _packed(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-gram that ends at each character, and each row's number of characters."""
    symbols, begins = _symbols(part)
    lengths = np.diff(np.append(begins, len(symbols) + ORDER - 1)) - (ORDER - 1)
    at = np.arange(lengths.sum()) + np.repeat(begins - (np.cumsum(lengths) - lengths), lengths)
    key = np.zeros(len(at), np.int64)
    for j in range(ORDER - 1, -1, -1):
        key <<= BITS
        key |= symbols[at - j]
    return key, lengths


def _keys(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """The same with the row of each character."""
    key, lengths = _packed(part)
    return key, np.repeat(np.arange(len(part)), lengths)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch.column("text")):
            keys, counts = np.unique(_packed(part)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts.astype(np.int64))], ["key", "n"])


def _discounts(counts: DataFrame) -> list[float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and more, from the counts of counts."""
    n = dict(counts.where("n <= 4").groupBy("n").agg(F.count("*").alias("m")).collect())
    n1, n2, n3, n4 = (float(n.get(i, 0)) for i in range(1, 5))
    if not n1 or not n2 or not n3:
        return [0.5, 0.75, 0.9]
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(d, 0.05), i + 0.95) for i, d in enumerate(found)]


def train(trusted: DataFrame) -> DataFrame:
    """Table `order`, `key`, `value`: log-probabilities (order 1 to ORDER) and, with order + 8, log back-off weights.

    A back-off weight's key is its context. The probability of what is in no order is uniform.
    """
    full = saved(trusted.select("text").where("text is not null").mapInArrow(_counts, "key long, n long")
                 .groupBy("key").agg(F.sum("n").alias("n")))
    tables = {ORDER: full}
    for order in range(ORDER - 1, 0, -1):  # how many different characters stand before
        tables[order] = saved(tables[order + 1].select(
            F.col("key").bitwiseAND((1 << BITS * order) - 1).alias("key")).groupBy("key").agg(F.count("*").alias("n")))
    vocabulary = max(1, tables[1].count())
    lower, out = None, []
    for order in range(1, ORDER + 1):
        d1, d2, d3 = _discounts(tables[order])
        own = tables[order].withColumn("context", F.shiftright("key", BITS)).withColumn(
            "discount", F.expr(f"case n when 1 then {d1} when 2 then {d2} else {d3} end"))
        context = own.groupBy("context").agg(F.sum("n").alias("total"), F.sum("discount").alias("saved"))
        joined = own.join(context, "context").withColumn("first", (F.col("n") - F.col("discount")) / F.col("total"))
        if order == 1:
            grown = joined.withColumn("p", F.col("first") + F.col("saved") / F.col("total") / F.lit(vocabulary + 1.0))
        else:
            below = lower.select(F.col("key").alias("suffix"), F.col("p").alias("q"))
            grown = (joined.withColumn("suffix", F.col("key").bitwiseAND((1 << BITS * (order - 1)) - 1))
                     .join(below, "suffix").withColumn("p", F.col("first") + F.col("saved") / F.col("total") * F.col("q")))
        lower = saved(grown.select("key", "p"))
        out.append(lower.select(F.lit(order).alias("order"), "key", F.log("p").alias("value")))
        out.append(saved(context.select(F.lit(order + 8).alias("order"), F.col("context").alias("key"),
                                        F.log(F.col("saved") / F.col("total")).alias("value"))))
    return reduce(DataFrame.unionByName, out)


def _before():
    """The last but one character of a table row's n-grams."""
    return F.when(F.col("order") > 8, F.col("key")).otherwise(F.shiftright("key", BITS)).bitwiseAND(_MASK)


def _shards(model: DataFrame, most: int) -> list[list[int]]:
    """Characters dealt to shards of at most `most` rows, or of one character."""
    sizes = model.where("order not in (1, 9)").groupBy(_before().alias("c")).count().collect()  # 4,096 rows at most
    out, room = [], 0
    for row in sorted(sizes, key=lambda r: (-r["count"], r["c"])):
        if row["count"] > room:
            out.append([])
            room = most
        out[-1].append(row["c"])
        room -= row["count"]
    return out or [[]]


class _Table:
    """Values of one shard by order and key, for whole arrays."""

    def __init__(self, orders: np.ndarray, keys: np.ndarray, values: np.ndarray):
        self.values = np.append(values, 0.0)
        self.index = HashIndex(2 * max(8, len(keys)))
        self.index.add(self._mark(orders, keys), np.arange(len(keys)))

    @staticmethod
    def _mark(order: np.ndarray | int, key: np.ndarray) -> np.ndarray:
        return key.astype(np.uint64) | (np.asarray(order, np.uint64) << np.uint64(60))

    def get(self, order: int, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = self.index.find(self._mark(order, key))
        return self.values[row], row >= 0

    def log_probability(self, key: np.ndarray) -> np.ndarray:
        """Of each n-gram's last character: the longest known n-gram's value and the back-off weights above it."""
        out, todo = np.zeros(len(key)), np.arange(len(key))
        for order in range(ORDER, 0, -1):
            own = key[todo] & ((1 << BITS * order) - 1)
            value, known = self.get(order, own)
            out[todo[known]] += value[known]
            todo, own = todo[~known], own[~known]
            weight, _ = self.get(order + 8, own >> BITS)  # an unknown context weighs 1: log 0
            out[todo] += weight
        out[todo] += self.uniform
        return out


def _scored(shared, shards: int, columns: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _Table(*shared.value[:3])
        table.uniform = shared.value[3]
        mine = shared.value[4]
        for batch in batches:
            for part in slices(batch.column("text"), SCORE_BYTES):
                key, row = _keys(part)
                if shards > 1:
                    own = mine[(key >> BITS) & _MASK]
                    key, row = key[own], row[own]
                sums = np.bincount(row, table.log_probability(key), minlength=len(part)).astype(np.float64)
                out = [batch.column(c).slice(part.first, len(part)) for c in columns]
                yield pa.RecordBatch.from_arrays(
                    [*out, pa.array(sums), pa.array(np.bincount(row, minlength=len(part)).astype(np.int64))],
                    [*columns, "log_p", "n"])
    return run


def perplexity(docs: DataFrame, model: DataFrame, columns: tuple[str, ...] = ("doc_id",),
               shard_rows: int = SHARD_ROWS) -> DataFrame:
    """`columns`, `n` (characters) and `perplexity` for each character of the whole text (null: none).

    Every row is returned, repeated ones too, whatever the number of shards. With several,
    partial sums are added up by document and text, and joined back to the rows.
    """
    spark = docs.sparkSession
    vocabulary = model.where("order = 1").count()
    shards = _shards(model, shard_rows) if vocabulary else []
    if not shards:
        return docs.select(*columns, F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("perplexity"))
    uniform = -float(np.log(vocabulary + 1.0))
    asked, names = docs.select(*dict.fromkeys((*columns, "text"))), columns
    if len(shards) > 1:
        # Two hashes of document and text: copies of a row share them, and have equal sums.
        keyed = docs.select("*", F.xxhash64("doc_id", "text").alias("_key"), F.xxhash64("text", "doc_id").alias("_key2"))
        names = ("_key", "_key2")
        asked = keyed.select(*names, "text")
    kinds = dict(asked.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", log_p double, n long"
    parts = []
    for number, characters in enumerate(shards):
        own = (model.where(F.col("order").isin(1, 9) | _before().isin(characters) if len(shards) > 1 else F.lit(True))
               .selectExpr("cast(order as tinyint) as order", "key", "value").toArrow())
        # Characters that stand before nothing known fall to the first shard.
        mine = np.zeros(1 << BITS, bool)
        mine[characters] = True
        if number == 0:
            mine |= ~np.isin(np.arange(1 << BITS), [c for s in shards for c in s])
        shared = spark.sparkContext.broadcast((
            own["order"].to_numpy(), own["key"].to_numpy(), own["value"].to_numpy(), uniform, mine))
        del own
        parts.append(asked.mapInArrow(_scored(shared, len(shards), names), schema))
    summed = parts[0]
    if len(shards) > 1:
        # A row comes once from each shard, so a row's sums are those of its copies by their number.
        copies = F.count("*") / len(shards)
        sums = (reduce(DataFrame.unionByName, parts).groupBy(*names)
                .agg((F.sum("log_p") / copies).alias("log_p"), (F.sum("n") / copies).cast("long").alias("n")))
        summed = keyed.select(*names, *columns).join(small(sums, BROADCAST_SUMS), list(names))
    return summed.select(*columns, "n", F.when(F.col("n") > 0, F.exp(-F.col("log_p") / F.col("n"))).alias("perplexity"))


def classify(docs: DataFrame, labels: DataFrame, quantile: float = 0.995, margin: float = 1.05,
             prior: float = 50.0, keep: tuple[str, ...] = ()) -> DataFrame:
    """`doc_id`, `lang`, `keep`, `perplexity`, `measure`, `threshold`, `kept` for every document.

    Trusted are documents that `labels` gives quality 1. A few characters say little, so the
    measure of a document is its perplexity as if `prior` characters of its
    language's median trusted perplexity stood beside it. A language's threshold is the
    `quantile` of its trusted documents' measures times `margin`, taken from a fifth of them by a
    model of the others; the model that judges is trained on all. Documents of a
    language without trusted ones (null too) take that of all. A document is rejected if
    its measure is above. Null and empty texts have no perplexity and are rejected. Without any trusted
    document all texts but those are kept. Rows without a doc_id are left out.
    """
    docs = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
        *[c for c in keep if c not in ("doc_id", "text", "lang")])
    columns = tuple(dict.fromkeys(("doc_id", "lang", *keep)))
    good = (labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
            .agg(F.max("quality").alias("quality")).where("quality = 1").select("doc_id"))
    good = small(good, BROADCAST_IDS)  # else texts would be shuffled to their labels
    trusted = docs.join(good, "doc_id", "left_semi")
    if trusted.where("text <> ''").isEmpty():
        return docs.select(*columns, *(F.lit(None).cast("double").alias(c) for c in ("perplexity", "measure", "threshold")),
                           (F.length(F.coalesce("text", F.lit(""))) > 0).alias("kept"))
    # Thresholds come from trusted documents that their model hasn't seen: seen ones look too usual.
    unseen = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    held, seen = trusted.where(unseen), trusted.where(~unseen)
    if held.where("text <> ''").isEmpty() or seen.where("text <> ''").isEmpty():
        held = seen = trusted
    measured = saved(perplexity(held, train(seen), ("doc_id", "lang")).where("perplexity is not null"))
    model = train(trusted)

    def by_language(frame: DataFrame, column: str, share: float) -> tuple[DataFrame, float]:
        value = F.percentile_approx(column, share, 100_000)
        return (small(frame.where("lang is not null").groupBy("lang").agg(value.alias("own")), 100_000),
                frame.agg(value.alias("all")).first()["all"])

    middle, of_all = by_language(measured, "perplexity", 0.5)

    def with_measure(frame: DataFrame) -> DataFrame:
        usual = F.coalesce("own", F.lit(of_all))
        total = F.col("n") * F.log("perplexity") + prior * F.log(usual)
        return frame.join(middle, "lang", "left").withColumn("measure", F.exp(total / (F.col("n") + prior))).drop("own")

    cut, cut_of_all = by_language(with_measure(measured), "measure", quantile)
    joined = with_measure(perplexity(docs, model, columns)).join(cut, "lang", "left").withColumn(
        "threshold", F.coalesce("own", F.lit(cut_of_all)) * margin)
    kept = F.coalesce(F.col("measure") <= F.col("threshold"), F.lit(False))
    return joined.select(*columns, "perplexity", "measure", "threshold", kept.alias("kept"))
