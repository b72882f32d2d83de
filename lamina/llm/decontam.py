"""Benchmark passages in documents, by winnowing; DataFrame functions only.

Fingerprints: of each `SPAN` neighbouring k-gram hashes the smallest is kept. Any
stretch of GRAM + SPAN - 1 = `window` equal words has a fingerprint in common, so
no shared window is missed. Items shorter than a window are one window of their
own length; for the lengths that occur, documents' stretches of that length are
fingerprints too.

Only fingerprints are joined (about 2 / (SPAN + 1) of the words). For documents with
a common one, the windows around each hit are compared as text with the
items' windows. Hits are summed up for each document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.store import BROADCAST_IDS, saved, small

GRAM = 5
_SIGNS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of benchmark windows up to which they are broadcast (some 100 MB at most); beyond, joins shuffle.
BROADCAST_ROWS = 200_000


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z) words of letters, digits and what is not ASCII; none for null."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.filter(F.split(lowered, _SIGNS), lambda w: w != "")


def _grams(hashes: Column, length: int) -> Column:
    """A hash for each stretch of `length` words."""
    count = F.size(hashes) - (length - 1)
    return F.when(count > 0, F.transform(
        F.sequence(F.lit(1), count),
        lambda i: F.xxhash64(*[F.element_at(hashes, i + j) for j in range(length)]))).otherwise(
        F.expr("cast(array() as array<bigint>)"))


def _winnowed(grams: Column, span: int) -> Column:
    """The smallest hash of each `span` neighbours, once each."""
    count = F.size(grams) - (span - 1)
    return F.when(count > 0, F.array_distinct(F.transform(
        F.sequence(F.lit(1), count), lambda i: F.array_min(F.slice(grams, i, span))))).otherwise(
        F.expr("cast(array() as array<bigint>)"))


def _stretches(words: Column, starts: Column, length: Column | int) -> Column:
    return F.transform(starts, lambda s: F.struct(
        s.alias("start"), F.lit(length).alias("length"),
        F.array_join(F.slice(words, s + 1, length), " ").alias("stretch")))


def _maybe_broadcast(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, keep: tuple[str, ...] = (),
                  with_keys: bool = False) -> DataFrame:
    """`doc_id`, `keep`, `n_words`, `n_hit`, `n_items`, `items` (sorted as strings), `contaminated`.

    A document word is hit if it stands in an occurrence of a window: `window`
    consecutive words of an item, or all of an item that has fewer. An item
    counts once one of its windows occurs. contaminated: at least one word is hit, and
    one in twenty.

    Null and empty texts have no words; items without words or without item_id
    match nothing. Rows without a doc_id are left out. Every other row is returned, also where
    rows share a doc_id or are repeated whole (these share `row_key`, returned if `with_keys`, and `keep`);
    repeated items count once.
    """
    span = window - GRAM + 1
    items = (benchmark.where("item_id is not null").select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("words"))
             .withColumn("n", F.size("words")).where("n > 0"))
    # Every window of the benchmark as text, with the items that hold it.
    windows = items.select("item", F.explode(F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("n") - (window - 1))),
        lambda i: F.slice("words", i, window))).alias("own"))
    windows = saved(windows.select("item", F.size("own").alias("length"), F.array_join("own", " ").alias("stretch"),
                                   F.transform("own", lambda w: F.xxhash64(w)).alias("hashes"))
                    .groupBy("length", "stretch").agg(F.collect_set("item").alias("held"), F.first("hashes").alias("hashes")))
    by_length = {r["length"]: r["n"] for r in windows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = sum(by_length.values())
    short = sorted(n for n in by_length if n < window)  # at most `window` - 1 lengths
    prints = windows.select("length", F.explode(F.when(
        F.col("length") == window, _winnowed(_grams(F.col("hashes"), GRAM), span)).otherwise(
        F.array(F.xxhash64("length", "hashes")))).alias("print")).select("print").distinct()

    base = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *keep)
    base = base.withColumn("row_key", F.xxhash64("doc_id", "text"))
    words = base.withColumn("words", words_of(F.col("text"))).withColumn(
        "hashes", F.transform("words", lambda w: F.xxhash64(w)))

    def short_prints(length: int) -> Column:
        count = F.size("hashes") - (length - 1)
        return F.when(count > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), count), lambda i: F.xxhash64(
            F.lit(length), F.slice("hashes", i, length))))).otherwise(F.expr("cast(array() as array<bigint>)"))

    mine = _winnowed(F.col("grams"), span)
    if short:
        mine = F.concat(mine, *[short_prints(n) for n in short])
    printed = (words.withColumn("grams", _grams(F.col("hashes"), GRAM))
               .select("row_key", F.explode(mine).alias("print")))
    hits = (printed.join(_maybe_broadcast(prints, rows), "print").groupBy("row_key")
            .agg(F.collect_set("print").alias("prints")))

    # Documents with a common fingerprint: the windows around each hit, as text.
    found = (base.join(hits, "row_key", "left")
             .withColumn("words", words_of(F.col("text"))).withColumn("n_words", F.size("words").cast("long"))
             .drop("text").withColumn("hashes", F.when(
                 F.col("prints").isNotNull(), F.transform("words", lambda w: F.xxhash64(w)))))
    none = F.expr("cast(array() as array<int>)")
    grams = _grams(F.col("hashes"), GRAM)
    at = F.filter(F.sequence(F.lit(0), F.size("grams") - 1), lambda i: F.array_contains("prints", F.get("grams", i)))
    last = F.size("words") - window
    starts = F.array_distinct(F.flatten(F.transform(at, lambda p: F.when(
        (last >= 0) & (F.greatest(p - (span - 1), F.lit(0)) <= F.least(p, last)),
        F.sequence(F.greatest(p - (span - 1), F.lit(0)), F.least(p, last))).otherwise(none))))
    found = found.withColumn("grams", F.when(F.col("prints").isNotNull(), grams))
    tries = F.when(F.size("grams") > 0, _stretches(F.col("words"), starts, window)).otherwise(
        F.expr("cast(array() as array<struct<start:int,length:int,stretch:string>>)"))
    def short_tries(length: int) -> Column:
        count = F.size("words") - length
        starts = F.filter(F.sequence(F.lit(0), count), lambda s: F.array_contains(
            "prints", F.xxhash64(F.lit(length), F.slice("hashes", s + 1, length))))
        return F.when(F.col("prints").isNotNull() & (count >= 0), _stretches(F.col("words"), starts, length)).otherwise(
            F.expr("cast(array() as array<struct<start:int,length:int,stretch:string>>)"))

    tries = F.concat(tries, *[short_tries(n) for n in short])
    tried = found.select("row_key", "doc_id", "n_words", *keep, F.explode_outer(tries).alias("try"))
    known = _maybe_broadcast(windows.select("length", "stretch", "held"), rows)
    matched = tried.select("row_key", "doc_id", "n_words", *keep, "try.start", "try.length", "try.stretch").join(
        known, ["length", "stretch"], "left").withColumn("start", F.when(F.col("held").isNotNull(), F.col("start")))
    covered = F.transform(F.collect_set(F.when(F.col("start").isNotNull(), F.struct("start", "length"))),
                          lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1))
    per = matched.groupBy("row_key", "doc_id").agg(
        F.first("n_words").alias("n_words"), *[F.first(c).alias(c) for c in keep],
        F.size(F.array_distinct(F.flatten(covered))).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("held")))).alias("items"))
    twice = base.groupBy("row_key").agg(F.count("*").alias("copies")).where("copies > 1")
    per = per.join(small(twice, BROADCAST_IDS), "row_key", "left").withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("copies", F.lit(1).cast("long")))))
    return per.select(*["row_key"][:with_keys], "doc_id", *keep, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
                      ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))
