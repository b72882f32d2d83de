"""How far sources drift apart in the terms of their language, by Iceberg prefix refinement.

A term is kept if at least `support` documents of its language hold it. Most distinct terms aren't, and
counting them all would move a table nearly as large as the corpus. So prefixes are counted first: at each
level (16, 64, 256 ... bytes) every document names the distinct prefixes of its terms, tasks add them
up, and a prefix in fewer than `support` documents is discarded with all terms below it. Terms that end within
a level's bytes are complete there and are kept or dropped by their own exact count. Longer ones go on to the next
level if their prefix stayed. The levels end when no prefix is left to extend.

Tasks recognise the prefixes that stayed by a bit table of bounded size. It lets some others through, and those
fall at their own counts one level later, so results are exact at every size. Groups' counts of the kept terms
take one more pass; only kept terms leave the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamina.llm.store import saved
from lamina.llm.texts import BYTE_CODES, LOWER, Rolling, Slice, byte_set, slices

SLICE_BYTES = 8 << 20  # tasks name each term once a slice, so larger slices send fewer rows
FIRST_LEVEL = 16  # bytes: most terms are complete there, and each level is a pass over the texts; levels grow fourfold
TABLE_BITS = 27  # of the largest bit table: 16 MB
PROBES = 3
SCALE = 1_000_000_000
SHOWN = 200  # ranks of the part `term`
BLOCK_TERMS, BLOCK_SOURCES = 4096, 128  # a group of the part `pair` holds as many terms, of two blocks of sources

#: No byte of a term: all but letters and bytes of characters beyond ASCII.
GAPS = byte_set((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


def corpus(docs: DataFrame) -> DataFrame:
    """`lang`, `source`, `text` with nulls as ''. Each row is a document."""
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))


# --- terms of a slice of texts -----------------------------------------------


def _terms(part: Slice, above: int = 0) -> tuple[pa.BinaryArray, np.ndarray, np.ndarray]:
    """Distinct terms of a slice of more than `above` bytes, lower-cased, and of each occurrence its term and its row."""
    solid = ~GAPS[part.data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    edges = part.offsets[:-1][np.diff(part.offsets) > 0]
    begins[edges] = solid[edges]  # a text's start starts a term
    places = np.flatnonzero(begins)
    before = np.cumsum(solid, dtype=np.int32)  # bytes of terms up to each place
    offsets = np.append(before[places] - np.int32(1), before[-1:])
    words = pa.Array.from_buffers(pa.binary(), len(places), [None, pa.py_buffer(offsets), pa.py_buffer(LOWER[part.data[solid]])])
    if above:  # most are shorter, and hashing them is most of the work
        longer = np.flatnonzero(np.diff(offsets) > above)
        coded = words.take(pa.array(longer)).dictionary_encode()
        rows = np.searchsorted(part.offsets, places[longer], side="right") - 1
    else:
        coded = words.dictionary_encode()
        rows = np.repeat(np.arange(len(part)), np.diff(np.searchsorted(places, part.offsets)))
    return coded.dictionary, coded.indices.to_numpy(), rows


def _distinct(codes: np.ndarray, space: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes below `space`, rising, and of each code its place among them."""
    if space > 16 * len(codes):
        return np.unique(codes, return_inverse=True)
    there = np.zeros(space, bool)
    there[codes] = True
    found = np.flatnonzero(there)
    place = np.zeros(space, np.int32)
    place[found] = np.arange(len(found), dtype=np.int32)
    return found, place[codes]


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in any order and how often each stands."""
    found = pc.value_counts(pa.array(codes))
    return found.field("values").to_numpy(), found.field("counts").to_numpy()


def _hashes(keys: pa.BinaryArray, langs: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each key and its language's number or hash."""
    _, where, what = keys.buffers()
    offsets = np.frombuffer(where, np.int32)[keys.offset: keys.offset + len(keys) + 1].astype(np.int64)
    data = np.frombuffer(what, np.uint8) if what is not None else np.zeros(0, np.uint8)
    low = int(offsets[0]) if len(offsets) else 0
    rolling = Rolling(BYTE_CODES[data[low: int(offsets[-1])]])
    return rolling(offsets[:-1] - low, offsets[1:] - low) ^ langs


class BitTable:
    """A set of 64-bit hashes in 2 ** bits bits that may say yes to others. Its size is bounded whatever the set."""

    def __init__(self, bits: int, words: np.ndarray):
        self.bits, self.words = bits, words

    @staticmethod
    def places(hashes: np.ndarray, bits: int) -> np.ndarray:
        step = (hashes << np.uint64(32) | hashes >> np.uint64(32)) | np.uint64(1)
        return np.stack([(hashes + np.uint64(k) * step) >> np.uint64(64 - bits) for k in range(PROBES)]).astype(np.int64)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for place in self.places(hashes, self.bits):
            found &= (self.words[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
        return found


def _lang_hash(langs: list[str]) -> np.ndarray:
    texts = pa.array([x.encode() for x in langs], pa.binary())
    return _hashes(texts, np.zeros(1, np.uint64)) * np.uint64(0x9E3779B97F4A7C15)


def bit_table(keys: DataFrame, count: int) -> BitTable:
    """The table of `lang`, `key` rows: tasks set bits, Spark ors them by word; the driver gets at most 2 MB words."""
    bits = min(TABLE_BITS, max(10, int(16 * count).bit_length()))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            own = _lang_hash(langs.dictionary.to_pylist())[langs.indices.to_numpy()] if batch.num_rows else np.zeros(0, np.uint64)
            place = BitTable.places(_hashes(batch.column("key").cast(pa.binary()), own), bits).ravel()
            word, at = np.unique(place >> 6, return_inverse=True)
            bit = np.zeros(len(word), np.int64)
            np.bitwise_or.at(bit, at, np.left_shift(np.int64(1), place & 63))
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bit)], ["word", "bits"])

    found = (keys.select("lang", "key").mapInArrow(words, "word long, bits long")
             .groupBy("word").agg(F.expr("bit_or(bits)").alias("bits")).toArrow())
    table = np.zeros(1 << max(0, bits - 6), np.int64)
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return BitTable(bits, table.view(np.uint8))


# --- kept terms --------------------------------------------------------------


def kept_terms(docs: DataFrame, support: int = 3) -> DataFrame:
    """`lang`, `key` (bytes of a term) and `n_docs` of the terms in at least `support` documents of their language."""
    texts, spark = corpus(docs), docs.sparkSession
    stayed, kept, below, level = None, [], 0, FIRST_LEVEL
    while True:
        counted = saved(_level(texts, spark, stayed, below, level).groupBy("lang", "key", "done")
                        .agg(F.sum("n_docs").alias("n_docs")).where(F.col("n_docs") >= support))
        kept.append(counted.where("done").select("lang", "key", "n_docs"))
        longer = counted.where("not done")
        n = longer.count()
        if not n:
            break
        stayed, below, level = bit_table(longer, n), level, level * 4
    found = kept[0]
    for part in kept[1:]:
        found = found.unionAll(part)
    return found


def _level(texts: DataFrame, spark: SparkSession, stayed: BitTable | None, below: int, level: int) -> DataFrame:
    """Prefixes of up to `level` bytes of the terms above `below` bytes whose prefix stayed: documents of each slice."""
    shared = spark.sparkContext.broadcast(stayed)  # at most 16 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for part in slices(batch.column("text"), SLICE_BYTES):
                terms, code, row = _terms(part, below)
                if not len(code):
                    continue
                langs = batch.column("lang").slice(part.first, len(part)).dictionary_encode()
                names, lang = langs.dictionary.to_pylist(), langs.indices.to_numpy()
                length = np.asarray(pc.binary_length(terms))
                # one row for each language and term, then for each language and prefix
                cell, at = _distinct(lang[row].astype(np.int64) * len(terms) + code, len(names) * len(terms))
                own, term = np.divmod(cell, len(terms))
                if table is not None:
                    parent = pc.binary_slice(terms.take(pa.array(term)), 0, below)
                    good = table.has(_hashes(parent, _lang_hash(names)[own]))
                    stay = good[at]
                    at, row = at[stay], row[stay]
                prefix = pc.binary_slice(terms.take(pa.array(term)), 0, level).dictionary_encode()
                done = length[term] <= level
                key = (own * len(prefix.dictionary) + prefix.indices.to_numpy()) * 2 + done
                pairs = pc.unique(pa.array(key[at] * len(part) + row)).to_numpy()  # a document counts once
                key, count = _counted(pairs // len(part))
                own, rest = np.divmod(key, 2 * len(prefix.dictionary))
                yield pa.RecordBatch.from_arrays(
                    [pa.DictionaryArray.from_arrays(pa.array(own), langs.dictionary).cast(pa.string()),
                     prefix.dictionary.take(pa.array(rest >> 1)), pa.array((rest & 1).astype(bool)), pa.array(count)],
                    ["lang", "key", "done", "n_docs"])

    return texts.select("lang", "text").mapInArrow(run, "lang string, key binary, done boolean, n_docs long")


# --- counts and divergences --------------------------------------------------


def term_counts(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """`lang`, `source`, `key`, `n`: occurrences of the kept terms in each group, where there are any."""
    texts, spark = corpus(docs), docs.sparkSession
    shared = spark.sparkContext.broadcast(bit_table(kept, kept.count()))  # at most 16 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for part in slices(batch.column("text"), SLICE_BYTES):
                terms, code, row = _terms(part)
                if not len(code):
                    continue
                langs, sources = (batch.column(c).slice(part.first, len(part)).dictionary_encode() for c in ("lang", "source"))
                group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
                cell, count = _counted(group[row] * len(terms) + code)
                own, term = np.divmod(cell, len(terms))
                lang, source = np.divmod(own, len(sources.dictionary))
                keys = terms.take(pa.array(term))
                stay = table.has(_hashes(keys, _lang_hash(langs.dictionary.to_pylist())[lang]))
                yield pa.RecordBatch.from_arrays(
                    [pa.DictionaryArray.from_arrays(pa.array(lang[stay]), langs.dictionary).cast(pa.string()),
                     pa.DictionaryArray.from_arrays(pa.array(source[stay]), sources.dictionary).cast(pa.string()),
                     keys.filter(pa.array(stay)), pa.array(count[stay])], ["lang", "source", "key", "n"])

    found = texts.mapInArrow(run, "lang string, source string, key binary, n long")
    # Joins name the key first: rows are sorted by it, and sorts tell rows apart by the first column's first bytes.
    return (found.groupBy("lang", "source", "key").agg(F.sum("n").alias("n"))
            .join(kept.select("lang", "key"), ["key", "lang"], "left_semi").select("lang", "source", "key", "n"))


def share(n: Column | int, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + terms)), in whole numbers of 38 digits."""
    n = F.lit(n) if isinstance(n, int) else n
    above = F.lit(SCALE).cast("decimal(10,0)") * (n.cast("decimal(20,0)") + 1).cast("decimal(20,0)")
    return F.call_function("div", above, (total.cast("decimal(20,0)") + terms).cast("decimal(21,0)")) + 1


def divergence(docs: DataFrame, support: int = 3, shown: int = SHOWN) -> DataFrame:
    """`lang`, `source`, `part`, `item`, `value`, `rank` of every occurring (lang, source).

    Part `pair`: how far each other source of the language is, summed over all kept terms. Part `term`: the `shown` terms
    that the source has most above its language. Shares are whole numbers of a billion, so all values are exact.

    Nulls in text, lang and source are ''. Each row is a document, repeated rows, too; no other column is looked at. Whole texts
    count. Equal values rank by item, as UTF-8. Sources without terms, and languages without kept terms, have their pairs, at 0 if
    there is no kept term. No documents, no rows.
    """
    kept = saved(kept_terms(docs, support))
    counts = saved(term_counts(docs, kept))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("terms"))
    totals = saved(counts.groupBy("lang", "source").agg(F.sum("n").alias("total")))
    sums = totals.groupBy("lang").agg(F.sum("total").alias("sum_lang"))
    named = corpus(docs).select("lang", "source").distinct()
    fan = named.groupBy("lang").agg(F.count("*").alias("n_sources")).join(sizes, "lang", "left").join(sums, "lang", "left").select(
        "lang", "sum_lang", F.coalesce("terms", F.lit(0)).alias("terms"),
        F.ceil(F.col("n_sources") / BLOCK_SOURCES).alias("source_blocks"),
        F.greatest(F.lit(1), F.ceil(F.col("terms") / BLOCK_TERMS)).alias("term_blocks"))
    groups = saved(named.join(totals, ["lang", "source"], "left").join(fan, "lang").withColumn("total", F.coalesce("total", F.lit(0)))
                   .withColumn("none", F.when(F.col("terms") > 0, share(0, F.col("total"), F.col("terms"))).otherwise(1)))
    shares = saved(counts.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("terms"))))
    return _pairs(groups, shares).unionByName(_terms_above(counts, shares, shown))


def _terms_above(counts: DataFrame, shares: DataFrame, shown: int) -> DataFrame:
    """A limit of `shown` rows a group is taken in each task before anything is shuffled by group."""
    whole = counts.groupBy("key", "lang").agg(F.sum("n").alias("n_lang"))
    q = share(F.col("n_lang"), F.col("sum_lang"), F.col("terms"))
    above = shares.join(whole, ["key", "lang"]).withColumn("q", q).where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("key").cast("string").alias("item"),
        F.expr("(p - q) * (p - q) div q").alias("value"))
    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return above.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= shown)


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """Sources meet block against block: a group of rows is a block of terms and two blocks of sources.

    Terms that no source of a group has add the same to every group, so they are only counted. Every group gets
    a row without a term of each of its sources, so that no source is missed.
    """
    fixed = ("lang", "source", "none", "terms", "source_blocks")
    own = F.pmod(F.xxhash64("source"), "source_blocks").cast("int")
    rows = shares.select(*fixed, F.pmod(F.xxhash64("key"), "term_blocks").alias("term_block"), "key", "p").unionAll(
        groups.select(*fixed, F.explode(F.expr("sequence(0l, term_blocks - 1)")).alias("term_block"),
                      F.lit(None).cast("binary").alias("key"), F.col("none").alias("p")))
    placed = rows.withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0, cast(source_blocks - 1 as int))"))).select(
        "lang", "source", "none", "terms", "term_block", "key", "p", "own",
        F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))

    def compared(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        names = table.column("source").combine_chunks().dictionary_encode()
        terms = table.column("key").combine_chunks().dictionary_encode()
        source = names.indices.to_numpy()
        there = np.asarray(terms.is_valid())
        none = np.zeros(len(names.dictionary), np.int64)
        none[source] = table.column("none").to_numpy()
        block = np.zeros(len(none), np.int64)
        block[source] = table.column("own").to_numpy()
        p = np.repeat(none[None], len(terms.dictionary), axis=0)
        p[terms.indices.drop_null().to_numpy(), source[there]] = table.column("p").to_numpy()[there]
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        first, second, value, rest = [], [], [], []
        for i in range(len(none)):
            others = np.flatnonzero((block == (low + high - block[i])) & (np.arange(len(none)) != i))
            first.append(np.full(len(others), i))
            second.append(others)
            value.append(((p[:, i, None] - p[:, others]) ** 2 // p[:, others]).sum(axis=0))
            rest.append((none[i] - none[others]) ** 2 // none[others])
        first, second, value, rest = map(np.concatenate, (first, second, value, rest))
        n = len(first)
        return pa.table({
            "lang": pa.array([table.column("lang")[0].as_py()] * n, pa.string()),
            "source": names.dictionary.take(pa.array(first)), "item": names.dictionary.take(pa.array(second)),
            "value": pa.array(value.astype(np.int64)), "seen": pa.array(np.full(n, len(p), np.int64)),
            "rest": pa.array(rest.astype(np.int64)), "terms": pa.array([table.column("terms")[0].as_py()] * n, pa.int64())})

    parts = placed.groupBy("lang", "term_block", "low", "high").applyInArrow(
        compared, "lang string, source string, item string, value long, seen long, rest long, terms long")
    added = parts.groupBy("lang", "source", "item").agg(
        (F.sum("value") + (F.max("terms") - F.sum("seen")) * F.max("rest")).alias("value"))
    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return added.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(first).alias("rank"))
