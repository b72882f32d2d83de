"""Near-duplicate documents: one-permutation MinHash, optimal densification, banded buckets, stars.

A document's set holds the hashes of its distinct shingles of `words` words (of
its whole word sequence, if shorter). Equal sets are one class from the start;
one representative of each goes on, so thousands of exact copies cost one.

One hash of each shingle serves all `BINS` bins: its top bits say the bin, the
smallest hash of a bin is its value. An empty bin takes the value of the first
non-empty one in a random order of its own (optimal densification). `BANDS`
bands of bins are bucket keys; two sets of similarity 0.8 miss each other in all
of them with a probability below 1e-7.

In a bucket the member that meets most others is the centre of a star: n - 1 candidate
edges, not n(n-1)/2. Candidates are confirmed on full sets. A star alone would
lose a link between two members that the centre isn't linked with. So in buckets
whose members still belong to several components, members outside the largest one
are compared with all, in blocks of bounded size; only links are returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.components import components
from lamina.llm.store import documents, saved
from lamina.llm.texts import WINDOW_BYTES, Rolling, Slice, lists, mix, slices, word_bounds, word_codes

BINS, BANDS = 128, 32
BLOCK_ROWS, BLOCK_SHINGLES = 256, 1 << 15  # about the most members, and shingles, of a block


def shingle_sets(part: Slice, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    starts, ends, first = word_bounds(part)
    codes = word_codes(part, starts, ends, lower=True)
    rolling = Rolling(codes)
    every = rolling.windows(words)
    out = []
    for low, high in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if high - low >= words:
            own = np.sort(every[low: high - words + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif high > low:
            out.append(rolling(np.array([low]), np.array([high])))
        else:
            out.append(every[:0])
    return out


@lru_cache(maxsize=1)
def _orders() -> np.ndarray:
    """Row i: the place of each bin in the order in which empty bin i asks the others."""
    noise = mix(np.arange(1, BINS * BINS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return noise.reshape(BINS, BINS).argsort(axis=1).argsort(axis=1)


def band_keys(own: np.ndarray) -> np.ndarray:
    """Bucket keys of a non-empty sorted set."""
    bins = (own >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    there, at = np.unique(bins, return_index=True)  # sorted: the first of a bin is its smallest
    values = np.empty(BINS, np.uint64)
    if len(there) == BINS:
        values[:] = own[at]
    else:
        values[:] = own[at][_orders()[:, there].argmin(axis=1)]
        values[there] = own[at]
    keys = Rolling(mix(values))
    width = BINS // BANDS
    begin = np.arange(0, BINS, width)
    return mix(keys(begin, begin + width) ^ np.arange(BANDS, dtype=np.uint64))


def _signatures(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text"), WINDOW_BYTES):
                sets = shingle_sets(part, words)
                prints = [int(mix(s + np.uint64(len(s))).sum(dtype=np.uint64)) if len(s) else 0 for s in sets]
                bands = [band_keys(s) if len(s) else s for s in sets]
                counts = np.array([len(b) for b in bands])
                yield pa.RecordBatch.from_arrays([
                    batch.column("row_key").slice(part.first, len(part)),
                    batch.column("doc_id").slice(part.first, len(part)),
                    pa.array(np.array([len(s) for s in sets], np.int64)),
                    pa.array(np.array(prints, np.uint64).view(np.int64)),
                    lists(np.concatenate(bands).view(np.int64), counts),
                ], ["row_key", "doc_id", "n_shingles", "print", "bands"])
    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text"), WINDOW_BYTES):
                sets = shingle_sets(part, words)
                yield pa.RecordBatch.from_arrays([
                    batch.column("row_key").slice(part.first, len(part)),
                    lists(np.concatenate(sets).view(np.int64), np.array([len(s) for s in sets])),
                ], ["row_key", "shingles"])
    return run


def _confirmed(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges whose full sets are alike enough: 100 * |a & b| >= percent * |a | b|."""
    a = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb"))
    sizes = edges.join(a, "a").join(b, "b").select(
        "a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"),
        F.size(F.array_intersect("sa", "sb")).alias("both"))
    return sizes.where(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, with_keys: bool = False) -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id`, `n_links`, `kept` for every document.

    `with_keys` adds `row_key` (of `documents`) and `first_key`: the row key of the one row that stands
    for the component, that of its smallest doc_id and, among rows of this doc_id, the smallest.

    Two documents are linked if the sizes of the intersection and the union of
    their sets have `100 * both >= percent * either`; component_id is the smallest
    doc_id that links reach. `n_links` counts the confirmed star edges and the
    equal set that tie a document's class to its component, not all pairs.

    A null or blank text has an empty set and is linked with nothing. Rows without
    a doc_id are left out; rows repeated whole appear as often as given and are one class; two
    rows of one doc_id with different texts are both returned.
    """
    docs = documents(docs)
    signed = saved(docs.mapInArrow(
        _signatures(words), "row_key long, doc_id long, n_shingles long, print long, bands array<long>"))
    full = signed.where("n_shingles > 0")
    classes = full.groupBy("print", "n_shingles").agg(
        F.min(F.struct("doc_id", "row_key")).alias("least"), F.count("*").alias("copies"))
    # `rep` is the class's number: its row key; the order of doc_id decides what is smallest.
    chosen = classes.select(F.col("least.row_key").alias("row_key"))
    buckets = (full.join(chosen, "row_key", "left_semi").dropDuplicates(["row_key"])
               .select("doc_id", F.col("row_key").alias("rep"), F.posexplode("bands").alias("band", "key")))
    shared = buckets.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = saved(buckets.join(shared, "key").select("key", "doc_id", "rep", "n"))
    wanted = members.select(F.col("rep").alias("row_key")).distinct()
    sets = saved(docs.join(wanted, "row_key", "left_semi").mapInArrow(_sets(words), "row_key long, shingles array<long>")
                 .dropDuplicates(["row_key"]).withColumnRenamed("row_key", "rep"))

    links, label = _star_links(members, sets, percent)
    ids = members.select("rep", "doc_id").distinct()
    labelled = label.join(ids, "rep")
    lowest = labelled.groupBy("component").agg(F.min(F.struct("doc_id", F.col("rep").alias("row_key"))).alias("lowest"))
    degree = (links.select(F.col("a").alias("rep")).unionByName(links.select(F.col("b").alias("rep")))
              .groupBy("rep").agg(F.count("*").alias("stars")))
    tied = labelled.join(lowest, "component").join(degree, "rep").select("rep", "lowest", "stars")

    # Only classes with a link or a copy differ from the document itself.
    moved = (classes.select("print", "n_shingles", F.col("least").alias("own"),
                            F.col("least.row_key").alias("rep"), "copies")
             .join(tied, "rep", "left").where("stars is not null or copies > 1")
             .select("print", "n_shingles", F.least("own", F.coalesce("lowest", "own")).alias("lowest"),
                     (F.coalesce("stars", F.lit(0)) + F.when(F.col("copies") > 1, 1).otherwise(0)).alias("n_links")))
    return (signed.join(moved, ["print", "n_shingles"], "left")
            .select("doc_id", "n_shingles", F.coalesce("lowest.doc_id", "doc_id").alias("component_id"),
                    F.coalesce(F.col("n_links"), F.lit(0)).cast("long").alias("n_links"),
                    *([F.col("row_key"), F.coalesce("lowest.row_key", "row_key").alias("first_key")] if with_keys else []))
            .withColumn("kept", F.col("doc_id") == F.col("component_id")))


def _star_links(members: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Confirmed edges that join all that similar members of shared buckets can reach; their components."""
    # The member that meets most others is the likeliest to be like all of them.
    weight = members.groupBy("rep").agg(F.sum("n").alias("weight"))
    centre = members.join(weight, "rep").groupBy("key").agg(F.max_by("rep", F.struct("weight", "rep")).alias("a"))
    edges = (members.join(centre, "key").where("rep <> a")
             .select(F.least("a", "rep").alias("a"), F.greatest("a", "rep").alias("b")).distinct())
    links = saved(_confirmed(edges, sets, percent))
    label = components(links).withColumnRenamed("node", "rep")
    # What the stars left open: buckets of more than one component in which a pair was not compared.
    placed = (members.where("n > 2").select("key", "rep").join(label, "rep", "left")
              .withColumn("component", F.coalesce("component", "rep")))
    sizes = placed.groupBy("key", "component").agg(F.count("*").alias("size"))
    mixed = (sizes.groupBy("key").agg(F.count("*").alias("parts"), F.sum("size").alias("n"),
                                      F.max_by("component", F.struct("size", "component")).alias("main"))
             .where("parts > 1"))
    rest = saved(placed.join(mixed, "key"))
    if rest.isEmpty():
        return links, label
    more = saved(_compared(rest, sets, percent))
    if more.isEmpty():
        return links, label
    links = links.unionByName(more)
    return links, components(links).withColumnRenamed("node", "rep")


def _compared(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components of mixed buckets: each member outside a bucket's main component against all.

    Members meet in blocks of bounded size. A task compares two blocks by a product of
    incidence matrices and returns one link for a member and a component, not all pairs.
    """
    own = rest.join(sets, "rep")
    blocks = own.groupBy("key").agg(F.greatest(
        F.ceil(F.count("*") / F.lit(BLOCK_ROWS)), F.ceil(F.sum(F.size("shingles")) / F.lit(BLOCK_SHINGLES))).alias("blocks"))
    dealt = own.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("rep"), "blocks"))
    row = F.struct("rep", "component", "shingles")
    members = dealt.groupBy("key", "block").agg(F.collect_list(row).alias("members"))
    asking = (dealt.where("component <> main").groupBy("key", "block").agg(F.collect_list(row).alias("asking"))
              .drop("block"))
    return members.join(asking, "key").select("members", "asking").mapInArrow(
        _matched(percent), "a long, b long").distinct()


def _incidence(sizes: np.ndarray, places: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(sizes), width), np.float32)
    out[np.repeat(np.arange(len(sizes)), sizes), places] = 1
    return out


def _matched(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                sides = []
                for name in ("asking", "members"):
                    rows = batch.column(name)[i].values
                    sets = rows.field("shingles")
                    sides.append((rows.field("rep").to_numpy(), rows.field("component").to_numpy(),
                                  np.diff(sets.offsets.to_numpy()), sets.flatten().to_numpy()))
                known, places = np.unique(np.concatenate([s[3] for s in sides]), return_inverse=True)
                (q, qc, qn, qs), (m, mc, mn, _) = sides
                both = _incidence(qn, places[: len(qs)], len(known)) @ _incidence(mn, places[len(qs):], len(known)).T
                both = np.rint(both).astype(np.int64)
                alike = 100 * both >= percent * (qn[:, None] + mn[None, :] - both)
                x, y = np.nonzero(alike & (qc[:, None] != mc[None, :]))
                # One link of a member with a component joins them as well as all.
                _, first = np.unique(np.stack([q[x], mc[y]]), axis=1, return_index=True)
                a, b = q[x[first]], m[y[first]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])
    return run
