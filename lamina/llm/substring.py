"""Recurring passages of words: found and located by anchors, checked by sharded Aho-Corasick automata.

1. Anchors (`recurrence.py`) of all windows, one row for each run of windows. Counting
   runs by anchor and shape gives what recurs as a whole; where an anchor has
   several shapes, the windows of one run for each shape are counted.
2. That confirms, for each document, the stretches whose windows all occur twice.
   Neighbouring ones are one passage. These joins locate every occurrence already;
   the automata below find nothing that they don't give.
3. Passages meet the documents that hold them by key. Each task compiles the
   distinct passages of its share of documents to automata over word numbers
   (pyahocorasick, integer keys), and streams every whole document of the share
   through them. What is covered by a match goes. The passages a share needs are
   routed to it by their anchors, so no automaton holds the whole corpus's and no
   document meets all automata: work grows with the input, not with its square.

Counts are sums and can be combined before the shuffle; hot passages are never
gathered: joins on the anchor are plain sort-merge joins that may be split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.recurrence import runs
from lamina.llm.store import documents, saved
from lamina.llm.texts import WINDOW_BYTES, HashIndex, Rolling, Slice, slices, word_bounds, word_codes

GRAM = 8
SHARE_BYTES = 1 << 19  # of documents whose passages are compiled together
_SHARD_WORDS = 1 << 20  # an automaton is compiled when so many words of passages have come


def _anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text"), WINDOW_BYTES):
                starts, ends, first = word_bounds(part)
                found = runs(word_codes(part, starts, ends, lower=False), first, length, min(GRAM, length))
                row = pa.array(found.row)
                yield pa.RecordBatch.from_arrays([
                    batch.column("row_key").slice(part.first, len(part)).take(row),
                    pa.array(found.start << 12 | found.windows),
                    pa.array(found.spot.view(np.int64)), pa.array(found.shape.view(np.int64)),
                ], ["row_key", "at", "spot", "shape"])
    return run


#: `at` holds a run's start and, in its last 12 bits, the number of its windows.
_ANCHOR = "row_key long, at long, spot long, shape long"
_START, _WINDOWS = "cast(shiftright(at, 12) as int)", "cast(at & 4095 as int)"


def _windows(length: int):
    """Hash of each window of the runs listed with a document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text"), WINDOW_BYTES):
                starts, ends, first = word_bounds(part)
                rolling = Rolling(word_codes(part, starts, ends, lower=False))
                own = batch.column("runs").slice(part.first, len(part))
                flat = own.flatten()
                row = np.repeat(np.arange(len(part)), np.diff(own.offsets.to_numpy()))
                begin, count = (flat.field(x).to_numpy().astype(np.int64) for x in ("start", "windows"))
                spot = flat.field("spot").to_numpy()
                begin, which = begin + first[:-1][row], np.repeat(np.arange(len(row)), count)
                at = begin[which] + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
                yield pa.RecordBatch.from_arrays([
                    batch.column("row_key").slice(part.first, len(part)).take(pa.array(row[which])),
                    pa.array((at - first[:-1][row[which]]).astype(np.int32)), pa.array(spot[which]),
                    pa.array(rolling(at, at + length).view(np.int64)),
                ], ["row_key", "start", "spot", "window"])
    return run


def _covered(passages: list[tuple[int, ...]], texts: list[np.ndarray]) -> list[np.ndarray]:
    """Words of each text that some passage covers; passages go into automata of bounded size."""
    masks = [np.zeros(len(t), bool) for t in texts]
    shard, held = None, 0
    sequences = [tuple(t.tolist()) for t in texts]

    def stream() -> None:
        shard.make_automaton()
        for mask, sequence in zip(masks, sequences, strict=True):
            for last, size in shard.iter(sequence):
                mask[last + 1 - size: last + 1] = True

    for passage in passages:
        if shard is None:
            shard, held = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE), 0
        shard.add_word(passage, len(passage))
        held += len(passage)
        if held >= _SHARD_WORDS:
            stream()
            shard = None
    if shard is not None:
        stream()
    return masks


def _kept(part: Slice, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, removed: np.ndarray) -> pa.Array:
    """The words not removed of each row, joined by one blank, as bytes."""
    s, e = starts[~removed], ends[~removed]
    row = np.repeat(np.arange(len(part)), np.diff(first))[~removed]
    step = np.zeros(len(part.data) + 1, np.int8)
    step[s] += 1
    step[e] -= 1
    stays = np.cumsum(step[:-1], dtype=np.int8) > 0
    seams = e[:-1][row[1:] == row[:-1]]  # the blank after each kept word but a row's last
    stays[seams] = True
    data = part.data.copy()
    data[seams] = 0x20
    where = np.concatenate([[0], np.cumsum(stays)])[part.offsets].astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(part), [None, pa.py_buffer(where), pa.py_buffer(data[stays])])


def _strip(length: int, with_text: bool):
    """Locate the passages of a share of documents and take them out."""
    def one(part, batch, names) -> pa.RecordBatch:
        starts, ends, first = word_bounds(part)
        counts = np.diff(first)
        column = batch.column("spans").slice(part.first, len(part))
        flat, offsets = column.flatten(), column.offsets.to_numpy() - column.offsets[0].as_py()
        begin, stop = (flat.field(x).to_numpy().astype(np.int64) for x in ("start", "stop"))
        removed = np.zeros(len(starts), bool)
        touched = np.flatnonzero(np.diff(offsets))
        if len(touched):
            # Words get numbers of their own in this share; equal numbers are equal words.
            codes = word_codes(part, starts, ends, lower=False)
            index = HashIndex(len(codes))
            distinct = np.unique(codes)
            index.add(distinct, np.arange(len(distinct)))
            number = index.find(codes)
            passages = set()
            for i in touched.tolist():
                base, high = int(first[i]), 0
                low = None
                for s, e in sorted(zip(begin[offsets[i]: offsets[i + 1]].tolist(),
                                       stop[offsets[i]: offsets[i + 1]].tolist(), strict=True)):
                    if low is not None and s <= high - length + 1:  # every window across the seam is confirmed
                        high = max(high, e)
                        continue
                    if low is not None:
                        passages.add(tuple(number[base + low: base + high].tolist()))
                    low, high = s, e
                passages.add(tuple(number[base + low: base + high].tolist()))
            masks = _covered(sorted(passages), [number[first[i]: first[i + 1]] for i in range(len(part))])
            removed = np.concatenate(masks) if masks else removed
        gone = np.concatenate([[0], np.cumsum(removed)])
        n_removed = gone[first[1:]] - gone[first[:-1]]
        kept = _kept(part, starts, ends, first, removed)
        out = [batch.column(x).slice(part.first, len(part)) for x in names]
        out += [pa.array(counts.astype(np.int64)), pa.array(n_removed.astype(np.int64))]
        if with_text:
            out.append(pc.if_else(pa.array(part.null), None, kept.cast(pa.string())))
        out.append(pa.array([hashlib.sha256(k).hexdigest() for k in kept.to_pylist()], pa.string()))
        return pa.RecordBatch.from_arrays(out, [*names, "n_words", "n_removed"] + ["text"] * with_text + ["kept_sha256"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [x for x in batch.schema.names if x not in ("row_key", "text", "spans")]
            for part in slices(batch.column("text"), SHARE_BYTES):
                yield one(part, batch, names)
    return run


def recurring_spans(docs: DataFrame, length: int) -> DataFrame:
    """`row_key`, `spans` (array of start, stop in words): stretches whose windows all occur twice or more."""
    anchors = docs.select("row_key", "text").mapInArrow(_anchors(length), _ANCHOR)
    shapes = anchors.groupBy("spot", "shape").agg(
        F.count("*").alias("n"), F.min("row_key").alias("row_key"), F.min_by("at", "row_key").alias("at"))
    # One row for a spot of several shapes or a shape that occurs twice; the rest recurs nowhere.
    spots = shapes.groupBy("spot").agg(F.count("*").alias("shapes"), F.min("n").alias("least"), F.max("n").alias("most"))
    shapes = saved(shapes.join(spots.where("shapes > 1 or most > 1"), "spot"))
    whole = (anchors.join(shapes.where("n > 1").select("spot", "shape"), ["spot", "shape"])
             .selectExpr("row_key", f"{_START} as start", f"{_START} + {_WINDOWS} + {length - 1} as stop"))
    # Edges of passages: windows of one run of each shape. A shape that occurs twice is a witness.
    edges = (shapes.where("shapes > 1 and least = 1")
             .groupBy("row_key").agg(F.collect_list(F.struct(
                 F.expr(_START).alias("start"), F.expr(_WINDOWS).alias("windows"), "spot")).alias("runs")))
    windows = saved(docs.select("row_key", "text").join(edges, "row_key")
                    .mapInArrow(_windows(length), "row_key long, start int, spot long, window long"))
    twice = windows.groupBy("spot", "window").agg(F.count("*").alias("n")).where("n > 1").select("spot", "window")
    parts = (windows.join(twice, ["spot", "window"])
             .select("row_key", "start", (F.col("start") + F.lit(length)).alias("stop")))
    return whole.unionByName(parts).groupBy("row_key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def remove_recurring(df: DataFrame, length: int = 35, with_text: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Take out every word that a recurring window of `length` words covers.

    Returns doc_id, the columns `keep`, n_words, n_removed, text (kept words joined
    by one blank; null stays null; left out unless `with_text`) and kept_sha256. A window
    recurs if its words also start anywhere else, in the same document too.

    Null and empty texts have no words. Rows without a doc_id are left out. Rows
    repeated whole are separate documents, so their windows recur.
    """
    if not 0 < length < 4096:
        raise ValueError("length must be 1 to 4095")
    docs = documents(df, *keep)
    spans = recurring_spans(docs, length)
    names = ["doc_id", *keep]
    none = F.expr("cast(array() as array<struct<start:int,stop:int>>)")
    joined = (docs.join(spans, "row_key", "left").withColumn("spans", F.coalesce("spans", none)))
    kinds = dict(joined.dtypes)
    schema = ", ".join([f"`{n}` {kinds[n]}" for n in names] + ["n_words long", "n_removed long"]
                       + ["text string"] * with_text + ["kept_sha256 string"])
    return joined.mapInArrow(_strip(length, with_text), schema)
