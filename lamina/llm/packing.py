"""Pack tokenised documents into fixed-size sequences by bin completion.

Only lengths matter to the packing, and there are at most `capacity` of them. So
the corpus is reduced to a histogram of lengths (at most `capacity` rows, whatever
the input's size), the packing is a short list of patterns with multiplicities
over that histogram, and each piece finds its place by its number among the
pieces of its length: joins and offsets, nothing passes through one task.

Bin completion: the largest length left opens a bin; undominated fillings of the
rest of that bin are enumerated, fullest first; each is tried with as many copies
as the histogram allows. Depth-first search keeps the best packing so far,
which starts as best-fit decreasing, and cuts a branch once its waste leaves
no better packing possible. It ends when the lower bound is met or after `nodes` nodes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.bpe import Encoder
from lamina.llm.store import documents, saved
from lamina.llm.texts import lists, slices

#: A pattern: lengths with the number of pieces of each, and how many sequences look like that.
Pattern = tuple[tuple[tuple[int, int], ...], int]

_FILLINGS = 6  # branches at a node
_PARTS = 5  # pieces a filling adds, beyond which it goes on greedily


def best_fit(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Best-fit decreasing on a histogram: each length goes to the fullest bins that have room."""
    rooms: list[list[Pattern]] = [[] for _ in range(capacity + 1)]
    rooms[capacity] = [((), -1)]  # any number of empty bins
    for size in range(capacity, 0, -1):
        left = int(counts[size])
        room = size
        while left:
            while not rooms[room]:
                room += 1
            items, copies = rooms[room].pop()
            each = min(room // size, left)
            used = left // each if copies < 0 else min(copies, left // each)
            left -= used * each
            rooms[room - each * size].append(((*items, (size, each)), used))
            if copies < 0:
                rooms[room].append((items, copies))
            elif copies > used:
                rooms[room].append((items, copies - used))
            room = size
    return [p for group in rooms for p in group if p[1] > 0]


def _fillings(counts: np.ndarray, room: int) -> list[tuple[int, ...]]:
    """Some undominated ways to fill `room`, fullest first, then with few large pieces.

    A filling is dominated if pieces of it can give way to one larger piece that
    is there: what can be done with the small pieces later can only be better.
    """
    sizes = np.flatnonzero(counts[: room + 1])
    if not len(sizes):
        return [()]
    found: list[tuple[int, ...]] = []
    budget = [400]

    def extend(items: tuple[int, ...], left: int, top: int) -> None:
        if budget[0] <= 0 or len(found) >= 4 * _FILLINGS:
            return
        budget[0] -= 1
        at = int(np.searchsorted(sizes, min(left, top), side="right")) - 1
        if left == 0 or at < 0:
            found.append(items)
            return
        tried = 0
        # A last piece that fills the rest comes first, else the larger ones.
        while at >= 0 and tried < _FILLINGS:
            size = int(sizes[at])
            if items.count(size) < counts[size]:
                tried += 1
                if len(items) + 1 < _PARTS or size == left or tried == 1:
                    extend((*items, size), left - size, size)
            at -= 1
        if not tried:
            found.append(items)

    extend((), room, room)

    def dominated(items: tuple[int, ...]) -> bool:
        slack = room - sum(items)
        if len(items) > 8:
            return False
        for k in range(1, len(items) + 1):
            for some in combinations(items, k):
                low = sum(some) + (k == 1)
                for size in sizes[np.searchsorted(sizes, low): np.searchsorted(sizes, sum(some) + slack, side="right")]:
                    if counts[size] > items.count(int(size)) and not (k > 1 and size in some):
                        return True
        return False

    found = sorted(set(found), key=lambda x: (room - sum(x), len(x), tuple(-i for i in x)))
    best = [x for x in found if not dominated(x)] or found[:1]
    return best[:_FILLINGS]


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: large pieces can't share, small ones fill only what those leave."""
    sizes = np.arange(capacity + 1, dtype=np.int64)
    volume = counts * sizes
    half = capacity // 2
    best = -(-int(volume.sum()) // capacity)
    for a in range(1, half + 1):
        alone = int(counts[capacity - a + 1:].sum())
        wide = slice(half + 1, capacity - a + 1)
        room = int(counts[wide].sum()) * capacity - int(volume[wide].sum())
        rest = max(0, int(volume[a: half + 1].sum()) - room)
        best = max(best, alone + int(counts[wide].sum()) + -(-rest // capacity))
    return best


def bin_completion(counts: np.ndarray, capacity: int, nodes: int = 5_000) -> list[Pattern]:
    """Patterns that hold `counts[length]` pieces of each length in as few bins as the search finds."""
    best = best_fit(counts, capacity)
    fewest = sum(c for _, c in best)
    weights = np.arange(capacity + 1, dtype=np.int64)
    bound = lower_bound(counts, capacity)
    left, path, used = counts.astype(np.int64).copy(), [], 0
    stack: list[list[tuple[int, ...]]] = []

    def undo() -> None:
        nonlocal used
        items, copies = path.pop()
        for size, each in items:
            left[size] += each * copies
        used -= copies

    total = int((left * weights).sum())
    while fewest > bound and nodes > 0:
        nodes -= 1
        if used + -(-total // capacity) < fewest:  # the waste so far allows a better packing
            if total == 0:
                best, fewest = list(path), used
                continue
            size = int(np.flatnonzero(left)[-1])
            left[size] -= 1
            stack.append([(size, *x) for x in _fillings(left, capacity - size)][::-1])
            left[size] += 1
        else:
            if not path:
                break
            total += sum(s * e for s, e in path[-1][0]) * path[-1][1]
            undo()
        while stack and not stack[-1]:
            stack.pop()
            if path and len(path) > len(stack) - 1 and stack:
                total += sum(s * e for s, e in path[-1][0]) * path[-1][1]
                undo()
        if not stack:
            break
        chosen = stack[-1].pop()
        items = tuple((s, chosen.count(s)) for s in sorted(set(chosen), reverse=True))
        copies = min(int(left[s]) // e for s, e in items)
        for s, e in items:
            left[s] -= e * copies
        total -= sum(s * e for s, e in items) * copies
        used += copies
        path.append((items, copies))
    return best


def _pieces(file: str, rank_file: str | None, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(file, rank_file)
        for batch in batches:
            keys, ids = batch.column("row_key").to_pylist(), batch.column("doc_id").to_pylist()
            for part in slices(batch.column("text")):
                flat, counts = encoder.encode(part)
                flat = flat.astype("<u4")
                out: list[tuple] = []
                tokens = []
                at = 0
                for i, n in enumerate(counts.tolist()):
                    own = np.append(flat[at: at + n], np.uint32(end_id)).astype("<u4")
                    at += n
                    cuts = [0, *range(len(own) % capacity or capacity, len(own) + 1, capacity)]
                    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                        out.append((keys[part.first + i], ids[part.first + i], k, a, b - a, zlib.crc32(own[a:b].tobytes())))
                        if with_ids:
                            tokens.append(own[a:b])
                names = ["row_key", "doc_id", "piece", "start", "length", "ids_crc32"]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                columns = [pa.array([r[j] for r in out], kind) for j, kind in enumerate(kinds)]
                if with_ids:
                    columns.append(lists(np.concatenate(tokens).astype(np.int32), np.array([len(t) for t in tokens])))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)
    return run


def pack(df: DataFrame, file: str, rank_file: str | None = None, capacity: int = 1024, end_id: int = 2,
         with_ids: bool = False) -> DataFrame:
    """Cut and pack all documents into sequences of at most `capacity` tokens.

    A document is its token ids and `end_id`. Only longer ones are cut, into pieces of
    `capacity`; the remainder comes first. Returns doc_id, piece, start, length,
    ids_crc32, sequence_id, offset and, `with_ids`, the ids themselves.

    A null or empty text is a document of `end_id` alone. Rows without a doc_id
    are left out; rows repeated whole are documents of their own.
    """
    schema = "row_key long, doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    pieces = saved(documents(df).mapInArrow(_pieces(file, rank_file, capacity, end_id, with_ids), schema))
    spark = df.sparkSession
    counts = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most `capacity` rows
        counts[row["length"]] = row["count"]
    slots, sequence, numbered = [], 0, np.zeros(capacity + 1, np.int64)
    for items, copies in bin_completion(counts, capacity):
        offset = 0
        for size, each in items:
            low = int(numbered[size])
            numbered[size] += each * copies
            slots.append((size, low, int(numbered[size]), each, sequence, offset))
            offset += each * size
        sequence += copies
    if not (numbered == counts).all():
        raise AssertionError("the packing doesn't hold all pieces")
    places = spark.createDataFrame(slots, "length long, low long, high long, each long, first long, base long")

    # Numbers within a length: in buckets by hash, so that no length is one task's.
    buckets = int(counts.sum()) // 50_000 + 1
    spread = pieces.withColumn("bucket", F.pmod(F.xxhash64("row_key", "piece"), F.lit(buckets)))
    before = (spread.groupBy("length", "bucket").count().withColumn(
        "before", F.sum("count").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(
            Window.unboundedPreceding, -1))).select("length", "bucket", F.coalesce("before", F.lit(0)).alias("before")))
    own = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("row_key", "piece"))
    ranked = spread.withColumn("own", own - 1).join(before, ["length", "bucket"]).withColumn(
        "number", F.col("own") + F.col("before"))
    placed = ranked.join(places, "length").where("number >= low and number < high")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first") + F.floor((F.col("number") - F.col("low")) / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("base") + F.pmod(F.col("number") - F.col("low"), F.col("each")) * F.col("length")).alias("offset"),
        *(["ids"] if with_ids else []))
