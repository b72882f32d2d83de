"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts the n-grams of all labelled rows, summed up in each task
before the shuffle. The model is a matrix of log-probabilities, `BUCKETS` rows and a
column for each language, so its size is bounded by that; it is broadcast, and
documents are scored in numpy from the sparse counts of their n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.texts import Slice, mix, slices

BUCKETS = 1 << 16
GRAMS = (1, 2, 3)
_STEP = 1 << 19  # code points scored at a time
_BLANK = np.uint32(0x20)


def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _lowered() -> np.ndarray:
    """Lower case of each code point, a blank for what is no letter."""
    out = np.full(0x110000, _BLANK, np.uint32)
    for i in np.flatnonzero(_letters()).tolist():
        low = chr(i).lower()
        out[i] = ord(low) if len(low) == 1 else i
    return out


def _points(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a slice and where each row's begin."""
    starts = np.concatenate([[0], np.cumsum((part.data & 0xC0) != 0x80)])[part.offsets]
    return np.frombuffer(part.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32), starts


def _buckets(points: np.ndarray, starts: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each n-gram that lies in one row and isn't blank throughout, and its row."""
    folded = table[points].astype(np.uint64)
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    solid = folded != 0x20
    keys, rows = [], []
    for n in GRAMS:
        count = len(folded) - n + 1
        if count <= 0:
            continue
        key = folded[:count].copy()
        good = solid[:count].copy()
        for j in range(1, n):
            key = (key << np.uint64(21)) | folded[j: j + count]
            # one blank at an end marks a word's edge; two are nothing new
            good |= solid[j: j + count]
        good &= row[:count] == row[n - 1:]
        if n == 3:
            good &= solid[1: count + 1]
        key, own = key[good], row[:count][good]
        keys.append((mix(key + np.uint64(n << 62 & (1 << 64) - 1 | n * 0x9E3779B9)) >> np.uint64(48)).astype(np.int64))
        rows.append(own)
    none = np.zeros(0, np.int64)
    return np.concatenate(keys or [none]), np.concatenate(rows or [none])


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # BUCKETS x languages, log-probabilities
    prior: np.ndarray


def train(labelled: DataFrame, smoothing: float = 0.1) -> Model:
    """Fit on `text`, `lang`; rows without a language are left out, null texts count for the prior only."""
    def rows(sums: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for name, counts in sums.items():
            there = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([
                pa.array([name] * len(there), pa.string()), pa.array((there - 1).astype(np.int32)),
                pa.array(counts[there])], ["lang", "bucket", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, sums = _lowered(), {}
        for batch in batches:
            for part in slices(batch.column("text")):
                langs = batch.column("lang").slice(part.first, len(part)).dictionary_encode()
                code = langs.indices.to_numpy()
                bucket, row = _buckets(*_points(part), table)
                for k, name in enumerate(langs.dictionary.to_pylist()):
                    own = sums.setdefault(name, np.zeros(BUCKETS + 1, np.int64))  # place 0: documents
                    own[1:] += np.bincount(bucket[code[row] == k], minlength=BUCKETS)
                    own[0] += int((code == k).sum())
                if len(sums) > 64:
                    yield from rows(sums)
                    sums = {}
        yield from rows(sums)

    known = labelled.where("lang is not null").select("lang", "text")
    summed = known.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = summed.toArrow().to_pandas()  # BUCKETS + 1 rows a language at most
    languages = sorted(found["lang"].unique().tolist())
    counts, prior = np.zeros((BUCKETS, len(languages))), np.zeros(len(languages))
    for k, name in enumerate(languages):
        own = found[found["lang"] == name]
        grams = own[own["bucket"] >= 0]
        counts[grams["bucket"], k] = grams["n"]
        prior[k] = own[own["bucket"] < 0]["n"].sum()
    weights = np.log(counts + smoothing) - np.log(counts.sum(axis=0) + smoothing * BUCKETS)
    return Model(languages, weights.astype(np.float32), np.log(prior) - np.log(max(1.0, prior.sum())))


def predict(docs: DataFrame, model: Model, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Adds `lang_pred` and `score`, its posterior probability, to `columns`.

    A text that is null or has no letter, or a model without languages, gives `und` and 0.
    All n-grams of the whole text count.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, table = shared.value, _lowered()
        names = np.array([*own.languages, "und"], dtype=object)
        for batch in batches:
            for part in slices(batch.column("text"), _STEP):
                points, starts = _points(part)
                total = np.zeros((len(part), len(own.languages)))
                letters = np.add.reduceat(np.append(table[points] != _BLANK, False), starts[:-1], dtype=np.int64) \
                    if len(points) else np.zeros(len(part), np.int64)
                letters[np.diff(starts) == 0] = 0
                bucket, row = _buckets(points, starts, table)
                # sparse counts of (row, bucket), then one product for each
                cell, counts = np.unique(row * BUCKETS + bucket, return_counts=True)
                r = cell >> 16
                for k in range(len(own.languages)):
                    total[:, k] = np.bincount(r, own.weights[cell & (BUCKETS - 1), k] * counts, minlength=len(part))
                best, sure = np.full(len(part), len(own.languages)), np.zeros(len(part))
                if own.languages:
                    total += own.prior
                    best = total.argmax(axis=1)
                    sure = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                none = letters == 0
                best[none], sure[none] = len(own.languages), 0
                out = [batch.column(c).slice(part.first, len(part)) for c in columns]
                yield pa.RecordBatch.from_arrays(
                    [*out, pa.array(names[best], pa.string()), pa.array(sure)], [*columns, "lang_pred", "score"])

    kinds = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", lang_pred string, score double"
    return docs.select(*columns, "text").mapInArrow(score, schema)
