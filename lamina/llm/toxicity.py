"""Toxicity: a weighted lexicon, matched by Aho-Corasick in folded texts.

Folding lowers case, drops marks and invisible signs, and turns look-alike letters and, inside
words, digits and signs that stand for letters into those letters.

The lexicon is learned from labelled rows: words, and beginnings of words, that
are frequent in toxic documents and rare in others, with their log-odds as weights. Exception
phrases are pairs of neighbouring words around a term which occur in clean documents only;
a term within one doesn't count. A document's measure is the sum of the weights of its matches divided by
a slowly growing function of its length; the labelled rows give the measure from which
toxic documents prevail.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.store import saved

#: Fixed: letters of other scripts that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ғ": "f", "ɡ": "g", "һ": "h", "і": "i", "ј": "j",
    "к": "k", "ӏ": "l", "м": "m", "п": "n", "о": "o", "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t",
    "ц": "u", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "γ": "y", "ω": "w", "ı": "i", "ʟ": "l", "ɴ": "n", "ʀ": "r", "ѐ": "e", "ё": "e",
}
#: Fixed: digits and signs that stand for letters inside words.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"}
PREFIXES = range(4, 9)
MAX_TERMS = 20_000  # of the lexicon and of the exceptions: the broadcast model is bounded by this

_SUBSTITUTE = re.compile(
    r"(?<=[^\W\d_])[0134578@$!|]+(?=[^\W\d_])"  # between letters
    r"|(?<![\w@$])[013457@$]+(?=[^\W\d_][\w@$!|]*[^\W\d_])")  # before the first of several
_WORD = re.compile(r"[^\W_]+")


class _Table(dict):
    """str.translate table, filled as characters come up."""

    def __missing__(self, point: int):
        char = chr(point)
        kind = unicodedata.category(char)
        if kind in ("Cf", "Mn", "Me"):
            out = ""
        else:
            plain = "".join(c for c in unicodedata.normalize("NFKD", char) if unicodedata.category(c) not in ("Mn", "Me"))
            out = "".join(HOMOGLYPHS.get(c, c) for c in plain.lower())
        self[point] = out
        return out


_FOLD = _Table()


def folded(text: str) -> str:
    """Words of folded letters, one blank between them and one at each end."""
    text = text.translate(_FOLD)
    if _SUBSTITUTE.search(text):
        text = _SUBSTITUTE.sub(lambda m: "".join(SUBSTITUTES.get(c, c) for c in m[0]), text)
    return f" {' '.join(_WORD.findall(text))} "


def _terms(words: set[str]) -> Iterator[str]:
    """Patterns a text holds: whole words between blanks, and beginnings of longer ones after a blank."""
    for w in words:
        yield f" {w} "
        for n in PREFIXES:
            if n > len(w):
                break
            yield f" {w[:n]}"


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    threshold: float = 1.0

    def automaton(self):
        out = ahocorasick.Automaton()
        for k, (term, weight) in enumerate(self.weights.items()):
            out.add_word(term, (k, weight, len(term)))
        for phrase in self.exceptions:
            out.add_word(phrase, (-1, 0.0, len(phrase)))
        if len(out):
            out.make_automaton()
        return out


def measure(text: str, automaton) -> tuple[float, int]:
    """Sum of the weights of matches by length, and the number of words.

    At a word the heaviest match counts, and each term once: repeating one says nothing new.
    """
    text = folded(text)
    words = text.count(" ") - 1 if text.strip() else 0
    if not len(automaton) or not words:
        return 0.0, max(0, words)
    hits: dict[int, tuple[float, int]] = {}
    clean: list[tuple[int, int]] = []
    for last, (k, weight, size) in automaton.iter(text):
        start = last + 1 - size
        if k < 0:
            clean.append((start, last))
        elif weight > hits.get(start, (0.0, 0))[0]:
            hits[start] = weight, k
    if clean and hits:
        hits = {s: w for s, w in hits.items() if not any(a <= s < b for a, b in clean)}
    return sum(w for w, _ in set(hits.values())) / (1.0 + math.log1p(words) / 10.0), words


def _term_counts(kind: str, chosen=None):
    """Document counts of terms, summed up for each batch; only `chosen` ones, if given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = chosen.value if chosen is not None else None
        for batch in batches:
            counts: Counter = Counter()
            for text in batch.column("text"):
                if (t := text.as_py()) is not None:
                    own = set(_terms(set(folded(t).split())))
                    counts.update(own if only is None else own & only)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["term", kind])
    return run


def _pairs(terms):
    """Neighbouring words with a term in them, by label: document counts for each batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model({t: 1.0 for t in terms.value}).automaton()
        for batch in batches:
            counts: Counter = Counter()
            for text, toxic in zip(batch.column("text"), batch.column("toxic"), strict=True):
                if (t := text.as_py()) is None or not len(own):
                    continue
                line, seen = folded(t), set()
                for last, (_, _, size) in own.iter(line):
                    start = last + 1 - size
                    stop = line.find(" ", start + 1)
                    before, after = line.rfind(" ", 0, start), line.find(" ", stop + 1)
                    if before >= 0:
                        seen.add(line[before: stop + 1])
                    if after >= 0:
                        seen.add(line[start: after + 1])
                counts.update((p, toxic.as_py()) for p in seen)
            yield pa.RecordBatch.from_arrays([
                pa.array([p for p, _ in counts], pa.string()), pa.array([x for _, x in counts], pa.int64()),
                pa.array(list(counts.values()), pa.int64())], ["phrase", "toxic", "n"])
    return run


def labelled(docs: DataFrame, labels: DataFrame, rows: int = 200_000) -> DataFrame:
    """`doc_id`, `text`, `toxic` of about `rows` labelled documents at most, chosen by a hash of doc_id.

    The chosen labels (16 bytes a row) are bounded by `rows`, so they are broadcast and no text is shuffled.
    Of several labels of a document the larger counts.
    """
    known = (labels.where("doc_id is not null and toxic in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max("toxic").cast("long").alias("toxic")))
    total = known.count()
    if total > rows:
        known = known.where(F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1_000_000)) < int(1_000_000 * rows / total))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id")


def train(labelled: DataFrame, support: int = 3, odds: float = 8.0, evidence: float = 24.0) -> Model:
    """Fit on `doc_id`, `text`, `toxic` (0 or 1; other labels are left out).

    The rows are written once to the shared folder. A quarter of them, by a hash of doc_id, is
    kept from the lexicon to set the threshold. A term needs `support` toxic documents (and one
    in a thousand), `odds` times its share among clean ones, and `evidence` in a likelihood ratio
    test, so that rare words don't get in by chance.
    """
    spark = labelled.sparkSession
    known = saved(labelled.where("toxic in (0, 1)").select("doc_id", "text", F.col("toxic").cast("long").alias("toxic")))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if not sizes.get(1):
        return Model()
    spare = F.pmod(F.xxhash64("doc_id", F.lit("spare")), F.lit(4)) == 0
    everything, held, known = known, known.where(spare), known.where(~spare)
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    toxic, clean = max(1, sizes.get(1, 0)), max(1, sizes.get(0, 0))
    least = max(support, toxic // 1000)
    a = (known.where("toxic = 1").mapInArrow(_term_counts("n"), "term string, n long")
         .groupBy("term").agg(F.sum("n").alias("n")).where(f"n >= {least}"))
    in_toxic = {r["term"]: r["n"] for r in a.collect()}  # at most 1000 x terms of a document
    chosen = spark.sparkContext.broadcast(frozenset(in_toxic))
    b = (known.where("toxic = 0").mapInArrow(_term_counts("n", chosen), "term string, n long")
         .groupBy("term").agg(F.sum("n").alias("n")))
    in_clean = {r["term"]: r["n"] for r in b.collect()}
    weights = {}
    for term, n in in_toxic.items():
        ratio = ((n + 0.5) / (toxic + 1)) / ((in_clean.get(term, 0) + 0.5) / (clean + 1))
        if ratio >= odds and _evidence(n, in_clean.get(term, 0), toxic, clean) >= evidence:
            weights[term] = math.log(ratio)
    # A longer beginning or a word says nothing new where a shorter one says as much.
    for term in sorted(weights, key=len, reverse=True):
        stem = term.rstrip(" ")
        if any(weights.get(stem[:n + 1], 0) >= weights[term] - 0.7 for n in PREFIXES if n + 1 < len(term)):
            weights[term] = 0.0
    weights = dict(sorted(((t, w) for t, w in weights.items() if w), key=lambda x: (-x[1], x[0]))[:MAX_TERMS])
    model = Model(weights)
    phrases = (known.mapInArrow(_pairs(spark.sparkContext.broadcast(list(weights))), "phrase string, toxic long, n long")
               .groupBy("phrase").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
                                      F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good"))
               .where(f"good >= {support} and bad = 0").orderBy(F.desc("good"), "phrase").limit(MAX_TERMS))
    model.exceptions = [r["phrase"] for r in phrases.collect()]
    held = held if not held.where("toxic = 1").isEmpty() else everything
    measured = _measured(held, model, ("toxic",)).select("toxic", F.round("measure", 2).alias("m"))
    seen = sorted((r["m"], r["toxic"], r["n"]) for r in
                  measured.groupBy("toxic", "m").agg(F.count("*").alias("n")).collect())  # some hundred values
    model.threshold = _threshold(seen, sum(n for _, label, n in seen if label == 1))
    return model


def _evidence(bad: int, good: int, toxic: int, clean: int) -> float:
    """Likelihood ratio statistic of a term's document counts against its being spread evenly."""
    share = (bad + good) / (toxic + clean)
    return 2 * sum(n * math.log(n / (share * size)) for n, size in ((bad, toxic), (good, clean)) if n)


def _threshold(seen: list[tuple[float, int, int]], toxic: int) -> float:
    """The measure at which the labelled rows are told apart best (F1), half-way to the next one below."""
    values = sorted({m for m, _, _ in seen}, reverse=True)
    count = Counter()
    for m, label, n in seen:
        count[m, label] += n
    best, where, hit, wrong = -1.0, 1.0, 0, 0
    for i, m in enumerate(values):
        if m <= 0:
            break
        hit, wrong = hit + count[m, 1], wrong + count[m, 0]
        f1 = 2 * hit / (hit + wrong + toxic)
        if f1 > best:
            below = values[i + 1] if i + 1 < len(values) else 0.0
            best, where = f1, (m + max(0.0, below)) / 2
    return where


def _measured(docs: DataFrame, model: Model, columns: tuple[str, ...]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value.automaton()
        for batch in batches:
            found = [measure(t.as_py() or "", automaton) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array([m for m, _ in found], pa.float64()),
                 pa.array([n for _, n in found], pa.int64())], [*columns, "measure", "n_words"])

    kinds = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", measure double, n_words long"
    return docs.select(*columns, "text").mapInArrow(run, schema)


def score(docs: DataFrame, model: Model, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`columns`, `measure`, `n_words`, `score` (0 to 1) and `predicted` (1 from 0.5).

    score = measure / (measure + threshold). Null, empty and wordless texts have measure 0 and score 0.
    """
    found = _measured(docs, model, columns)
    value = F.col("measure") / (F.col("measure") + F.lit(float(model.threshold)))
    return found.withColumn("score", value).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
