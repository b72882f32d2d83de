"""Source divergence against its definition."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from harness.compare import open_duckdb
from lamina.llm import divergence, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, key string, n int, terms long, item int"


def plain(rows, support=3, shown=200):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))) for text, lang, source in rows]
    held, counts, groups = Counter(), defaultdict(Counter), defaultdict(set)
    for lang, source, terms in docs:
        held.update((lang, t) for t in set(terms))
        counts[lang, source].update(terms)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for (own, t), n in held.items() if own == lang and n >= support]

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (total + len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            far = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            above = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", far, None), ("term", above, shown)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


def got(spark, rows, **more):
    frame = spark.createDataFrame([(k, *r, "x", 1, 2, 3) for k, r in enumerate(rows)], SCHEMA).repartition(3)
    found = divergence.divergence(frame, **more)
    assert found.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    return sorted(tuple(r) for r in found.collect())


LONG = "x" * 5000
ODD = [
    ("the Cat sat", "en", "a"), ("the cat SAT sat", "en", "b"), ("the dog", "en", None), ("THE cat", "en", "a"), ("the cat", "en", "a"),
    (None, "en", "c"), ("", "en", "d"), ("12 34 _-", "en", "e"), ("alone words here", "fr", "a"), ("other ones", "fr", "b"),
    ("Éa éa ÉA straße 漢字漢字 a1b", None, None), ("Éa éa 漢字漢字 a", "", "a"), ("Éa 漢字漢字 éa b", None, "b"),
    *[(f"{LONG} {LONG}{k} {LONG}end abcd abcdefgh abcdefghi prefix{'y' * k}", "de", f"s{k % 3}") for k in range(5)],
    ("same row", "es", "z"), ("same row", "es", "z"), ("same row", "es", "z"), ("same", "es", "y"),
]


@pytest.mark.parametrize("small", [False, True])
def test_odd_rows(spark, monkeypatch, small):
    if small:  # many slices, blocks and levels, and a bit table that lets nearly all through
        for name, value in (("SLICE_BYTES", 40), ("BLOCK_TERMS", 2), ("BLOCK_SOURCES", 2), ("FIRST_LEVEL", 1), ("TABLE_BITS", 6)):
            monkeypatch.setattr(divergence, name, value)
    assert got(spark, ODD) == plain(ODD)


def test_random_corpus_of_many_sources(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 16)
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", 4)
    rng = random.Random(8)
    words = ["".join(rng.choices("abcé", k=rng.randint(1, 7))) for _ in range(120)]
    rows = [(" ".join(rng.choices(words, k=rng.randint(0, 40))), rng.choice(["en", "fr"]), rng.choice(["hot"] * 6 + [f"s{k}" for k in range(12)]))
            for _ in range(150)]
    for support, shown in ((3, 200), (20, 5), (10**6, 5)):
        assert got(spark, rows, support=support, shown=shown) == plain(rows, support, shown)


def test_no_documents(spark):
    assert got(spark, [("a", "b", "c")][:0] or [(None, None, None)]) == []
    frame = spark.createDataFrame([], SCHEMA)
    assert divergence.divergence(frame).collect() == []


def test_kept_terms_are_discarded_by_prefix(spark):
    """Only what a level's prefixes let through reaches the next level."""
    rows = [(w, "en", "s") for w in ("abcdxx1", "abcdxxq", "abcdxxr", "abcdxxs", "zzzzzzzz", "zzzzzzzz")]
    frame = spark.createDataFrame([(0, *r, "x", 1, 2, 3) for r in rows], SCHEMA)
    first = divergence._level(divergence.corpus(frame), spark, None, 0, 4).groupBy("key", "done").sum("n_docs").collect()
    assert {(bytes(k), done, n) for k, done, n in first} == {(b"abcd", False, 4), (b"zzzz", False, 2)}
    stayed = divergence.bit_table(spark.createDataFrame([("en", b"abcd")], "lang string, key binary"), 1)
    second = divergence._level(divergence.corpus(frame), spark, stayed, 4, 8).collect()
    assert {bytes(r["key"]) for r in second} == {b"abcdxx", b"abcdxxq", b"abcdxxr", b"abcdxxs"}


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    frame = queries.op13_source_divergence(spark, folder)
    columns = sorted(frame.columns)
    result = open_duckdb(folder).execute(queries.ORACLE_SQL["op13_source_divergence"])
    order = [[d[0] for d in result.description].index(c) for c in columns]
    assert sorted(tuple(r) for r in frame.select(*columns).collect()) == sorted(tuple(r[i] for i in order) for r in result.fetchall())


def test_terms_of_sixteen_bytes_take_one_pass(spark, monkeypatch):
    passes, level = [], divergence._level
    monkeypatch.setattr(divergence, "_level", lambda *args: (passes.append(args[-1]), level(*args))[1])
    texts = ["abcdefghijklmnop tenletters short", "tenletters short", "abcdefghijklmnop short", "abcdefghijklmnop tenletters"]
    kept = divergence.kept_terms(spark.createDataFrame([(t, "en", "s") for t in texts], "text string, lang string, source string"))
    assert sorted((bytes(r["key"]), r["n_docs"]) for r in kept.collect()) == [(b"abcdefghijklmnop", 3), (b"short", 3), (b"tenletters", 3)]
    assert passes == [16]


def test_a_later_level_hashes_its_longer_terms_alone():
    texts = ["a bb CCCC", "", None, "dddd bb,cccc", "é", "eeééé a"]
    part = next(divergence.slices(pa.array(texts, pa.string()), 1 << 20))
    terms, code, row = divergence._terms(part, 3)
    assert [(terms[int(c)].as_py(), int(r)) for c, r in zip(code, row)] == [
        (b"cccc", 0), (b"dddd", 3), (b"cccc", 3), ("eeééé".encode(), 5)]
    assert terms.to_pylist() == [b"cccc", b"dddd", "eeééé".encode()]
    assert not len(divergence._terms(part, 100)[1])
