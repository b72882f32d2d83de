import random

import pytest
from brute import near_duplicates as brute

from lamina.llm import minhash
from lamina.llm.components import components


def table(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


@pytest.mark.parametrize("words", [2, 5])
def test_against_all_pairs(spark, docs, words):
    rng = random.Random(words)
    vocabulary = [f"w{i}" for i in range(60)]
    rows, number = [], 0
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.choice([4, 12, 40, 200]))
        for _ in range(rng.choice([1, 2, 9])):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 30))):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            number += rng.randint(1, 3)
            rows.append((number, " ".join(own)))
    rng.shuffle(rows)
    assert table(minhash.near_duplicates(docs(*rows), words, 80)) == brute(rows, words, 80)


def test_chains_are_one_component(spark, docs):
    """Each text is like the next one only; the largest bucket has no centre like all."""
    words = [f"w{i}" for i in range(140)]
    rows = [(50 - k, " ".join(words[k * 3: k * 3 + 60])) for k in range(20)]
    got = table(minhash.near_duplicates(docs(*rows), 2, 80))
    assert got == brute(rows, 2, 80)
    assert {c for _, c, _ in got.values()} == {31}


def test_edge_rows(spark, docs):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "a b"), (7, "A\u000bB "), (8, "é É"), (9, "x " * 30_000), (10, "x x"),
            (None, "a b"), (11, "one")]
    got = table(minhash.near_duplicates(docs(*rows), 2, 80))
    assert got == brute([r for r in rows if r[0] is not None], 2, 80)


def test_repeated_rows_and_empty_table(spark, docs):
    df = docs((1, "a b c"), (1, "a b c"), (2, "a b c"))
    rows = sorted((r["doc_id"], r["component_id"]) for r in minhash.near_duplicates(df, 2, 80).collect())
    assert rows == [(1, 1), (1, 1), (2, 1)]
    assert minhash.near_duplicates(df.limit(0), 2, 80).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
