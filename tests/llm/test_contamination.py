import random

from brute import contamination as brute

from lamina.llm import decontam


def found(docs_df, items_df, window=13):
    return sorted((r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"])
                  for r in decontam.contamination(docs_df, items_df, window).collect())


def items(spark, *rows):
    return spark.createDataFrame(list(rows), "item_id long, text string").withColumnRenamed("x", "y")


def test_against_brute_force(spark, docs, no_broadcast, monkeypatch):
    rng = random.Random(1)
    words = [f"W{i}" for i in range(25)]
    bench = [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 3, 12, 13, 14, 40])))) for i in range(30)] + [(None, "w1 w2"), (77, None)]
    rows = []
    for i in range(80):
        parts = rng.choices(words, k=rng.randint(0, 120))
        if i % 2:
            own = (bench[rng.randrange(30)][1] or "").split()
            at = rng.randrange(len(parts) + 1)
            parts[at:at] = own[: rng.randint(0, len(own))]
        rows.append((i, rng.choice([" ", ", ", "\n--"]).join(parts)))
    want = brute(rows, bench, 13)
    assert any(r[4] for r in want) and any(r[2] for r in want)
    assert found(docs(*rows), items(spark, *bench)) == want
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    assert found(docs(*rows), items(spark, *bench)) == want


def test_long_items_only(spark, docs):
    words = [f"a{i}" for i in range(40)]
    bench = [(1, " ".join(words[:30])), (2, " ".join(words[10:25])), (2, " ".join(words[10:25]))]
    rows = [(i, " ".join(["x"] * i + words[i: i + n] + ["y"] * 20)) for i, n in ((0, 12), (1, 13), (2, 14), (5, 30))]
    assert found(docs(*rows), items(spark, *bench)) == brute(rows, bench, 13)


def test_edge_rows(spark, docs):
    rows = [(1, None), (2, ""), (3, "!?"), (4, "ÄÖ äö é"), (5, "a " * 20_000), (None, "a")]
    bench = [(9, "a"), (10, "ä"), (3, "Äö"), (4, "é")]
    assert found(docs(*rows), items(spark, *bench)) == brute([r for r in rows if r[0] is not None], bench, 13)
    assert found(docs(*rows), items(spark)) == brute([r for r in rows if r[0] is not None], [], 13)
    assert found(docs(*rows).limit(0), items(spark, *bench)) == []


def test_rows_of_one_doc_id_and_repeated_rows(spark, docs):
    """Every row comes back, judged by its own text."""
    bench = [(1, "one two three four")]
    rows = [(1, "one two three four"), (1, "clean words here"), (1, "clean words here"), (2, "one two three four"), (2, "one two three four"), (3, None), (3, None)]
    want = brute(rows, bench, 13)
    assert len(want) == 7 and found(docs(*rows), items(spark, *bench)) == want
    keyed = decontam.contamination(docs(*rows), items(spark, *bench), with_keys=True).collect()
    assert len({r["row_key"] for r in keyed}) == 4 and len({r["row_key"] for r in keyed if r["contaminated"]}) == 2
