import math

import numpy as np

from lamina.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int, list int, part int, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in rows], SCHEMA)


def exact(rows, asked, k):
    rows = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    out = {}
    for i, v in rows:
        if asked(i):
            near = sorted((float(np.sqrt(((v - w) ** 2).sum())), j) for j, w in rows if j != i)[:k]
            out[i] = near
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 24))
    data = np.concatenate([centres[rng.integers(0, 12, 1500)] + rng.normal(size=(1500, 24)) * 0.4, rng.normal(size=(300, 24))])
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    df = frame(spark, rows).repartition(4)
    got, want = found(ann.nearest(df, df.where("vec_id % 20 = 0"))), exact(rows, lambda i: i % 20 == 0, 10)
    assert got.keys() == want.keys()
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.95 * 10 * len(want)
    for q, near in got.items():
        assert near == sorted(near)
        for d, i in near:
            assert math.isclose(d, float(np.linalg.norm(np.float32(data[q]).astype(float) - np.float32(data[i]).astype(float))), rel_tol=1e-12)


def test_equal_vectors_and_bad_rows(spark):
    same = [1.0, 2.0, 0.5]
    rows = [(i, same) for i in range(700)] + [(1000 + i, [float(i + 1), 0.0, 1.0]) for i in range(20)]
    bad = [(2000, None), (2001, [0.0, 0.0, 0.0]), (2002, [1.0, None, 1.0]), (2003, [float("nan"), 1.0, 1.0]),
           (2004, [float("inf"), 1.0, 1.0]), (2005, []), (2006, [1.0, 2.0]), (None, same)]
    df = frame(spark, rows + bad + rows[:3]).repartition(5)
    got = found(ann.nearest(df, df.where("vec_id in (0, 5, 300, 1000, 2000, 2001, 2003)")))
    assert got == exact(rows, lambda i: i in (0, 5, 300, 1000), 10)


def test_few_candidates_and_empty_tables(spark):
    df = frame(spark, [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0])])
    assert {q: [i for _, i in near] for q, near in found(ann.nearest(df, df)).items()} == {1: [3, 2], 2: [3, 1], 3: [1, 2]}
    none = df.limit(0)
    assert ann.nearest(none, df).count() == 0 and ann.nearest(df, none).count() == 0
    assert ann.nearest(df.limit(1), df.limit(1)).count() == 0
