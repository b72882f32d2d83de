"""Whitening against a dense eigendecomposition."""

import numpy as np
import pytest

from lamina.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, n int, component string, whitened int"


def table(spark, vectors):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], 7, "x", 3) for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def plain(vectors, components=32):
    """n, exact deviations, eigenvalues, eigenvectors, x - mean."""
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1000000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(row, sums, strict=True)] for row in x])
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    return n, deviations, values[::-1][:components], basis[:, ::-1][:, :components], centred


def check(frame, vectors, ids, k):
    n, deviations, values, basis, centred = plain(vectors)
    total = sum(np.linalg.eigvalsh(centred.T @ centred / n))
    got = frame.toPandas()
    assert frame.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"),
                            ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]
    assert len(got) == len(vectors) * k and set(got.n) == {n} and set(got.component) == set(range(1, k + 1))
    for component, part in got.groupby("component"):
        c = component - 1
        part = part.set_index("vec_id").loc[ids]
        assert part.deviation.tolist() == deviations
        assert np.allclose(part.explained, values[c] / total, rtol=1e-9)
        wanted = centred @ basis[:, c] / np.sqrt(values[c])
        sign = np.sign(wanted @ part.whitened.to_numpy())
        assert np.abs(part.whitened - sign * wanted).max() < 1e-8
    assert got.identity_error.max() < 1e-9


@pytest.mark.parametrize("dims", [3, 40, 70])
def test_against_a_dense_decomposition(spark, dims):
    rng = np.random.default_rng(dims)
    vectors = (rng.normal(size=(300, dims)) * np.linspace(1, 4, dims)).astype(np.float32)
    check(whitening.whiten(table(spark, enumerate(vectors))), vectors, list(range(300)), min(dims, 32))


def test_rows_that_take_no_part(spark):
    rng = np.random.default_rng(1)
    good = [list(v) for v in rng.normal(size=(40, 5)).astype(np.float32)]
    odd = [None, [], [1, 2, None, 4, 5], [1, 2, float("nan"), 4, 5], [float("inf"), 0, 0, 0, 0], [1, 2, 3]]
    rows = [*enumerate(good), *enumerate(odd, 100)]
    check(whitening.whiten(table(spark, rows)), good, list(range(40)), 5)


def test_nothing_to_scale(spark):
    for vectors in ([], [None], [[1, 2, 3]], [[1, 2, 3]] * 5):
        assert whitening.whiten(table(spark, enumerate(vectors))).collect() == []


def test_dimensions_without_variance_and_repeated_rows(spark):
    rng = np.random.default_rng(2)
    base = [[a, b, a, 5, 0] for a, b in rng.normal(size=(30, 2)).astype(np.float32)]
    got = whitening.whiten(table(spark, [(7, v) for v in base] + [(None, v) for v in base])).toPandas()
    assert len(got) == 60 * 2 and set(got.n) == {60} and got.vec_id.isna().sum() == 60
    _, deviations, *_ = plain(base + base)
    assert sorted(got[got.component == 1].deviation) == sorted(deviations)


def test_large_entries_count_exactly(spark):
    for vectors in ([[9e6, 1], [-9e6, 8e5], [0, 3e6], [0, -1]], [[2e7, 1], [1.9e7, 2000]]):
        fitted = whitening.fit(table(spark, enumerate(vectors)))
        got = {r["vec_id"]: r["deviation"] for r in whitening.transform(fitted).collect()}
        assert [got[i] for i in range(len(vectors))] == plain(vectors)[1]
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(table(spark, [(1, [3e38, 1]), (2, [1, 1])])).collect()


def test_basis_is_widened_where_the_spectrum_has_no_gap(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ROUNDS", 2)
    monkeypatch.setattr(whitening, "DEGREE", 2)
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(400, 80)).astype(np.float32)
    fitted = whitening.fit(table(spark, enumerate(vectors)))
    assert fitted.residual < 1e-12 and np.allclose(fitted.values, plain(vectors)[2], rtol=1e-10)


def test_sums_of_many_tasks_are_added_in_two_steps(spark, monkeypatch):
    monkeypatch.setattr(whitening, "DIRECT", 1)
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(200, 6)).astype(np.float32)
    check(whitening.whiten(table(spark, enumerate(vectors))), vectors, list(range(200)), 6)


def test_query(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    check(queries.op11_embedding_whitening(spark, "/root/testdata/sf0.001"), [v for _, v in rows], [i for i, _ in rows], 32)
