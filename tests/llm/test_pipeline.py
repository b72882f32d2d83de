"""The registered queries on whole small tables, and the pipeline's stages, against plain versions."""

import hashlib

import brute
import pytest

import corpus_pipeline
from lamina.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def items(spark):
    return [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]


def test_near_duplicates(spark, texts):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in queries.op1_minhash_near_dedup(spark, SF).collect()}
    assert got == brute.near_duplicates(texts, 2, 80)


def test_passages(spark, texts):
    assert sorted(tuple(r) for r in queries.op4_substring_dedup(spark, SF).collect()) == brute.remove_recurring(texts, 35)
    assert sorted(tuple(r) for r in queries.op7_suffix_array_dedup(spark, SF).collect()) == brute.remove_repeated(texts, 50)


def test_contamination(spark, texts, items):
    want = [(i, n, hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bad)
            for i, n, hit, found, bad in brute.contamination(texts, items, 13)]
    assert sorted(tuple(r) for r in queries.op8_benchmark_decontamination(spark, SF).collect()) == want


def test_every_query_is_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in names if x.startswith("op") and x[2].isdigit()}
    assert "pipeline" in names


def test_stages(spark, texts, items):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "minhash_near_dedup", "substring_dedup", "benchmark_decontamination", "best_fit_packing"]
    judged = {r["doc_id"] for r in queries.op3_quality_classifier(spark, SF).where("kept").collect()}
    stages = [f for _, f in corpus_pipeline.STAGES]

    def run(k, frame):
        out = stages[k](spark, frame, SF)
        if k < 4:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        rows = out.collect()
        return (spark.createDataFrame(rows, out.schema) if k < 4 else out), rows

    frame, rows = run(0, docs)
    assert {r["doc_id"] for r in rows} == judged
    kept = [(r["doc_id"], r["text"]) for r in rows]
    frame, rows = run(1, frame)
    groups = brute.near_duplicates(kept, 5, 80)
    assert sorted(r["doc_id"] for r in rows) == sorted(i for i, (*_, first) in groups.items() if first)
    kept = [(r["doc_id"], r["text"]) for r in rows]
    frame, rows = run(2, frame)
    want = {i: digest for i, n, gone, digest in brute.remove_recurring(kept, 35) if gone < n}
    assert {r["doc_id"]: hashlib.sha256(r["text"].encode()).hexdigest() for r in rows} == want
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    kept = [(r["doc_id"], r["text"]) for r in rows]
    frame, rows = run(3, frame)
    assert sorted(r["doc_id"] for r in rows) == [i for i, *_, bad in brute.contamination(kept, items, 13) if not bad]
    ids = {r["doc_id"] for r in rows}
    _, rows = run(4, frame)
    assert {r["doc_id"] for r in rows} == ids and all(r["offset"] + r["length"] <= 1024 for r in rows)
    whole = {tuple(r) for r in corpus_pipeline.run(spark, SF).drop("sequence_id", "offset").collect()}
    assert whole == {tuple(r)[:5] for r in rows}


def test_repeated_rows_come_out_once(spark, tmp_path):
    """A clean row given twice stays once; a text that shares its doc_id with a duplicate stays, too."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clean, other = (" ".join(f"{a}{k}" for k in range(50)) for a in ("river", "stone"))
    rows = [(10**9, clean), (10**9, clean), (10**9 + 1, other), (10**9 + 2, other), (10**9 + 2, clean.replace("river", "cloud")),
            (10**9 + 3, None), (10**9 + 3, None)]
    more = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    more = more.select(*[more[c].cast(k) for c, k in docs.dtypes])
    once = corpus_pipeline.keep_one_of_each(spark, more, SF)
    assert once.columns == docs.columns and once.dtypes == docs.dtypes
    want = [rows[0], rows[2], rows[4], rows[5]]
    assert sorted((r["doc_id"], r["text"] or "") for r in once.collect()) == sorted((i, t or "") for i, t in want)
    left = corpus_pipeline.cut_recurring_passages(spark, once, SF).collect()
    assert sorted((r["doc_id"], r["text"]) for r in left) == sorted(want[:3])


def test_contaminated_rows_go_alone(spark, items):
    """A clean text that shares its doc_id with a contaminated one stays; no rows, no rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clean = " ".join(f"river{k}" for k in range(60))
    rows = [(7, clean), (7, items[0][1]), (8, clean), (8, clean), (9, None)]
    more = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", 1) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, row_key string, copies int")
    left = corpus_pipeline.drop_contaminated(spark, more, SF)
    assert left.columns == docs.columns and sorted((r["doc_id"], r["text"] or "") for r in left.collect()) == [(7, clean), (8, clean), (8, clean), (9, "")]
    assert corpus_pipeline.drop_contaminated(spark, more.limit(0), SF).collect() == []


def test_pipeline_keeps_a_document_given_twice(spark, texts, tmp_path):
    long = {i for i, t in texts if t and len(t.split()) >= 50}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = corpus_pipeline.run(spark, SF).collect()
    chosen = min(r["doc_id"] for r in whole if r["doc_id"] in long)
    docs.unionByName(docs.where(docs["doc_id"] == chosen)).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")

    def pieces(rows):
        return sorted((r["piece"], r["length"], r["ids_crc32"]) for r in rows if r["doc_id"] == chosen)

    assert pieces(corpus_pipeline.run(spark, str(tmp_path)).collect()) == pieces(whole) != []
