"""Newest versions of stored tables: the same rows as by ordering all, and wide rows left where they are."""

from datetime import datetime
from hashlib import md5

import pytest

from harness import stored
from harness.catalog import AS_OF, Flow
from lamina.operators.latest import first_per_key, latest_version, packed_hash, packed_order, unpacked_hash
from lamina.operators.versions import newest_of_stored
from lamina.plans.warehouse import Warehouse

DDL = "id string, part string, value string, _ingested_at timestamp_ntz, _source_file string, _row_hash string"
OLD, NEW = datetime(2024, 1, 1), datetime(2024, 1, 2)


def row(key, part, value, at=OLD, digest=None):
    return key, part, value, at, "t.csv", digest or md5(f"{key}|{part}|{value}".encode()).hexdigest()


def table(rows, tmp_path, surplus):
    """200 records of one version, and some of several: later ones, equal times, NULL in the key, whole copies."""
    odd = [row("k1", "a", "late", NEW), row("k2", "a", "other"), row("k3", "a", "v3"), row(None, "a", "x"),
           row(None, "a", "y", NEW), row("n", None, "x"), row("n", None, "y"), row(None, None, "x")]
    many = [row(f"k{i}", "a", "again", NEW) for i in range(100)]
    path = str(tmp_path / "stored")
    rows(DDL, *[row(f"k{i}", "a", f"v{i}") for i in range(200)], *odd, *(many if surplus else [])).write.parquet(path)
    return path


def listed(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("surplus", [False, True])
@pytest.mark.parametrize("broadcast", [True, False])
def test_same_rows_as_by_ordering_all(spark, rows, tmp_path, request, surplus, broadcast):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    df, keys = spark.read.parquet(table(rows, tmp_path, surplus)), ("id", "part")
    got = newest_of_stored(df, keys)
    assert got.columns == df.columns
    assert listed(got) == listed(latest_version(df, keys))


def test_records_of_one_version_are_not_shuffled(spark, rows, tmp_path):
    path = str(tmp_path / "once")
    rows(DDL, *[row(f"k{i}", "a", "v") for i in range(50)]).write.parquet(path)
    plan = newest_of_stored(spark.read.parquet(path), ("id",))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_packed_hashes_order_as_their_text(rows):
    digests = [md5(str(i).encode()).hexdigest() for i in range(30)]
    df = rows(DDL, *[row("k", "a", "v", digest=d) for d in digests])
    packed = packed_hash(df)
    assert packed.where("_row_hash is not null").isEmpty()
    first = unpacked_hash(first_per_key(packed, ["id"], packed_order(packed, ["id"])))
    assert [r["_row_hash"] for r in first.collect()] == [min(digests)]
    odd = rows(DDL, *[row("k", "a", "v", digest=d) for d in ("a", "Z1", "abc", "g" * 32, digests[0].upper(), "")], row("k", "a", "v")[:5] + (None,))
    assert listed(unpacked_hash(packed_hash(odd)).select(*odd.columns)) == listed(odd)


def test_raw_reports_need_the_raw_layer_alone(spark, monkeypatch):
    def build(*_):
        raise AssertionError("the raw layer's reports read no other layer")

    monkeypatch.setattr(Warehouse, "build", build)
    for report in (stored.raw_duplicates, stored.raw_orphans, stored.raw_populated):
        assert report(Flow(spark, "/root/testdata/sf0.001"), AS_OF).count() > 0


def test_each_query_builds_its_own_warehouse(spark, monkeypatch):
    """What a query costs doesn't depend on the queries before it."""
    runs = []
    monkeypatch.setattr(Warehouse, "build", lambda house, raw, as_of, run: runs.append((house.tables.root, run)))
    flow = Flow(spark, "/root/testdata/sf0.001")
    first, second = stored._house(flow, AS_OF), stored._house(flow, AS_OF)
    assert runs == [(h.tables.root, run) for h in (first, second) for run in ("run-1", "run-2")]
    assert first.tables.root != second.tables.root
