"""Archives: exact round trips, and what is left after damage."""

import base64
import hashlib
import random
import zlib
from pathlib import Path

import pytest

from harness.compare import open_duckdb
from lamina.llm import queries, warc

SCHEMA = "page_id long, url string, html string, n long, best string, sha string"


def made(k, payload=None):
    fields = {"WARC-Type": "response", "WARC-Record-ID": f"<urn:x:{k}>", "WARC-Date": "2020-01-01T00:00:00Z", "Page-ID": str(k)}
    return warc.record(fields, payload if payload is not None else f"<p>page {k}</p>".encode() * (k + 1))


def found(data):
    """Page ids of sound records, gaps."""
    rows = list(warc.salvage(data))
    at = 0
    for first, last, record, _ in rows:
        assert first == at or (record is not None and last == at)  # gapless
        at = last
    assert at == len(data)
    return [r.fields["page-id"] for *_, r, _ in rows if r], [(a, b, why) for a, b, r, why in rows if r is None]


def test_sound_archives():
    plain, packed = [made(k) for k in range(5)], [warc.member(made(k)) for k in range(5)]
    for parts in (plain, packed, [plain[0], packed[1], packed[2], plain[3], packed[4]], [warc.member(b"".join(plain))]):
        assert found(b"".join(parts)) == (list("01234"), [])
    assert found(b"") == ([], [])


@pytest.mark.parametrize("pack", [warc.member, bytes])
def test_damage_costs_the_damaged_records_only(pack):
    parts = [pack(made(k)) for k in range(6)]
    starts = [sum(map(len, parts[:k])) for k in range(7)]
    whole, rng = b"".join(parts), random.Random(4)
    for _ in range(60):
        k = rng.randrange(6)
        # no check covers a plain record's header fields
        at = rng.randrange(starts[k] if pack is warc.member else whole.index(b"HTTP/1.1 200", starts[k]), starts[k + 1])
        changed = whole[:at] + bytes([whole[at] ^ rng.randrange(1, 256)]) + whole[at + 1:]
        ids, gaps = found(changed)
        lost = sorted(set("012345") - set(ids))
        if pack is warc.member and not lost:  # a gzip header's time and system are under no check
            assert not gaps and starts[k] + 3 < at < starts[k] + 10
        else:
            assert lost == [str(k)] and [(a, b) for a, b, _ in gaps] == [(starts[k], starts[k + 1])]
    # bytes lost, bytes between, end cut off, start cut off
    assert found(whole[:starts[3] - 30] + whole[starts[3] - 20:])[0] == list("01345")
    ids, gaps = found(whole[:starts[3]] + b"noise \x1f\x8b\x08 WARC/1.0\r\nmore" + whole[starts[3]:])
    assert ids == list("012345") and [(a, b) for a, b, _ in gaps] == [(starts[3], starts[3] + 24)]
    assert found(whole[:-5])[0] == list("01234") and found(whole[7:])[0] == list("12345")
    assert found(b"\0" * 1000) == ([], [(0, 1000, "no version line")])


def test_reasons():
    good = made(1)
    for old, new, why in ((b"Content-Length: 1", b"Content-Length: x", "no content length"), (b"WARC-Type", b"WARC-Tipe", "no record type"),
                          (b"<p>page", b"<p>cage", "block digest differs"), (b"Date: 2020-01-01T00:00:00Z", b"Date", "header line without a name"),
                          (b"WARC/1.1", b"WARC/7.1", "no version line"), (b"Page-ID", b"Page-\xff\xff", "header is no text")):
        assert old in good
        assert [w for *_, w in found(good.replace(old, new, 1) + made(2))[1]] == [why]
    bad = warc.member(made(1))
    assert found(bad[:-8] + b"\1" * 8)[1][0][2] == "gzip member is damaged" and found(bad[:-3])[1][0][2] == "gzip member is cut off"


def test_a_record_inside_a_payload_and_a_large_one():
    data = b"".join(warc.member(made(k, b"see " + made(9) + made(8))) for k in range(3))
    assert found(data) == (list("012"), [])
    large = made(1, b"x" * (17 << 20))
    rows = list(warc.salvage(warc.member(large) + warc.member(made(2))))
    assert warc.member(large)[-1] == 0 and [r.fields["page-id"] for *_, r, _ in rows] == ["1", "2"]
    assert zlib.decompressobj(31).decompress(warc.member(large)) == large


def expected(rows, at_least=0):
    """page_id, bytes, digest, type, refers_to of each row, by plain means."""
    rows = [(i, u, (t or "").encode()) for i, u, t in rows if i is not None]
    out = []
    for payload in {p for *_, p in rows}:
        own = sorted(((i, u is not None, u or "") for i, u, p in rows if p == payload), reverse=True)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        for k, (i, *_) in enumerate(own):
            again = k > 0 and len(payload) >= at_least
            out.append((i, len(payload), digest, "revisit" if again else "response", str(own[0][0]) if again else None))
    return sorted(out, key=str)


ROWS = [(1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (3, None, "<p>one</p>"), (4, "http://a/4", None), (5, "", ""),
        (6, "http://é/\r\nx", "ünïcode 漢字 😀"), (7, "u", "twice"), (7, "u", "twice"), (7, "v", "twice"), (7, None, "twice"), (8, "w", "WARC/1.1\r\n" * 9),
        (9, "x", "y" * 300_000), (9, "x", "z\r\n\r\n"), (None, "u", "nobody"), (10, None, "z\r\n\r\n"), (10, None, "z\r\n\r\n"), (-1, "n", "neg")]


def pages(spark, rows):
    return spark.createDataFrame([(*r, 1, "b", "s") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("at_least", [0, 6])
@pytest.mark.parametrize("archive", [32 << 20, 200])
def test_round_trip(spark, tmp_path, monkeypatch, archive, at_least):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", archive)
    assert warc.write(pages(spark, ROWS), str(tmp_path / "w"), at_least) > 0
    back = warc.read(spark, str(tmp_path / "w"))
    assert warc.gaps(back).count() == 0
    rows = warc.records(back).collect()
    got = sorted(((int(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows), key=str)
    assert got == expected(ROWS, at_least)
    ids = {r["record_id"] for r in rows}
    assert len(ids) == len(rows)  # also of rows repeated whole
    texts = {((i, (t or "").encode())) for i, _, t in ROWS}
    assert all((int(r["page_id"]), bytes(r["payload"])) in texts for r in rows if r["record_type"] == "response")


def test_nothing_to_write(spark, tmp_path):
    assert warc.write(pages(spark, [(None, "u", "x")]), str(tmp_path / "w")) == 0
    assert warc.write(pages(spark, [(1, None, "x")]).limit(0), str(tmp_path / "w")) == 0


def test_stored_archives_with_damage(spark, tmp_path):
    texts = [(k, f"http://a/{k}", f"<p>{random.Random(k).random()}</p>" * 20) for k in range(40)]
    warc.write(pages(spark, texts), str(tmp_path / "w"))
    before = {r["page_id"]: r for r in warc.read(spark, str(tmp_path / "w")).collect()}
    hurt = [before["5"], before["17"], before["30"]]
    for r in hurt:
        path = Path(r["path"].removeprefix("file:"))
        data = bytearray(path.read_bytes())
        data[(r["first"] + r["last"]) // 2] ^= 0x55
        path.write_bytes(bytes(data))
        (path.parent / f".{path.name}.crc").unlink(missing_ok=True)
    back = warc.read(spark, str(tmp_path / "w"))
    assert {r["page_id"] for r in warc.records(back).collect()} == set(before) - {"5", "17", "30"}
    assert {(r["path"], r["first"], r["last"]) for r in warc.gaps(back).collect()} == {(r["path"], r["first"], r["last"]) for r in hurt} or \
        sum(r["last"] - r["first"] for r in warc.gaps(back).collect()) == sum(r["last"] - r["first"] for r in hurt)


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.op12_warc_archives(spark, folder)
    columns = sorted(got.columns)
    result = open_duckdb(folder).execute(queries.ORACLE_SQL["op12_warc_archives"])
    order = [[d[0] for d in result.description].index(c) for c in columns]
    assert sorted(map(str, (tuple(r) for r in got.select(*columns).collect()))) == sorted(str(tuple(r[i] for i in order)) for r in result.fetchall())
