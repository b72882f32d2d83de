"""WARC archives: a writer that stores equal payloads once, and a reader that salvages what damage has left.

Writer. Pages meet their payload's digest; of equal payloads one page is written as a response, the others as
revisits that refer to it. Each record is a gzip member of its own, so an archive can be entered at any of them. Spark's
text writer puts members one after the other into archives: it ends each row by one byte, and that is the zero byte
that ends a member.

Reader. At each place it takes a gzip member or a plain record, and checks it: the member's checksum, version line,
header fields, length, end mark, and the digests of block and payload. Where a check fails it searches for the next
place at which a member or a version line begins and checks hold, goes on there, and logs the bytes between as a
quarantined gap. Nothing of a damaged member is used, since no check tells which part of it is sound.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm.store import saved

ARCHIVE_BYTES = 32 << 20  # of an archive's records before compression, about; a larger record has one for itself
LEVEL = 4
_FEED = 1 << 16  # bytes given to the decompressor at a time

# Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
VERSIONS = (b"WARC/1.0\r\n", VERSION)
END = b"\r\n\r\n"
GZIP = b"\x1f\x8b\x08"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
#: A gzip member without content.
_EMPTY = zlib.compressobj(9, zlib.DEFLATED, 31).flush()


def digest(data: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# --- one record --------------------------------------------------------------


@dataclass
class Record:
    fields: dict[str, str]  # names in lower case
    block: bytes

    @property
    def type(self) -> str:
        return self.fields["warc-type"].lower()

    def payload(self) -> bytes:
        """Of an HTTP message what follows its head, else the block."""
        if self.fields.get("content-type", "").lower().startswith("application/http"):
            return self.block.partition(END)[2]
        return self.block

    def payload_bytes(self) -> int | None:
        """Of a revisit what the kept HTTP head says."""
        if self.type != "revisit":
            return len(self.payload())
        said = re.search(rb"\ncontent-length:\s*(\d+)", self.block.partition(END)[0].lower())
        return int(said[1]) if said else None

    def payload_digest(self) -> str:
        return self.fields["warc-payload-digest"].removeprefix("sha1:") if self.type == "revisit" else digest(self.payload())


def record(fields: dict[str, str | None], payload: bytes | None, length: int = 0) -> bytes:
    """A record whose block is an HTTP message. Without a payload, as in a revisit, it is the message's head alone,
    which says how long the payload is that `fields` give the digest of."""
    length = length if payload is None else len(payload)
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length
    if payload is not None:
        block += payload
        fields = fields | {"WARC-Payload-Digest": f"sha1:{digest(payload)}"}
    fields = fields | {"WARC-Block-Digest": f"sha1:{digest(block)}", "Content-Type": "application/http;msgtype=response",
                       "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {_one_line(v)}\r\n" for k, v in fields.items() if v is not None)
    return VERSION + lines.encode() + b"\r\n" + block + END


def _one_line(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A").strip()


def member(data: bytes) -> bytes:
    """A gzip member. Its last byte is zero; a size above 16 MB would put another there, so an empty member follows."""
    made = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    out = made.compress(data) + made.flush()
    return out if out[-1] == 0 else out + _EMPTY


class Damaged(ValueError):
    """A check failed; the text says which."""


def parse(data: bytes, at: int) -> tuple[Record, int]:
    """The record that begins at `at`, and where it ends. Raises Damaged."""
    if not data.startswith(VERSIONS, at):
        raise Damaged("no version line")
    stop = data.find(END, at)
    if stop < 0:
        raise Damaged("header without end")
    fields: dict[str, str] = {}
    name = ""
    for line in data[at + len(VERSION):stop].split(b"\r\n"):
        try:
            text = line.decode()
        except UnicodeDecodeError:
            raise Damaged("header is no text") from None
        if text[:1] in (" ", "\t") and name:  # goes on from the line before
            fields[name] += " " + text.strip()
            continue
        name, colon, value = text.partition(":")
        name = name.strip().lower()
        if not colon or not name:
            raise Damaged("header line without a name")
        fields[name] = value.strip()
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise Damaged("no content length")
    if not fields.get("warc-type"):
        raise Damaged("no record type")
    first = stop + len(END)
    last = first + int(length)
    if not data.startswith(END, last):
        raise Damaged("no end mark after the block")
    found = Record(fields, data[first:last])
    if not _agrees(fields.get("warc-block-digest"), found.block):
        raise Damaged("block digest differs")
    if found.type != "revisit" and not _agrees(fields.get("warc-payload-digest"), found.payload()):
        raise Damaged("payload digest differs")
    if found.type == "revisit" and not fields.get("warc-payload-digest"):
        raise Damaged("revisit without payload digest")
    return found, last + len(END)


def _agrees(said: str | None, data: bytes) -> bool:
    """Digests of other kinds than SHA-1 in base32 can't be checked and pass."""
    if not said or not said.lower().startswith("sha1:") or len(said) != 37:
        return True
    return said[5:].upper() == digest(data)


# --- one archive -------------------------------------------------------------


def _inflated(data: bytes, at: int) -> tuple[bytes, int]:
    """Content of the gzip member that begins at `at`, and where it ends. Raises Damaged."""
    made, out, fed = zlib.decompressobj(31), [], at
    try:
        while not made.eof and fed < len(data):
            out.append(made.decompress(data[fed:fed + _FEED]))
            fed = min(len(data), fed + _FEED)
    except zlib.error:
        raise Damaged("gzip member is damaged") from None
    if not made.eof:
        raise Damaged("gzip member is cut off")
    return b"".join(out), fed - len(made.unused_data)


def _member(data: bytes, at: int) -> tuple[list[Record], int]:
    """Records of the member or the plain record at `at`, all of them sound, and where it ends. Raises Damaged."""
    if not data.startswith(GZIP, at):
        found, stop = parse(data, at)
        return [found], stop
    content, stop = _inflated(data, at)
    records, inner = [], 0
    while inner < len(content):
        found, inner = parse(content, inner)
        records.append(found)
    return records, stop


def salvage(data: bytes) -> Iterator[tuple[int, int, Record | None, str | None]]:
    """(first, last, record, None) of every sound record, (first, last, None, reason) of every quarantined gap.

    Bytes are those of the archive; records of one member share them. Together they cover the archive gaplessly, but for
    members without content.
    """
    at, gap, reason = 0, None, None
    while at < len(data):
        try:
            records, stop = _member(data, at)
        except Damaged as why:
            if gap is None:
                gap, reason = at, str(why)
            following = _START.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if gap is not None:
            yield gap, at, None, reason
            gap = None
        for found in records:
            yield at, stop, found, None
        at = stop
    if gap is not None:
        yield gap, len(data), None, reason


# --- Spark -------------------------------------------------------------------


def write(pages: DataFrame, folder: str, at_least: int = 0, date: str = "1970-01-01T00:00:00Z") -> int:
    """Write a record for each row of `page_id`, `url`, `html` to new archives in `folder`; returns the number of different rows.

    Of equal payloads of at least `at_least` bytes, that of the largest page_id is a response (of several such rows that of
    the largest url, of rows repeated whole one), the others revisit it. Smaller ones are all responses. A null html is an empty
    payload. Rows without a page_id are no pages. Other columns are left out.
    """
    rows = pages.where("page_id is not null").select("page_id", F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1("html"))
    key = ["page_id", "url", "sha"]
    counted = saved(rows.withColumn("bytes", F.octet_length("html")).groupBy(*key, "bytes").agg(F.count("*").alias("n")))
    best = counted.where(F.col("bytes") >= at_least).groupBy("sha", "bytes").agg(F.max(F.struct("page_id", "url")).alias("best"))
    # Rows of one payload may be a third of all: Spark splits their partition, or sends the other side to all.
    first = (F.col("page_id") == F.col("best.page_id")) & F.col("url").eqNullSafe(F.col("best.url"))
    decided = saved(counted.join(best, ["sha", "bytes"], "left").select(
        *key, "bytes", "n", "best", (F.col("best").isNull() | first).alias("stored")))
    size = decided.agg(F.sum(F.when(F.col("stored"), F.col("bytes"))).alias("b"), F.count("*").alias("rows"), F.max("n").alias("most"),
                       F.sum("n").alias("all")).first()
    if not size["rows"]:
        return 0

    def named(copy, of="") -> F.Column:
        """A record's id: a hash of what it holds."""
        texts = [F.coalesce(F.col(f"{of}{c}").cast("string"), F.lit("\0")) for c in ("page_id", "url")]
        return F.substring(F.sha2(F.concat_ws("\1", *texts, "sha", copy.cast("string")), 256), 1, 32)

    def matched(stored: DataFrame) -> DataFrame:
        s, r = stored.alias("s"), rows.alias("r")
        same = (F.col("s.page_id") == F.col("r.page_id")) & F.col("s.url").eqNullSafe(F.col("r.url")) & (F.col("s.sha") == F.col("r.sha"))
        return r.join(s, same).select("r.page_id", "r.url", "r.sha", "html", "n", F.col("s.best").alias("best"))

    full = matched(decided.where("stored and n = 1")).withColumn("copy", F.lit(1).cast("long"))
    if size["most"] > 1:  # rows repeated whole
        once = matched(decided.where("stored and n > 1")).dropDuplicates(key)
        copies = F.explode(F.when(F.col("best").isNull(), F.sequence(F.lit(1).cast("long"), "n")).otherwise(F.array(F.lit(1).cast("long"))))
        full = full.unionByName(once.withColumn("copy", copies))
    full = full.select("page_id", "url", "html", F.lit(0).cast("int").alias("bytes"), F.lit(None).cast("string").alias("sha"),
                       named(F.col("copy")).alias("id"), F.lit(None).cast("string").alias("refers_id"), F.lit(None).cast("string").alias("refers_to"))
    again = decided.where("best is not null and not (stored and n = 1)").withColumn(
        "copy", F.explode(F.sequence(F.when(F.col("stored"), 2).otherwise(1).cast("long"), "n"))).select(
        "page_id", "url", F.lit(None).cast("string").alias("html"), "bytes", "sha", named(F.col("copy")).alias("id"),
        named(F.lit(1), "best.").alias("refers_id"), F.col("best.page_id").cast("string").alias("refers_to"))
    each = max(1, int(ARCHIVE_BYTES / (600 + (size["b"] or 0) / size["all"])))

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            for row in (row for i in range(0, batch.num_rows, 64) for row in batch.slice(i, 64).to_pylist()):
                fields = {"WARC-Type": "response" if row["html"] is not None else "revisit", "WARC-Record-ID": _urn(row["id"]),
                          "WARC-Date": date, "WARC-Target-URI": row["url"], "Page-ID": row["page_id"]}
                if row["html"] is None:
                    fields |= {"WARC-Refers-To": _urn(row["refers_id"]), "WARC-Profile": SAME_PAYLOAD, "Refers-To-Page-ID": row["refers_to"],
                               "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(row["sha"])).decode()}
                made = record(fields, None if row["html"] is None else row["html"].encode(), row["bytes"])
                out.append(member(made)[:-1])  # the writer adds the zero byte
                held += len(out[-1])
                if held > ARCHIVE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                    out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    both = full.unionByName(again).withColumn("page_id", F.col("page_id").cast("string"))
    both.mapInArrow(members, "value binary").select(F.col("value").cast("string")).write.mode("append").option(
        "lineSep", "\0").option("maxRecordsPerFile", each).option("compression", "none").text(folder)
    return size["rows"]


def _urn(name: str) -> str:
    return f"<urn:uuid:{name[:8]}-{name[8:12]}-{name[12:16]}-{name[16:20]}-{name[20:]}>"


READ = ("path string, first long, last long, reason string, record_type string, record_id string, target_uri string, page_id string, "
        "refers_to string, payload_bytes long, payload_digest string, payload binary")


def read(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """A row for every sound record of the archives in `folder`, and one with a `reason` for every quarantined gap.

    `first` and `last` are bytes of the archive. Archives may be plain, gzipped by record, or both. An archive is read
    by one task, so its size bounds the memory; the writer starts a new one at about 32 MB. `page_id` and `refers_to` are
    the writer's own fields, null in others' archives. An archive without bytes gives no rows.
    """
    columns = [c.split()[0] for c in READ.split(", ")]
    schema = pa.schema([(c, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[k]) for c, k in map(str.split, READ.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows, held = [], 0
                for first, last, found, reason in salvage(content.as_buffer().to_pybytes() if content.is_valid else b""):
                    row = {"path": path, "first": first, "last": last, "reason": reason}
                    if found is not None:
                        get = found.fields.get
                        row |= {"record_type": found.type, "record_id": get("warc-record-id"), "target_uri": get("warc-target-uri"),
                                "page_id": get("page-id"), "refers_to": get("refers-to-page-id"), "payload_bytes": found.payload_bytes(),
                                "payload_digest": found.payload_digest(), "payload": found.payload() if with_payload else None}
                        held += len(row["payload"] or b"")
                    rows.append(row)
                    if held > ARCHIVE_BYTES or len(rows) >= 10_000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    found = spark.read.format("binaryFile").load(folder).select("path", "content")
    return found.mapInArrow(run, READ).select(*columns)


def records(read_back: DataFrame) -> DataFrame:
    return read_back.where("reason is null").drop("reason")


def gaps(read_back: DataFrame) -> DataFrame:
    """The quarantine log: path, first and last byte, and the check that failed first."""
    return read_back.where("reason is not null").select("path", "first", "last", "reason")
