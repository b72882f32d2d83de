"""Layered Parquet tables under one warehouse folder.

A table is a list of folders, <root>/<layer>/<table>/<part>. Which ones, says the
newest manifest in <root>/_manifest, a small JSON file for all tables. Every
write goes to a fresh folder first; it becomes visible by the next manifest. So a
refresh or append that fails leaves all tables as they were, several changes can
become visible together, and nothing is ever overwritten in place.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import AbstractContextManager, contextmanager, nullcontext
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


# The SQL namespace of each layer.
NAMESPACES = {
    "raw": "hospital_op",
    "bronze": "dw_bronze",
    "silver": "dw_silver",
    "gold": "dw_gold",
    "metadata": "metadata",
}


def _hadoop(spark: SparkSession, path: str):
    """A path and the file system it names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Look a path up in whatever file system it names."""
    target, system = _hadoop(spark, path)
    return system.exists(target)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """The size of a folder's files."""
    target, system = _hadoop(spark, path)
    return system.getContentSummary(target).getLength()


#: Rows in memory for a byte of these packed files, in bytes: columns of keys and flags pack to a tenth and less.
PACKED = 10


def _sparing(spark: SparkSession) -> None:
    """Settings of the session for tables of any size.

    Spark takes a file's size for that of its rows, and by that would broadcast dimensions of millions of rows through the
    driver. Shuffle files would stay until the driver's memory is cleaned up, those of all steps of a build.
    """
    factor = "spark.sql.sources.fileCompressionFactor"
    if float(spark.conf.get(factor)) < PACKED:
        spark.conf.set(factor, str(float(PACKED)))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows. The limit lets the optimizer drop joins against it."""
    return spark.createDataFrame([], schema).limit(0)


class _Pending:
    """Changes that are to become visible together."""

    def __init__(self) -> None:
        self.lock = threading.RLock()
        self.changes: dict[str, tuple[str, list[str]]] | None = None  # key -> (mode, folders)


@dataclass(frozen=True)
class Tables:
    spark: SparkSession
    root: str
    report: Callable[[str], None] = print
    _pending: _Pending = field(default_factory=_Pending, compare=False, repr=False)

    def __post_init__(self) -> None:
        _sparing(self.spark)

    # --- the manifest ---

    def _manifests(self) -> list[int]:
        folder, system = _hadoop(self.spark, f"{self.root.rstrip('/')}/_manifest")
        if not system.exists(folder):
            return []
        names = [s.getPath().getName() for s in system.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n[0].isdigit() and n.endswith(".json"))

    def _manifest(self) -> tuple[int, dict[str, list[str]]]:
        """Number and content of the newest manifest; 0 and nothing before the first."""
        numbers = self._manifests()
        if not numbers:
            return 0, {}
        path, system = _hadoop(self.spark, f"{self.root.rstrip('/')}/_manifest/{numbers[-1]}.json")
        stream = system.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return numbers[-1], json.loads(text)

    def _commit(self, changes: dict[str, tuple[str, list[str]]]) -> None:
        """Make changes visible in one step, on top of whatever the newest manifest says."""
        base = f"{self.root.rstrip('/')}/_manifest"
        with self._pending.lock:
            while True:
                number, tables = self._manifest()
                replaced = [p for k, (mode, _) in changes.items() if mode == "replace" for p in tables.get(k, [])]
                for key, (mode, folders) in changes.items():
                    tables[key] = folders if mode == "replace" else tables.get(key, []) + folders
                written, system = _hadoop(self.spark, f"{base}/tmp-{uuid.uuid4().hex}")
                stream = system.create(written, True)
                stream.write(bytearray(json.dumps(tables).encode()))
                stream.close()
                final, _ = _hadoop(self.spark, f"{base}/{number + 1}.json")
                if not system.exists(final) and system.rename(written, final):
                    break
                system.delete(written, False)  # another writer was first: start from its manifest
            for old in self._manifests()[:-2]:
                system.delete(_hadoop(self.spark, f"{base}/{old}.json")[0], False)
            retired = f"{base}/retired-{number}.txt"  # folders that the manifest before needs no more
            self._retire(system, retired, replaced, base, number)

    def _retire(self, system, note: str, replaced: list[str], base: str, number: int) -> None:
        """Note what was replaced; delete what the change before replaced, as its readers have had a whole change's time."""
        folder, _ = _hadoop(self.spark, base)
        for status in system.listStatus(folder):
            name = status.getPath().getName()
            if name.startswith("retired-") and int(name[8:-4]) < number:
                stream = system.open(status.getPath())
                text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
                stream.close()
                for path in filter(None, text.split("\n")):
                    target, fs = _hadoop(self.spark, f"{self.root.rstrip('/')}/{path}")
                    fs.delete(target, True)
                system.delete(status.getPath(), False)
        if replaced:
            stream = system.create(_hadoop(self.spark, note)[0], True)
            stream.write(bytearray("\n".join(replaced).encode()))
            stream.close()

    @contextmanager
    def together(self) -> Iterator[None]:
        """All writes inside become visible at once at the end, or not at all. Reads inside see them."""
        with self._pending.lock:
            if self._pending.changes is not None:
                raise RuntimeError("already inside a joint change")
            self._pending.changes = {}
        try:
            yield
            if self._pending.changes:
                self._commit(self._pending.changes)
        finally:
            self._pending.changes = None

    def jointly(self) -> AbstractContextManager[None]:
        """Part of the joint change that is open, or one of its own."""
        return nullcontext() if self._pending.changes is not None else self.together()

    def _seen(self) -> dict[str, list[str]]:
        """The newest manifest with the changes of this writer on top."""
        tables = self._manifest()[1]
        for key, (mode, fresh) in (self._pending.changes or {}).items():
            tables[key] = fresh if mode == "replace" else tables.get(key, []) + fresh
        return tables

    def folders(self, layer: str, table: str, buckets: Iterable[int] | None = None) -> list[str]:
        """The folders that make up a table now, or some of its buckets; none if it was never written."""
        tables, key = self._seen(), f"{layer}/{table}"
        found = tables.get(key, []) if buckets is None else []
        wanted = None if buckets is None else set(buckets)
        for name in sorted(tables):
            if name.startswith(f"{key}/") and (wanted is None or int(name.rsplit("/", 1)[1]) in wanted):
                found = found + tables[name]
        return [f"{self.root.rstrip('/')}/{p}" for p in found]

    def in_buckets(self, layer: str, table: str) -> bool:
        return any(name.startswith(f"{layer}/{table}/") for name, folders in self._seen().items() if folders)

    def noted(self, name: str) -> set[str]:
        """Marks made under a name; folders that were taken in, for example."""
        return set(self._seen().get(f"noted/{name}", []))

    def note(self, name: str, marks: Iterable[str]) -> None:
        """Add marks; they become visible with the other changes of a joint change."""
        self._change({f"noted/{name}": ("append", list(marks))})

    # --- reading ---

    def find(self, layer: str, table: str, buckets: Iterable[int] | None = None) -> DataFrame | None:
        """The table or some of its buckets, or None when it was never written."""
        paths = self.folders(layer, table, buckets)
        return self.spark.read.parquet(*paths) if paths else None

    def read(self, layer: str, table: str) -> DataFrame:
        df = self.find(layer, table)
        if df is None:
            raise LookupError(f"{layer}.{table} has not been loaded")
        return df

    def read_or_empty(self, layer: str, table: str, schema: StructType) -> DataFrame:
        df = self.find(layer, table)
        return empty(self.spark, schema) if df is None else df

    def is_loaded(self, layer: str, table: str) -> bool:
        """True when the table exists and has a row."""
        df = self.find(layer, table)
        return df is not None and not df.limit(1).isEmpty()

    # --- writing ---

    def refresh(self, layer: str, table: str, df: DataFrame) -> int:
        """Replace this table, and only this one; `df` may read it. Returns the rows written."""
        return self._write(layer, table, df, "replace")

    def append(self, layer: str, table: str, df: DataFrame) -> int:
        """Add rows; `df` may read the table. Returns the rows written."""
        return self._write(layer, table, df, "append")

    def refresh_buckets(self, layer: str, table: str, df: DataFrame, touched: Iterable[int]) -> int:
        """Replace some buckets of a table; `df` has all rows they are to hold, and their bucket as column `bucket`.

        The column isn't stored. A table that is stored whole gives way to its buckets.
        """
        part = f"{layer}/{table}/{uuid.uuid4().hex}"
        rows = self._written(df, part, "bucket")
        changes: dict[str, tuple[str, list[str]]] = {f"{layer}/{table}": ("replace", [])}
        for bucket in touched:
            own = f"{part}/bucket={bucket}"
            there = path_exists(self.spark, f"{self.root.rstrip('/')}/{own}")
            changes[f"{layer}/{table}/{bucket}"] = ("replace", [own] if there else [])
        left = [p for k, p in self._seen().items() if k.startswith(f"{layer}/{table}/") and p and k not in changes]
        if not rows and not left:  # a table without rows has a layout all the same
            return self._write(layer, table, df.drop("bucket"), "replace")
        self._change(changes)
        self.report(f"  {layer}.{table}: {rows} rows in {len(changes) - 1} buckets")
        return rows

    def _write(self, layer: str, table: str, df: DataFrame, mode: str) -> int:
        part = f"{layer}/{table}/{uuid.uuid4().hex}"
        rows = self._written(df, part)
        changes = {f"{layer}/{table}": (mode, [part])}
        if mode == "replace":
            changes |= {name: ("replace", []) for name, folders in self._seen().items() if folders and name.startswith(f"{layer}/{table}/")}
        self._change(changes)
        self.report(f"  {layer}.{table}: {rows} rows")
        return rows

    def _written(self, df: DataFrame, part: str, *by: str) -> int:
        # Counted while writing: no second pass.
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.partitionBy(*by).option("compression", "zstd").parquet(f"{self.root.rstrip('/')}/{part}")
        return seen.get["rows"]

    def _change(self, changes: dict[str, tuple[str, list[str]]]) -> None:
        """Commit, or add to the joint change."""
        with self._pending.lock:
            pending = self._pending.changes
            if pending is None:
                self._commit(changes)
                return
            for key, (mode, fresh) in changes.items():
                before, folders = pending.get(key, (mode, []))
                pending[key] = (mode, fresh) if mode == "replace" else (before, [*folders, *fresh])

    def publish(self, layer: str, tables: Iterable[str]) -> list[str]:
        """Make stored tables known to SQL, as views <namespace>.<table> of what they hold now.

        Publish again after a refresh or an append.
        """
        namespace, published = NAMESPACES[layer], []
        self.spark.sql(
            f"create database if not exists {namespace} "
            f"location '{self.root.rstrip('/')}/{layer}'"
        )
        for table in tables:
            paths = self.folders(layer, table)
            if not paths:
                continue
            name = f"{namespace}.{table}"
            self.spark.sql(f"drop view if exists {name}")
            parts = " union all ".join(f"select * from parquet.`{p}`" for p in paths)
            self.spark.sql(f"create view {name} as {parts}")
            published.append(name)
        return published
