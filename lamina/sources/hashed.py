"""The row hashes of a stored table, bucketed, so that a load moves its own hashes only.

Folders of stored tables never change. Each has a companion under <root>/_hashes, written once, when the
next load first needs it: its distinct hashes as 16 bytes, in buckets by Spark's own bucketing. Together the
companions are one external table, partitioned by folder. A join with it needs no exchange of the table's side, whatever
the length of the history: the load's hashes are dealt to the buckets, and each bucket is read where it lies.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.sources.tables import Tables, folder_bytes, path_exists

BUCKET_BYTES = 64 << 20  # of stored rows whose hashes one task sorts: one to two million


@dataclass(frozen=True)
class HashHistory:
    """Hashes of the folders that make up stored tables now.

    A bucket is sorted by one task. So there are `buckets` of them at least, and twice as many whenever the stored
    table has come to more than `BUCKET_BYTES` for each. Histories of different numbers lie in different places, so a changed
    number writes companions anew.
    """

    tables: Tables
    buckets: int = 64

    def stored(self, layer: str, table: str, column: str = "_row_hash") -> DataFrame | None:
        """`hash` of every stored row, read in buckets; None for a table without folders."""
        spark, folders = self.tables.spark, self.tables.folders(layer, table)
        if not folders:
            return None
        buckets = self.number(folders)
        base = f"{self.tables.root.rstrip('/')}/_hashes/{layer}-{table}-{buckets}"
        parts = [f.rsplit("/", 1)[1] for f in folders]
        for part, folder in zip(parts, folders, strict=True):
            if not path_exists(spark, f"{base}/part={part}/_SUCCESS"):  # a broken-off write lacks it and is replaced
                self._write(spark.read.parquet(folder).select(F.unhex(column).alias("hash")), f"{base}/part={part}", buckets)
        name = f"lamina_hashes_{hashlib.md5(base.encode()).hexdigest()}"
        if not spark.catalog.tableExists(name):
            spark.sql(f"create table {name} (hash binary, part string) using parquet partitioned by (part) "
                      f"clustered by (hash) into {buckets} buckets location '{base}'")
        spark.catalog.recoverPartitions(name)
        return spark.table(name).where(F.col("part").isin(parts)).select("hash")

    def number(self, folders: Sequence[str]) -> int:
        """Of buckets, for a table of these folders."""
        size, buckets = sum(folder_bytes(self.tables.spark, f) for f in folders), self.buckets
        while buckets * BUCKET_BYTES < size:
            buckets *= 2
        return buckets

    def _write(self, hashes: DataFrame, path: str, buckets: int) -> None:
        name = f"lamina_written_{uuid.uuid4().hex}"
        self._distinct(hashes, buckets).write.bucketBy(buckets, "hash").option("path", path).mode("overwrite").format("parquet").saveAsTable(name)  # a file for each bucket
        hashes.sparkSession.sql(f"drop table {name}")  # the table is external: its files stay

    def known(self, hashes: DataFrame, layer: str, table: str) -> DataFrame | None:
        """Those of `hashes` (one binary column, hash) that the stored table has."""
        stored = self.stored(layer, table)
        return None if stored is None else self._dealt(hashes, layer, table).join(stored, "hash", "left_semi")

    def unknown(self, hashes: DataFrame, layer: str, table: str) -> DataFrame | None:
        """Those that it doesn't have; None for a table without folders."""
        stored = self.stored(layer, table)
        return None if stored is None else self._dealt(hashes, layer, table).join(stored, "hash", "left_anti")

    def _dealt(self, hashes: DataFrame, layer: str, table: str) -> DataFrame:
        return self._distinct(hashes, self.number(self.tables.folders(layer, table)))

    @staticmethod
    def _distinct(hashes: DataFrame, buckets: int) -> DataFrame:
        return hashes.repartition(buckets, "hash").distinct()  # in this order one exchange does for both

