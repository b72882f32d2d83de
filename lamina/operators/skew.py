"""Joins that stay balanced when one key holds a large share of the left rows.

Spark broadcasts the right side by itself when its size estimate allows it, and
then no key can overload a task. Beyond that size, the heaviest left keys are
counted first, and the rows of those keys alone are spread over many join
partitions; the few matching right rows are repeated once per spread. The
result is exact whichever keys are picked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A key is hot when it holds so many times the rows of an average shuffle partition,
# or this share of all rows if that is less, and at least HOT_MIN_ROWS.
HOT_PARTITIONS = 4
HOT_SHARE = 1 / 500
HOT_MIN_ROWS = 1_000_000
# Key hashes are counted in at least this many buckets first, and two a partition.
BUCKETS = 4096
# Spreads of a hot key per shuffle partition.
SPREADS = 8


def hot_share(partitions: int) -> float:
    """Share of all rows from which a key is hot; no more than its inverse can be."""
    return min(HOT_SHARE, HOT_PARTITIONS / partitions)


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def heavy_hitters(
    df: DataFrame, keys: Sequence[str], min_rows: int | None = None
) -> list[int]:
    """Hashes of the keys that hold a large share of the rows (at most 500, or a quarter of the partitions)."""
    return heavy_hitters_of(df, [keys], min_rows)[0]


def heavy_hitters_of(
    df: DataFrame, key_sets: Sequence[Sequence[str]], min_rows: int | None = None
) -> list[list[int]]:
    """The same for several keys of one frame, in one pass over their columns.

    Counting by bucket of the key hash is exact and small whatever the number
    of keys, and a bucket outweighs every key in it. Without a heavy bucket
    there is no heavy key, which is the usual end; else the keys of the heavy
    buckets alone are counted one by one.
    """
    hashed = df.select(F.posexplode(F.array(*[_key_hash(k) for k in key_sets])).alias("set", "key"))
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = max(BUCKETS, 2 * partitions)
    hashed = hashed.withColumn("bucket", F.pmod("key", F.lit(size)).cast("int"))
    # At most `size` rows for each key set.
    buckets = hashed.groupBy("set", "bucket").count().collect()
    total = sum(b["count"] for b in buckets if b["set"] == 0)
    floor = max(HOT_MIN_ROWS if min_rows is None else min_rows, hot_share(partitions) * total)
    hot: list[list[int]] = [[] for _ in key_sets]
    heavy = {i: [b["bucket"] for b in buckets if b["set"] == i and b["count"] >= floor]
             for i in range(len(key_sets))}
    if any(heavy.values()):
        suspect = F.lit(False)
        for i, found in heavy.items():
            suspect = suspect | ((F.col("set") == i) & F.col("bucket").isin(found))
        counts = hashed.where(suspect).groupBy("set", "key").count().where(F.col("count") >= floor)
        for row in counts.collect():  # at most 1 / hot_share rows for each key set
            hot[row["set"]].append(row["key"])
    return hot


def will_broadcast(df: DataFrame) -> bool:
    """True when Spark's own estimate lets it broadcast this side."""
    spark = df.sparkSession
    limit = _bytes(spark, "spark.sql.autoBroadcastJoinThreshold")
    if limit <= 0:
        return False
    try:
        estimate = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    except AttributeError:  # no estimate on this kind of session: assume large
        return False
    return int(str(estimate)) <= limit


def fits_broadcast(stored: DataFrame, row_bytes: int = 32) -> bool:
    """The same of a stored frame of hashes, by its rows: hashes don't pack, so `PACKED` times their files would be too much."""
    limit = _bytes(stored.sparkSession, "spark.sql.autoBroadcastJoinThreshold")
    return limit > 0 and stored.count() * row_bytes <= limit


def _bytes(spark: SparkSession, setting: str) -> int:
    text = spark.conf.get(setting).strip().lower().removesuffix("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    if text[-1] in units:
        return int(text[:-1]) * units[text[-1]]
    return int(text)


def balanced_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str,
    spread_by: Column,
    hot: Sequence[int] | None = None,
    min_rows: int | None = None,
) -> DataFrame:
    """`left` / `left_anti` / `left_semi` join with a right side unique on `on`.

    `hot` gives the hashes of the hot keys when they are known already.
    `spread_by` scatters the rows of a hot key. It must give a row the same
    value when a lost task is run again, so it may not be random.
    NULL keys never match; when there are many of them they count as a hot key
    and are spread as well.
    """
    if how not in ("left", "left_anti", "left_semi"):
        raise ValueError(f"balanced_join cannot do a {how} join")
    on = list(on)
    if will_broadcast(right):
        return left.join(right, on, how)
    if hot is None:
        hot = heavy_hitters(left, on, min_rows)
    if not hot:
        return left.join(right, on, how)

    # Several spreads per partition even out how they hash.
    fan = SPREADS * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_hot = _key_hash(on).isin(list(hot))
    left = left.withColumn(
        "_salt",
        F.when(is_hot, F.pmod(F.xxhash64(spread_by), F.lit(fan)).cast("int")).otherwise(F.lit(0)),
    )
    right = right.withColumn(
        "_salt",
        F.explode(
            F.when(is_hot, F.sequence(F.lit(0), F.lit(fan - 1))).otherwise(F.array(F.lit(0)))
        ),
    )
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def balanced_lookups(
    left: DataFrame,
    lookups: Sequence[tuple[DataFrame, Sequence[str]]],
    spread_by: Column,
    probe: DataFrame,
    min_rows: int | None = None,
) -> DataFrame:
    """Left-join several (table, key) pairs, each table unique on its key.

    Hot keys are looked for in `probe`, a frame with the same key columns that
    costs less to compute than `left`: once for all lookups, and only for those
    that are too large to broadcast.
    """
    large = [i for i, (table, _) in enumerate(lookups) if not will_broadcast(table)]
    found = heavy_hitters_of(probe, [lookups[i][1] for i in large], min_rows) if large else []
    hot = dict(zip(large, found))
    for i, (table, on) in enumerate(lookups):
        left = balanced_join(left, table, on, "left", spread_by, hot=hot.get(i, []))
    return left
