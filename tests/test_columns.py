"""Column expressions against plain Python, over many random rows at once."""

import hashlib
import random
from datetime import date, datetime, timedelta
from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from lamina.functions.columns import (
    date_key, elapsed_days, elapsed_minutes, exact_ratio, moment, row_hash,
)

RND = random.Random(7)
START = datetime(2019, 12, 25)


def _moment():
    return RND.choice([None, *[START + timedelta(seconds=RND.randrange(10**6), microseconds=RND.choice([0, 500000, 250]))] * 6])


def test_row_hash(rows):
    def text():
        return RND.choice([None, "", " a", "|", "é–", "x|y", str(RND.random())])

    data = [(text(), text(), RND.choice([None, RND.randrange(10**9)]),
             RND.choice([None, Decimal(RND.randrange(-10**9, 10**9)).scaleb(-2)]),
             RND.choice([None, date(2020, 1, 1) + timedelta(days=RND.randrange(999))]),
             RND.choice([None, START + timedelta(seconds=RND.randrange(10**6))])) for _ in range(500)]
    df = rows("a string, b string, c bigint, d decimal(15,2), e date, f timestamp_ntz", *data)

    def plain(row):
        parts = [str(v) if not isinstance(v, Decimal) else f"{v:.2f}" for v in row if v is not None]
        return hashlib.md5("|".join(parts).encode()).hexdigest()

    got = df.select("*", row_hash(df.columns).alias("h")).collect()
    assert len(got) == 500
    for r in got:
        assert r.h == plain(tuple(r)[:-1])


def test_elapsed(rows):
    data = [(i, _moment(), _moment()) for i in range(600)]
    df = rows("i int, a timestamp_ntz, b timestamp_ntz", *data)
    got = df.select("i", elapsed_minutes("a", "b").alias("m"), elapsed_days("a", "b").alias("d")).collect()
    given = {i: (a, b) for i, a, b in data}
    for r in got:
        a, b = given[r.i]
        if a is None or b is None:
            assert (r.m, r.d) == (None, None)
            continue
        micros = (b - a) // timedelta(microseconds=1)
        seconds = int((Decimal(micros) / 10**6).quantize(Decimal(1), ROUND_HALF_EVEN))
        assert r.m == int(seconds / 60)
        assert r.d == int(micros / (86400 * 10**6))


def test_exact_ratio(rows):
    data = [(RND.randrange(-10**12, 10**12), RND.randrange(0, 10**4)) for _ in range(400)] + [(1, 8), (-1, 8), (5, 200)]
    df = rows("n bigint, d bigint", *data)
    for r in df.select("n", "d", exact_ratio(F.col("n"), F.col("d"), 2).alias("q")).collect():
        if r.d == 0:
            assert r.q is None
        else:
            assert r.q == (Decimal(r.n) / r.d).quantize(Decimal("0.01"), ROUND_HALF_UP)


def test_date_key_and_moment(rows, spark):
    df = rows("t timestamp_ntz", (datetime(2021, 1, 3, 23, 59, 59),), (None,))
    assert [r.k for r in df.select(date_key(F.col("t")).alias("k")).collect()] == [20210103, None]
    row = spark.range(1).select(moment(datetime(2024, 6, 30, 1, 2, 3)).alias("m"))
    assert row.schema["m"].dataType.typeName() == "timestamp_ntz"
    assert row.first().m == datetime(2024, 6, 30, 1, 2, 3)
