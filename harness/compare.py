"""Run registered queries next to their SQL in DuckDB and compare all values.

    python -m harness.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from harness import catalog, oracles
from lamina.session import local_session


def open_duckdb(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def _canonical(row: tuple) -> tuple:
    return tuple(round(v, 9) if isinstance(v, float) else v for v in row)


def differences(spark: SparkSession, con, sf_dir: str, name: str) -> tuple[list[str], int, float]:
    """Problems found (none when equal), number of rows, Spark seconds."""
    start = time.time()
    df = catalog.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = [tuple(r) for r in df.select(*columns).collect()]
    seconds = time.time() - start
    sql = oracles.oracle_sql().get(name)
    if sql is None:
        return [], len(ours), seconds
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return [f"columns {columns} != {sorted(names)}"], len(ours), seconds
    order = [names.index(c) for c in columns]
    theirs = [tuple(r[i] for i in order) for r in result.fetchall()]
    problems = []
    for i, c in enumerate(columns):
        kinds = [{type(r[i]).__name__ for r in rows if r[i] is not None} for rows in (ours, theirs)]
        if kinds[0] != kinds[1]:
            problems.append(f"{c}: {kinds[0]} != {kinds[1]}")
    a, b = Counter(map(_canonical, ours)), Counter(map(_canonical, theirs))
    if a != b:
        problems.append(f"rows {len(ours)} / {len(theirs)}; only here {list((a - b).items())[:2]}; "
                        f"only there {list((b - a).items())[:2]}")
    return problems, len(ours), seconds


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(catalog.queries())
    spark, con, bad = local_session("compare"), open_duckdb(sf_dir), 0
    for name in names:
        try:
            problems, rows, seconds = differences(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problems, rows, seconds = [f"{type(error).__name__}: {str(error)[:1500]}"], -1, 0.0
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name:28} {rows:8} rows {seconds:6.2f}s", flush=True)
        for problem in problems:
            print("     ", problem)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
