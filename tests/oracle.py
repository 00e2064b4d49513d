"""Compares registered queries with their reference SQL.

``python -m tests.oracle /root/testdata/sf0.01 [name ...]`` checks from the shell.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

from __spark_entry__ import ALL_ORACLES as ORACLES
from __spark_entry__ import ALL_QUERIES as QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def _sorted(rows, order):
    shaped = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(shaped, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def differences(spark, con, sf_dir: str, name: str) -> list[str]:
    """Empty when columns, types and all rows agree."""
    ours = QUERIES[name](spark, sf_dir)
    theirs = con.execute(ORACLES[name])
    their_names = [d[0] for d in theirs.description]
    their_rows = theirs.fetchall()
    if sorted(ours.columns) != sorted(their_names):
        return [f"columns {sorted(ours.columns)} vs {sorted(their_names)}"]
    names = sorted(ours.columns)
    left = _sorted([tuple(r) for r in ours.collect()], [ours.columns.index(n) for n in names])
    right = _sorted(their_rows, [their_names.index(n) for n in names])
    found = [] if len(left) == len(right) else [f"{len(left)} rows vs {len(right)}"]
    for a, b in zip(left, right):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            bad = [(n, x, y) for n, x, y in zip(names, a, b) if x != y or type(x) is not type(y)]
            found.append(f"first difference {bad}")
            break
    return found


def main(sf_dir: str, names: list[str]) -> int:
    from skyledger.session import build_session

    spark = build_session("oracle", master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names or list(QUERIES):
        start = time.time()
        try:
            found = differences(spark, con, sf_dir, name)
        except Exception as error:  # one broken query must not hide the others
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"\n{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s {' '.join(found)[:1500]}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
