"""Runs queries against their SQL counterparts; also usable as a script:
`python tests/oracle.py SF_DIR [name ...]`."""

from __future__ import annotations

import math
import os
import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(pathlib.Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


EXACT = bool(os.environ.get("EXACT"))


def _cell(x):
    if EXACT:  # every bit and every type
        return None if x is None else repr(x)
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, bool):
        return x
    if hasattr(x, "as_tuple"):
        x = float(x)
    if isinstance(x, float):
        return float(f"{x:.12g}") + 0.0
    if isinstance(x, int):
        return x
    return str(x)


def _table(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, run, sql, sf_dir):
    """(problem or None, rows, seconds)."""
    start = time.time()
    df = run(spark, sf_dir)
    ours = df.collect()
    seconds = time.time() - start
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}", len(ours), seconds
    if len(ours) != len(theirs):
        return f"{len(ours)} rows, expected {len(theirs)}", len(ours), seconds
    a, b = _table(ours, df.columns), _table(theirs, names)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, first {bad[0]}", len(ours), seconds
    return None, len(ours), seconds


def main(sf_dir: str, wanted: list[str]) -> int:
    from tillstream.queries import QUERIES, SQL
    from tillstream.session import local_session

    spark, con, failed = local_session(), connect(sf_dir), 0
    for name, run in QUERIES.items():
        if wanted and name not in wanted:
            continue
        try:
            if name in SQL:
                problem, rows, seconds = compare(spark, con, run, SQL[name], sf_dir)
            else:
                start = time.time()
                rows, problem = run(spark, sf_dir).count(), None
                seconds = time.time() - start
        except Exception as exc:  # report and go on
            problem, rows, seconds = f"{type(exc).__name__}: {str(exc)[:600]}", -1, 0.0
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:40s} {rows:8d} rows {seconds:6.2f} s {problem or ''}", flush=True)
    print(f"{failed} failed of {len(wanted) or len(QUERIES)}; with SQL: {len(SQL)}")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
