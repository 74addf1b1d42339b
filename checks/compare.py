"""Run registered queries next to their DuckDB twins: python -m checks.compare [sf_dir] [names...]."""

from __future__ import annotations

import numbers
import sys
import time

import duckdb
import pandas as pd

from checks.bindings import BASE
from checks.oracles import ORACLES
from checks.queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in BASE:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(frame: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if v is None or v is pd.NA or (isinstance(v, float) and v != v):
            return "NULL"
        if isinstance(v, numbers.Number) and not isinstance(v, bool):
            return repr(float(v))
        return str(v)

    ordered = frame[sorted(frame.columns)]
    return sorted(tuple(cell(v) for v in row) for row in ordered.itertuples(index=False, name=None))


def difference(mine: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    """None when equal, else a short account."""
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"columns {sorted(mine.columns)} vs {sorted(theirs.columns)}"
    a, b = normal(mine), normal(theirs)
    if a == b:
        return None
    left, right = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    return f"rows {len(a)} vs {len(b)}; {len(left)}/{len(right)} differ\n  spark {left[:2]}\n  duck  {right[:2]}"


def main(argv: list[str]) -> int:
    from shelfsight.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session(
        "checks", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names:
        started = time.time()
        try:
            mine = QUERIES[name](spark, sf_dir).toPandas()
            took = time.time() - started
            if name not in ORACLES:
                print(f"rows  {name:28s} {took:6.1f}s {len(mine)} rows", flush=True)
                continue
            started = time.time()
            theirs = con.execute(ORACLES[name]).df()
            account = difference(mine, theirs)
            print(f"{'OK   ' if account is None else 'DIFF '} {name:28s} {took:6.1f}s duck {time.time() - started:5.1f}s {len(mine)} rows {account or ''}", flush=True)
            bad += account is not None
        except Exception as error:  # report and go on with the next query
            bad += 1
            print(f"FAIL  {name:28s} {type(error).__name__}: {str(error)[:700]}", flush=True)
    print(f"{bad} of {len(names)} not equal; without twin: {sorted(set(names) - set(ORACLES))}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
