"""Compare a Spark result with DuckDB on the same tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(value)
    if isinstance(value, bool) or value is None:
        return value
    return float(value) if isinstance(value, int) else value


def _sorted_rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when names, row counts and all values agree."""
    ours = _sorted_rows(df.columns, df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = _sorted_rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} and {len(theirs)} rows"
    unequal = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(unequal)} rows differ, first {str(unequal[0])[:600]}" if unequal else None
