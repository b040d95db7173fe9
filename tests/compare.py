"""Run every registered query next to its SQL counterpart and report the differences.

    python tests/compare.py <sf_dir> [query …]
"""

from __future__ import annotations

import math
import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from basketlens.registry.oracle import all_oracles  # noqa: E402
from basketlens.registry.queries import all_queries  # noqa: E402
from basketlens.session import local_session  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(pathlib.Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def cell(value):  # noqa: ANN001, ANN201
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value) if isinstance(value, int) else str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:  # noqa: ANN001
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:  # noqa: ANN001
    """None when columns and all values agree, else a short description."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    got = rows_of(df.columns, df.collect())
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{sum(a != b for a, b in zip(got, want))} of {len(got)} rows differ, first {g} != {w}"
    return None


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, con, oracles = local_session(), connect(sf_dir), all_oracles()
    bad = 0
    for name, fn in all_queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracles:
                problem = difference(df, con, oracles[name])
                outcome = "ok" if problem is None else f"DIFF {problem}"
            else:
                outcome = f"rows {df.count()}"
        except Exception as exc:  # noqa: BLE001
            outcome = f"ERROR {type(exc).__name__}: {str(exc)[:600]}"
        bad += outcome.startswith(("DIFF", "ERROR"))
        print(f"{name:32s} {time.time() - start:6.1f}s  {outcome}", flush=True)
    print(f"{bad} problems")


if __name__ == "__main__":
    main()
