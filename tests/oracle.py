"""Run registered queries beside their SQL and compare rows, columns and types."""

from __future__ import annotations

import math
import os
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
DIGITS = int(os.environ.get("ORACLE_DIGITS", "12"))  # 17 compares every bit
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE", "float": "FLOAT",
    "string": "VARCHAR", "boolean": "BOOLEAN",
}


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.{DIGITS}g}") + 0.0
    return v


def _sorted(rows):
    return sorted((tuple(_cell(v) for v in r) for r in rows), key=repr)


UNWANTED = (
    "BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
)


def compare(spark, con, name: str, query, sql: str, sf: str) -> list[str]:
    """Problems found in rows, columns, types or the plan; empty when there are none."""
    df = query(spark, sf)
    columns = sorted(df.columns)
    plan = df._jdf.queryExecution().executedPlan().toString()
    if any(u in plan for u in UNWANTED):
        return [f"{name}: plan has {[u for u in UNWANTED if u in plan]}"]
    got = _sorted(df.select(*columns).collect())
    described = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    problems = []
    if sorted(described) != columns:
        return [f"{name}: columns {columns} against {sorted(described)}"]
    for c, kind in df.dtypes:
        if KINDS.get(kind) != described[c]:
            problems.append(f"{name}: type of {c}: {kind} against {described[c]}")
    want = _sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall())
    if len(got) != len(want):
        problems.append(f"{name}: {len(got)} rows against {len(want)}")
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        problems.append(f"{name}: {len(bad)} rows differ, first {bad[0]}")
    if not want:
        problems.append(f"{name}: no rows")
    return problems


def run_all(spark, sf: str, only: list[str] | None = None) -> int:
    from metforge.workload import ORACLES, QUERIES

    con, failed = connect(sf), 0
    for name, q in QUERIES.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problems = compare(spark, con, name, q, ORACLES[name], sf) if name in ORACLES else []
        except Exception as e:  # report and go on with the next query
            problems = [f"{name}: {type(e).__name__}: {str(e)[:700]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.2f}s", *problems, sep="\n     " if problems else " ", flush=True)
    print(f"{failed} failed of {len(only or QUERIES)}")
    return failed


if __name__ == "__main__":
    import sys

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from metforge.session import local_session

    session = local_session()
    sys.exit(run_all(session, sys.argv[1], sys.argv[2:] or None))
