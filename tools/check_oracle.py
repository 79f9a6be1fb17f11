"""Run registered queries next to their SQL and compare names, rows and values.

    python tools/check_oracle.py <sf_dir> [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from citylake.catalog.all import ORACLES, QUERIES  # noqa: E402
from citylake.session import build_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def kind(value) -> str:
    for types, name in (
        ((bool,), "bool"),
        ((int,), "int"),
        ((float,), "float"),
        ((decimal.Decimal,), "decimal"),
        ((datetime.datetime,), "timestamp"),
        ((datetime.date,), "date"),
    ):
        if isinstance(value, types):
            return name
    return type(value).__name__


def canon(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(str, map(canon, value))) + "]"
    return str(value)


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(canon(r[i]) for i in order) for r in rows)


# Row-at-a-time Python, pairwise products and unbounded per-group lists.
UNWANTED = ("PythonUDF", "EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "collect_list", "collect_set")


def compare(spark, con, sf_dir: str, name: str) -> list[str]:
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    problems = [f"plan contains {word}" for word in UNWANTED if word in plan]
    if name not in ORACLES:
        return problems if df.collect() else [*problems, "no rows"]
    return problems + difference(df, con, ORACLES[name])


def difference(df, con, sql: str) -> list[str]:
    """How the rows of `df` differ from those of `sql`: names, count, types, values."""
    problems, got = [], df.collect()
    rel = con.execute(sql)
    columns = [d[0] for d in rel.description]
    want = rel.fetchall()
    a_cols, a = rows_of(df.columns, got)
    b_cols, b = rows_of(columns, want)
    if a_cols != b_cols:
        return [f"columns differ: only spark {set(a_cols) - set(b_cols)}, only sql {set(b_cols) - set(a_cols)}"]
    if len(a) != len(b):
        problems.append(f"rows {len(a)} vs {len(b)}")
    for i, c in enumerate(df.columns):
        ka = {kind(r[i]) for r in got if r[i] is not None}
        j = columns.index(c)
        kb = {kind(r[j]) for r in want if r[j] is not None}
        if ka != kb:
            problems.append(f"type of {c}: {ka} vs {kb}")
    if a != b:
        only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
        problems.append(f"{len(only_a)} rows only in spark, {len(only_b)} only in sql; columns {a_cols}\n   {only_a[:2]}\n   {only_b[:2]}")
    if not got:
        problems.append("EMPTY")
    return problems


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "oracle-check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problems = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        mark = "ok " if not problems else "BAD"
        bad += bool(problems)
        print(f"{mark} {name:28s} {time.time() - start:6.2f}s {'' if name in ORACLES else '(rows only)'} {' | '.join(problems)}", flush=True)
    print(f"{len(names) - bad}/{len(names)} fine")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
