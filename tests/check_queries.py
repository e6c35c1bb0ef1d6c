"""Compare named queries with their SQL: ``python tests/check_queries.py [sf] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = """region nation customer supplier part orders lineitem events
documents embeddings pages benchmark labels conversations""".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        con.execute(f"create view {table} as select * from '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def rows(columns: list[str], values) -> list[tuple]:
    """Rows in a fixed order, columns by name, values as comparable text."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_text(row[i]) for i in order) for row in values)


def _text(value) -> str:
    if value is None or value is pd.NaT:
        return "null"
    return f"{value:.6f}" if isinstance(value, float) else str(value)


def differences(spark, con, name: str, run, sql: str, sf_dir: str) -> str | None:
    df = run(spark, sf_dir)
    table = df.toArrow()
    got = rows(table.column_names, zip(*[c.to_pylist() for c in table.columns]))
    answer = con.sql(sql).to_arrow_table()
    want = rows(answer.column_names, zip(*[c.to_pylist() for c in answer.columns]))
    if sorted(table.column_names) != sorted(answer.column_names):
        return f"columns {sorted(table.column_names)} / {sorted(answer.column_names)}"
    types = {c: str(table.schema.field(c).type) for c in table.column_names}
    other = {c: str(answer.schema.field(c).type) for c in table.column_names}
    notes = [f"{c}: {types[c]} / {other[c]}" for c in types if types[c].replace("large_", "") != other[c]]
    if len(got) != len(want):
        return f"{len(got)} rows / {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    if wrong:
        return f"{len(wrong)} of {len(got)} rows differ, first {wrong[0]}"
    return "types " + "; ".join(notes) if notes else None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from clickloom import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = oracle_sql()
    for name, run in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        began = time.time()
        try:
            result = differences(spark, con, name, run, oracles[name], sf_dir) or "ok"
        except Exception as error:
            result = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:26s} {time.time() - began:6.2f}s  {result}", flush=True)


if __name__ == "__main__":
    main()
