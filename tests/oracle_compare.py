"""Run a registered Spark query and its DuckDB oracle SQL, compare the results.

Comparison mirrors the driver's gate: same column names and Arrow types, same
row count and the same multiset of rows (columns sorted by name, rows
sorted).  Floats are compared exactly.
"""

from __future__ import annotations

import math
import sys

import duckdb
from pyspark.sql.pandas.types import to_arrow_type

TABLES = ("orders", "lineitem")


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float) and math.isnan(v):
        return (0, "nan")
    if hasattr(v, "isoformat"):
        return (1, v.isoformat())
    return (1, v)


def _rows(columns, tuples):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in tuples]
    return sorted(out, key=repr), [columns[i] for i in order]


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> tuple[bool, str]:
    sdf = query(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    table = con.sql(sql).to_arrow_table()
    d_cols = table.column_names
    d_rows = [tuple(r.values()) for r in table.to_pylist()]
    s_sorted, s_cols = _rows(sdf.columns, s_rows)
    d_sorted, d_cols = _rows(d_cols, d_rows)
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    s_types = {f.name: str(to_arrow_type(f.dataType)) for f in sdf.schema.fields}
    d_types = {f.name: str(f.type) for f in table.schema}
    if s_types != d_types:
        diff = {k: (s_types[k], d_types[k]) for k in s_types if s_types[k] != d_types[k]}
        return False, f"types differ: {diff}"
    if len(s_sorted) != len(d_sorted):
        return False, f"row count spark={len(s_sorted)} duck={len(d_sorted)}"
    diffs = [(a, b) for a, b in zip(s_sorted, d_sorted) if a != b]
    if diffs:
        return False, f"{len(diffs)} differing rows, first: spark={diffs[0][0]} duck={diffs[0][1]}"
    return True, f"{len(s_sorted)} rows"


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from crease.session import local_session

    spark = local_session()
    con = duck_connection(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            print(f"{name:22s} (no oracle)")
            continue
        ok, msg = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        bad += not ok
        print(f"{name:22s} {'OK ' if ok else 'BAD'} {msg}", flush=True)
    return bad


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1], sys.argv[2:]))
