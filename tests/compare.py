"""Run the named queries and their SQL side by side.

    python tests/compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def tables(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    return None if value is None else str(value)


def canonical(arrow) -> tuple[list[str], list[str], list[tuple]]:
    """Names, types and sorted rows, columns in name order."""
    names = sorted(arrow.column_names)
    types = [str(arrow.schema.field(n).type).replace("large_", "") for n in names]
    columns = [[_cell(v) for v in arrow.column(n).to_pylist()] for n in names]
    rows = sorted(zip(*columns), key=lambda r: tuple((v is None, v or "") for v in r))
    return names, types, rows


def difference(df, con, sql: str) -> str | None:
    """What differs first, or None."""
    ours, theirs = canonical(df.toArrow()), canonical(con.sql(sql).to_arrow_table())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} / {theirs[0]}"
    if ours[1] != theirs[1]:
        return f"types {list(zip(*ours[:2]))} / {theirs[1]}"
    if len(ours[2]) != len(theirs[2]):
        return f"rows {len(ours[2])} / {len(theirs[2])}"
    for a, b in zip(ours[2], theirs[2]):
        if a != b:
            return f"row {a} / {b}"
    return None


def main(folder: str, only: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from conftest import local_session

    spark, con, sql, failed = local_session(), tables(folder), oracle_sql(), 0
    for name, query in queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            found = difference(query(spark, folder), con, sql[name]) if name in sql else "no SQL"
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += found is not None
        print(f"{name:32s} {time.time() - start:6.2f} {found or 'ok'}", flush=True)
    print(f"{failed} differ")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
