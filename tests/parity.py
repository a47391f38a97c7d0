"""Compare registered queries with their SQL in DuckDB: ``python tests/parity.py [sf] [name ...]``."""

from __future__ import annotations

import datetime
import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, datetime.datetime) and value.tzinfo:
        return value.astimezone(datetime.timezone.utc).replace(tzinfo=None)
    return value + 0.0 if isinstance(value, float) else value  # -0.0 and 0.0 are one value


def rows_of(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


_TYPES = {
    "string": {"VARCHAR"}, "bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"},
    "boolean": {"BOOLEAN"}, "date": {"DATE"}, "timestamp_ntz": {"TIMESTAMP"}, "timestamp": {"TIMESTAMP"},
}


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    df = entry.queries()[name](spark, sf_dir)
    got = df.collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return len(got) > 0, f"{len(got)} rows, no SQL"
    cursor = con.execute(sql)
    description = [(d[0], str(d[1])) for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(df.columns) != sorted(d[0] for d in description):
        return False, f"columns {sorted(df.columns)} != {sorted(d[0] for d in description)}"
    types = {d[0]: d[1] for d in description}
    for column, dtype in df.dtypes:
        if types[column] not in _TYPES.get(dtype, {dtype}):
            return False, f"type of {column}: {dtype} against {types[column]}"
    left = rows_of(df.columns, got)
    right = rows_of([d[0] for d in description], expected)
    if left != right:
        only_left = [r for r in left if r not in set(right)][:3] if len(left) < 2e5 else []
        only_right = [r for r in right if r not in set(left)][:3] if len(left) < 2e5 else []
        return False, f"rows {len(left)} against {len(right)}; only spark {only_left}; only sql {only_right}"
    return len(left) > 0, f"{len(left)} rows"


if __name__ == "__main__":
    from tidemark.session import build_session

    scale = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"{TESTDATA}/sf{scale}"
    session = build_session(
        "parity", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false"
    )
    session.sparkContext.setLogLevel("ERROR")
    database = connect(folder)
    failed = []
    for query_name in sys.argv[2:] or entry.queries():
        started = time.time()
        try:
            good, note = compare(session, database, query_name, folder)
        except Exception as error:  # report and go on with the next query
            good, note = False, f"{type(error).__name__}: {str(error)[:900]}"
        print(f"{'ok  ' if good else 'FAIL'} {query_name:32s} {time.time() - started:6.2f}s {note}", flush=True)
        if not good:
            failed.append(query_name)
    print("failed:", failed)
