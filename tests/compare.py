"""Run registered queries against their SQL counterparts: ``python tests/compare.py FOLDER [NAME ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda number: names[number])
    return sorted((tuple(row[number] for number in order) for row in rows), key=repr)


def differences(spark_df, connection, sql: str) -> str | None:
    """None if both give the same columns and rows, else the first difference."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    wanted = _rows(names, result.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} instead of {sorted(names)}"
    got = _rows(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    if got == wanted:
        return None
    extra, missing = set(got) - set(wanted), set(wanted) - set(got)
    return (
        f"{len(got)} rows instead of {len(wanted)}; extra {len(extra)}: {str(sorted(extra, key=repr)[:1])[:1500]}; "
        f"missing {len(missing)}: {str(sorted(missing, key=repr)[:1])[:1500]}"
    )


def main(folder: str, chosen: list[str]) -> int:
    from corpusforge import build_session
    from __spark_entry__ import oracle_sql, queries

    spark = build_session(
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    oracles, failed = oracle_sql(), 0
    for name, query in queries().items():
        if chosen and name not in chosen:
            continue
        begun = time.time()
        try:
            df = query(spark, folder)
            if name not in oracles:
                problem = f"no SQL; {df.count()} rows"
            else:
                problem = differences(df, connection, oracles[name])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{name:20} {time.time() - begun:6.2f}s {problem or 'same'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
