"""Run the registered queries next to their DuckDB SQL."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else repr(round(value, 6) + 0.0))
    return (1, repr(value))


def rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_key(record[i]) for i in order) for record in records)


FAMILY = {"bigint": "int64", "int": "int32", "double": "double", "string": "text", "date": "date",
          "boolean": "bool", "BIGINT": "int64", "INTEGER": "int32", "DOUBLE": "double", "VARCHAR": "text",
          "DATE": "date", "BOOLEAN": "bool"}


def difference(df, con, sql: str) -> str | None:
    """What differs between a Spark result and a DuckDB one, or None."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected_types = {d[0]: FAMILY.get(str(d[1]), str(d[1])) for d in cursor.description}
    types = {name: FAMILY.get(kind, kind) for name, kind in df.dtypes}
    if types != expected_types:
        return f"types {types} / {expected_types}"
    expected = rows(names, cursor.fetchall())
    found = rows(df.columns, [tuple(row) for row in df.collect()])
    if len(found) != len(expected):
        return f"rows {len(found)} / {len(expected)}"
    for a, b in zip(found, expected):
        if a != b:
            return f"{a} / {b}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as contract
    from retailloom.session import session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = session(master="local[8]", spark_sql_shuffle_partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracle = contract.oracle_sql()
    for name, build in contract.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in oracle:
                result = difference(build(spark, folder), con, oracle[name]) or "ok"
            else:
                result = f"no SQL, {build(spark, folder).count()} rows"
        except Exception as error:
            result = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28s} {time.time() - start:6.2f}  {result}", flush=True)
