"""Run registered queries in Spark and their SQL twins in DuckDB and compare."""

from __future__ import annotations

import math
import os
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for table in TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    return repr(value)


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(row[i]) for i in order) for row in rows)


def spark_result(df):
    rows = [tuple(r) for r in df.collect()]
    return normalised(df.columns, rows)


def duck_result(connection, sql):
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    return normalised(columns, cursor.fetchall())


def kinds(df):
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


KIND = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def difference(spark, connection, query, sql, sf_dir):
    """None when equal, else a short description."""
    df = query(spark, sf_dir)
    columns, rows = spark_result(df)
    twin_columns, twin_rows = duck_result(connection, sql)
    if columns != twin_columns:
        return f"columns {columns} != {twin_columns}"
    described = {r[0]: r[1] for r in connection.execute("DESCRIBE " + sql).fetchall()}
    types = {n: (k, KIND.get(described[n], described[n])) for n, k in kinds(df).items()}
    bad = {n: t for n, t in types.items() if t[0] != t[1]}
    if bad:
        return f"types {bad}"
    if len(rows) != len(twin_rows):
        return f"rows {len(rows)} != {len(twin_rows)}"
    wrong = [(a, b) for a, b in zip(rows, twin_rows) if a != b]
    if wrong:
        return f"{len(wrong)} rows differ, first {wrong[0]}"
    if not rows:
        return "both sides empty"
    return None


def main(sf_dir, names):
    import sys

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from scorelab.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    registered, twins = queries(), oracle_sql()
    for name in names or registered:
        start = time.time()
        try:
            if name in twins:
                outcome = difference(spark, connection, registered[name], twins[name], sf_dir) or "equal"
            else:
                outcome = f"rows only: {registered[name](spark, sf_dir).count()}"
        except Exception as error:
            outcome = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:32s} {time.time() - start:6.2f}s {outcome}", flush=True)


if __name__ == "__main__":
    import sys

    main(sys.argv[1], sys.argv[2:])
