"""Run queries beside their SQL and compare rows regardless of order."""

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(r[i] for i in order) for r in rows], key=repr)


def spark_rows(df):
    return canonical([tuple(r) for r in df.collect()], df.columns)


def sql_rows(con, text):
    cursor = con.execute(text)
    columns = [d[0] for d in cursor.description]
    return canonical(cursor.fetchall(), columns)


def differences(spark_result, sql_result):
    (columns, got), (expected_columns, expected) = spark_result, sql_result
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    for a, b in zip(got, expected):
        # repr tells -0.0 from 0.0 and 1 from 1.0
        if repr(a) != repr(b):
            return f"{a} != {b}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as contract

    from tradewind.session import build_session

    sf_dir, *names = sys.argv[1:]
    spark = build_session(master="local[8]", shuffle_partitions=8, **{"spark.driver.memory": "8g", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = connect(sf_dir), contract.oracle_sql(), 0
    for name, query in contract.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = spark_rows(query(spark, sf_dir))
            took = time.time() - start
            problem = differences(got, sql_rows(con, sqls[name])) if name in sqls else "no SQL"
        except Exception as error:  # noqa: BLE001
            problem, took = f"{type(error).__name__}: {str(error)[:700]}", time.time() - start
        failed += problem is not None
        print(f"{name:32s} {took:6.2f}s rows={len(got[1]) if 'got' in dir() else '-':>6} {problem or 'ok'}", flush=True)
    print("failed", failed)
