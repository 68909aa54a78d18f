"""Compare queries with their SQL: ``python tests/oracle.py [scale] [query …]``."""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def rows_by_name(columns, rows):
    """Rows as tuples in the order of the column names, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(picked, key=repr)


def differences(frame, connection, sql):
    """What differs between a Spark result and its SQL, as text; empty when nothing does."""
    expected = connection.sql(sql)
    if sorted(frame.columns) != sorted(expected.columns):
        return f"columns {sorted(frame.columns)} != {sorted(expected.columns)}"
    ours = rows_by_name(frame.columns, [tuple(row) for row in frame.collect()])
    theirs = rows_by_name(expected.columns, expected.fetchall())
    if ours == theirs:
        return ""
    wrong = [pair for pair in zip(ours, theirs) if pair[0] != pair[1]]
    return f"{len(ours)} and {len(theirs)} rows; first difference {wrong[:1]}"


def main():
    import __spark_entry__ as entry_points
    from tidemill.session import build_session

    scale, *names = sys.argv[1:] or ["0.01"]
    sf_dir = f"/root/testdata/sf{scale}"
    spark = build_session(
        "oracle",
        "local[8]",
        {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
         "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    sql = entry_points.oracle_sql()
    bad = 0
    for name, query in entry_points.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            frame = query(spark, sf_dir)
            if name in sql:
                result = differences(frame, connection, sql[name])
            else:
                result = "" if frame.collect() else "no rows"
        except Exception as error:  # report and go on
            result = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(result)
        print(f"{'FAIL' if result else 'ok  '} {name} {time.time() - start:.1f}s {result}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
