"""Compare the registered queries with their SQL: ``python -m checks.run [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import tempfile
import time
import traceback

import duckdb
from pyspark.sql import SparkSession

from checks import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def local_session(cpus: str = "8", partitions: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("marketlake")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file:{tempfile.mkdtemp(prefix='marketlake-')}")
        .config("spark.driver.memory", "8g")
        # A few MB per task, so that the small tables still use all cores.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
        .config("spark.sql.files.maxPartitionBytes", "4m")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def cell(value: object) -> str:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def normalized(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def difference(names: list[str], rows: list[tuple], connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if the SQL gives the same columns and rows."""
    cursor = connection.execute(sql)
    wanted_names = [d[0] for d in cursor.description]
    wanted_rows = cursor.fetchall()
    if sorted(names) != sorted(wanted_names):
        return f"columns {sorted(names)} != {sorted(wanted_names)}"
    if len(rows) != len(wanted_rows):
        return f"{len(rows)} rows != {len(wanted_rows)}"
    ours, theirs = normalized(names, rows), normalized(wanted_names, wanted_rows)
    if ours != theirs:
        pairs = [(a, b) for a, b in zip(ours, theirs) if a != b]
        return f"{len(pairs)} rows differ, first {str(pairs[0])[:600]}"
    return None


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, connection = local_session(), oracle_connection(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            if name in ORACLES:
                found = difference(df.columns, rows, connection, ORACLES[name])
            else:
                found = None if rows else "no rows"
        except Exception as error:  # report and go on with the other queries
            found = f"{type(error).__name__}: {str(error)[:700]}"
            if "-v" in sys.argv:
                traceback.print_exc()
            rows = []
        bad += found is not None
        kind = "sql " if name in ORACLES else "rows"
        print(f"{'FAIL' if found else 'ok  '} {kind} {name} {len(rows)} {time.time() - start:.2f}s {found or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return int(bad > 0)


if __name__ == "__main__":
    sys.exit(main())
