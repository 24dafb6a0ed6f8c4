"""Compare registered queries with their SQL. Usage: python tests/compare.py [sf_dir] [names…]"""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


# Spark type to the DuckDB type of the same values.
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}


def compare(spark, con, name, sf_dir):
    """Empty string if names, types and the multiset of rows agree, else what differs."""
    from __spark_entry__ import oracle_sql, queries

    df = queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    relation = con.sql(oracle_sql()[name])
    expected_types = dict(zip(relation.columns, map(str, relation.types)))
    actual_types = {c: TYPES.get(t, t) for c, t in df.dtypes}
    if expected_types != actual_types:
        return f"schema {actual_types} != {expected_types}"
    actual = Counter(tuple(r) for r in df.select(*columns).collect())
    order = [relation.columns.index(c) for c in columns]
    expected = Counter(tuple(r[i] for i in order) for r in relation.fetchall())
    if actual == expected:
        return "" if actual else "no rows"
    extra, missing = list((actual - expected).items())[:2], list((expected - actual).items())[:2]
    return (
        f"{sum(actual.values())} rows, expected {sum(expected.values())}\n"
        f"  columns {columns}\n  only Spark {extra}\n  only SQL {missing}"
    )


def main():
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name in sys.argv[2:] or queries():
        if name not in oracle_sql():
            print("no SQL", name)
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the others
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        print(f"{'DIFF' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print("different:", bad)


if __name__ == "__main__":
    main()
