"""Compare registered queries with their SQL oracle, value by value.

``python tests/oracle.py [sf_dir] [name-prefix ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    return value


def _rows(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, con, sql) -> str | None:
    """None when both sides agree, else what differs."""
    result = con.sql(sql)
    ours, theirs = sorted(df.columns), sorted(result.columns)
    if ours != theirs:
        return f"columns {ours} != {theirs}"
    left = _rows(df.columns, df.collect())
    right = _rows(result.columns, result.fetchall())
    if left == right:
        kinds = {c: str(t) for c, t in zip(result.columns, result.types)}
        odd = [
            f"{f.name}: {f.dataType.simpleString()} vs {kinds[f.name]}"
            for f in df.schema
            if SAME_KIND.get(f.dataType.simpleString()) != kinds[f.name]
        ]
        return f"types {odd}" if odd else None
    only_left, only_right = left - right, right - left
    return (
        f"rows {sum(left.values())} vs {sum(right.values())}; "
        f"only ours {list(only_left)[:2]}; only oracle {list(only_right)[:2]}"
    )


SAME_KIND = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry
    from hearth.session import release

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracle = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        begin = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracle:
                problem = difference(df, con, oracle[name])
                rows = len(df.columns)
            else:
                problem, rows = None, df.count()
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}".replace("\n", " ")
        bad += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name} {time.time() - begin:.2f}s {problem or ''}", flush=True)
    print("failures:", bad)
    release(spark)


if __name__ == "__main__":
    main()
