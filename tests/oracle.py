"""Run registered queries and compare them with their SQL in an embedded database.

    python tests/oracle.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(value):
    if value is None or value is pd.NaT:
        return None
    if hasattr(value, "tolist") and not isinstance(value, (str, bytes)):
        value = value.tolist()
    if isinstance(value, list):
        return tuple(_cell(v) for v in value)
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return float(f"{value:.9g}")
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    return value


def _sort_key(row):
    return tuple((v is not None, str(type(v).__name__ in ("int", "float")), f"{v:030.9f}" if isinstance(v, (int, float)) else str(v)) for v in row)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=_sort_key)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT",
}


def compare(con, spark_df, sql: str) -> str | None:
    """None when equal, else what differs."""
    result = con.sql(sql)
    kinds = {c: str(t) for c, t in zip(result.columns, result.types)}
    want_names, want = rows_of(result.columns, result.fetchall())
    got_names, got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    loose = [
        (c, t, kinds[c]) for c, t in spark_df.dtypes if KINDS.get(t, t) != kinds[c]
    ]
    if loose:
        return f"types {loose}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, e.g. {bad[:2]} in {got_names}"
    return None


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(folder: str, wanted: list[str]) -> int:
    from gradus.queries import QUERIES, SQL

    con, spark, failed = connect(folder), session(), 0
    for name, fn in QUERIES.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            if name in SQL:
                problem = compare(con, df, SQL[name])
                size = "equal"
            else:
                problem, size = None, f"{len(df.collect())} rows, no SQL"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"\n{"FAIL" if problem else 'ok  '} {name:32s} {time.time() - start:6.2f}s {problem or size}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
