"""Runs registered queries against their oracle SQL: python tests/compare.py SF_DIR [names]."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem".split()


def normal(value):
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(row[i]) for i in order) for row in rows)


def oracle(con, sql):
    result = con.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    return list(types), result.fetchall(), types


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("set threads to 4")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def difference(spark_df, con, sql):
    """None when equal, otherwise a short description."""
    columns = spark_df.columns
    got = rows_of(columns, [tuple(r) for r in spark_df.collect()])
    o_columns, o_rows, types = oracle(con, sql)
    if sorted(columns) != sorted(o_columns):
        return f"columns {sorted(columns)} / {sorted(o_columns)}"
    want = rows_of(o_columns, o_rows)
    names = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
             "TIMESTAMP": "timestamp_ntz", "HUGEINT": "hugeint"}
    kinds = {c: t for c, t in spark_df.dtypes}
    odd = {c: (kinds[c], types[c]) for c in columns if names.get(types[c], types[c]) != kinds[c]}
    note = f" types {odd}" if odd else ""
    if got != want:
        extra, lacking = list((got - want).items())[:2], list((want - got).items())[:2]
        return f"rows {sum(got.values())} / {sum(want.values())}: only spark {extra} only oracle {lacking}{note}"
    return note or None


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(entry.queries())
    con, sql = connect(sf_dir), entry.oracle_sql()
    for name in names:
        started = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            outcome = difference(df, con, sql[name]) if name in sql else f"no oracle, {len(df.collect())} rows"
        except Exception as error:  # report and go on with the next query
            outcome = f"ERROR {type(error).__name__} {str(error)[:600]}"
        print(f"{name:26s} {time.time() - started:6.2f} {'equal' if outcome is None else outcome}", flush=True)


if __name__ == "__main__":
    main()
