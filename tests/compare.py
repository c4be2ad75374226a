"""Run registered queries against DuckDB on the same tables and compare rows and types.

    python tests/compare.py [folder] [query ...]
"""

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def key(row):
    return tuple((v is not None, str(type(v)) if v is None else v) for v in row)


def difference(df, con, sql):
    """None when both sides agree, else what differs."""
    rel = con.sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    mine = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    theirs = dict(zip(rel.columns, map(str, rel.types)))
    for c in mine:
        if mine[c] != theirs[c]:
            return f"type of {c}: {mine[c]} != {theirs[c]}"
    names = sorted(df.columns)
    left = sorted((tuple(r[c] for c in names) for r in df.collect()), key=key)
    order = [rel.columns.index(c) for c in names]
    right = sorted((tuple(r[i] for i in order) for r in rel.fetchall()), key=key)
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    for a, b in zip(left, right):
        for c, x, y in zip(names, a, b):
            same = x == y or (
                isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y)
            )
            if not same:
                return f"{c}: {x!r} != {y!r} in {a} / {b}"
    return None if left else "no rows on either side"


if __name__ == "__main__":
    from devpulse.registry import ORACLE, QUERIES
    from devpulse.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            if name in ORACLE:
                problem = difference(df, con, ORACLE[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(wanted) - bad}/{len(wanted)} agree, {len(ORACLE)} of {len(QUERIES)} have SQL")
