"""Compare a Spark result with a DuckDB result, value by value, in any row order.

As a script: `python tests/compare.py [sf_dir] [query ...]` checks all or the named queries.
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]
SPARK_TO_DUCK = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def differences(df, con, sql: str) -> str | None:
    """None when columns, types and rows agree, else a short account."""
    rel = con.sql(sql)
    spark_types = {c: SPARK_TO_DUCK.get(t, t.upper()) for c, t in df.dtypes}
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    if set(spark_types) != set(duck_types):
        return f"columns {sorted(spark_types)} != {sorted(duck_types)}"
    wrong = {c: (spark_types[c], duck_types[c]) for c in spark_types if spark_types[c] != duck_types[c]}
    if wrong:
        return f"types {wrong}"
    order = sorted(spark_types)
    got = Counter(tuple(r[c] for c in order) for r in df.collect())
    at = [rel.columns.index(c) for c in order]
    want = Counter(tuple(r[i] for i in at) for r in rel.fetchall())
    if got == want:
        return None
    return (
        f"{order}\n  rows {got.total()} != {want.total()}; only Spark {list((got - want).items())[:3]}; "
        f"only SQL {list((want - got).items())[:3]}"
    )


def main() -> int:
    import __spark_entry__ as entry
    from claimflow.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            diff = differences(entry.queries()[name](spark, sf_dir), con, entry.oracle_sql()[name])
        except Exception as e:  # report and go on
            diff = f"{type(e).__name__}: {str(e)[:600]}"
        failed += diff is not None
        print(f"{'ok  ' if diff is None else 'FAIL'} {name} {time.time() - start:.2f}s {diff or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
