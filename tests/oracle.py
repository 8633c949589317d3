"""Runs registered queries against their SQL twins; also usable as a script.

    python -m tests.oracle [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import tempfile
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark, con, sf_dir: str, run, sql: str) -> str | None:
    """None when both sides hold the same rows under the same column names."""
    df = run(spark, sf_dir)
    twin = con.sql(sql)
    if sorted(df.columns) != sorted(twin.columns):
        return f"columns {sorted(df.columns)} vs {sorted(twin.columns)}"
    ours, theirs = rows_of(df.columns, df.collect()), rows_of(twin.columns, twin.fetchall())
    if not ours:
        return "no rows"
    if ours == theirs:
        return None
    return f"{sum(ours.values())} vs {sum(theirs.values())} rows; ours only {list((ours - theirs).items())[:2]}; theirs only {list((theirs - ours).items())[:2]}"


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from salesflow.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.001"
    shared = {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="oracle-")}
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8"}, **shared)
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if len(argv) > 1 and name not in argv[1:]:
            continue
        began = time.time()
        try:
            if name in sqls:
                found = differences(spark, con, sf_dir, run, sqls[name])
            else:
                found = None if run(spark, sf_dir).count() else "no rows"
        except Exception as exc:
            found = f"{type(exc).__name__}: {str(exc)[:700]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - began:.1f}s {found or ''}", flush=True)
    print(f"{bad} of {len(queries())} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
