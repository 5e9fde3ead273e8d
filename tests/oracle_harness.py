"""Side-by-side check of a Spark query against its DuckDB oracle.

Mirrors the driver's gate: same row count, same column names and types,
and the same multiset of rows (order-insensitive).  Usable from pytest and
from the command line::

    python tests/oracle_harness.py /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

SPARK_TO_DUCK = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "smallint": "SMALLINT",
    "tinyint": "TINYINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "nan")
        return (1, repr(v))
    if isinstance(v, dt.datetime):
        return (1, v.replace(tzinfo=None).isoformat())
    return (1, str(v))


def spark_rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return cols, sorted(rows), types


def duck_rows(con, sql: str):
    rel = con.sql(sql)
    names = list(rel.columns)
    types = {n: str(t) for n, t in zip(names, rel.types)}
    data = rel.fetchall()
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    rows = [tuple(_norm(r[i]) for i in idx) for r in data]
    return cols, sorted(rows), types


def compare(spark, con, key: str, fn, sql: str, sf_dir: str) -> list[str]:
    """Return a list of problems (empty when the key matches)."""
    df = fn(spark, sf_dir)
    s_cols, s_rows, s_types = spark_rows(df)
    d_cols, d_rows, d_types = duck_rows(con, sql)
    problems = []
    if s_cols != d_cols:
        problems.append(f"columns differ: spark={s_cols} duck={d_cols}")
        return problems
    for c in s_cols:
        want = SPARK_TO_DUCK.get(s_types[c], s_types[c].upper())
        if want != d_types[c]:
            problems.append(f"type of {c}: spark={s_types[c]} duck={d_types[c]}")
    if len(s_rows) != len(d_rows):
        problems.append(f"row count: spark={len(s_rows)} duck={len(d_rows)}")
    if s_rows != d_rows:
        diff_s = [r for r in s_rows if r not in set(d_rows)][:3]
        diff_d = [r for r in d_rows if r not in set(s_rows)][:3]
        problems.append(f"values differ; spark-only={diff_s} duck-only={diff_d}")
    return problems


def main(argv: list[str]) -> int:
    import time

    from __spark_entry__ import oracle_sql, queries
    from strata.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    spark = build_session()
    con = duck_connection(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for key in keys or sorted(qs):
        t0 = time.time()
        if key not in sqls:
            n = qs[key](spark, sf_dir).count()
            print(f"{key:32s} rows-only {n} rows ({time.time() - t0:.1f}s)")
            continue
        try:
            problems = compare(spark, con, key, qs[key], sqls[key], sf_dir)
        except Exception as exc:  # report and keep going
            problems = [f"error: {type(exc).__name__}: {str(exc)[:400]}"]
        status = "ok" if not problems else "FAIL"
        bad += bool(problems)
        print(f"{key:32s} {status} ({time.time() - t0:.1f}s)")
        for p in problems:
            print("    ", p)
    print(f"{len(keys or qs) - bad} ok, {bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
