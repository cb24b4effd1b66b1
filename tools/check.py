"""Run registered queries next to their checking SQL and compare the rows.

    python tools/check.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import math
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

from gleanery import checks, fixtures  # noqa: E402
from gleanery.session import build_session  # noqa: E402

KINDS = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE",
         "int": "INTEGER", "date": "DATE", "timestamp": "TIMESTAMP WITH TIME ZONE",
         "timestamp_ntz": "TIMESTAMP"}


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows),
                  key=lambda t: tuple((v is None, str(v)) for v in t))


def connect(folder: str):
    con = duckdb.connect()
    for name in fixtures.TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def compare(spark, con, folder, name) -> str:
    """Empty when the query and its SQL agree, else what differs."""
    df = checks.QUERIES[name](spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in checks.ORACLES:
        return "" if got else "no rows"
    cur = con.execute(checks.ORACLES[name])
    names, types = [c[0] for c in cur.description], [str(c[1]) for c in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    spark_types = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema}
    wrong = {n: (spark_types[n], t) for n, t in zip(names, types) if spark_types[n] != t}
    if wrong:
        return f"types {wrong}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ: {sorted(names)} {bad[:2]}" if bad else ""


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    checks.load()
    spark = build_session("local[8]", **{
        "spark.sql.shuffle.partitions": 8, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), 0
    for name in args.names or list(checks.QUERIES):
        start = time.time()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        kind = "sql " if name in checks.ORACLES else "rows"
        print(f"{'ok  ' if not problem else 'FAIL'} {kind} {time.time() - start:6.2f}s {name} {problem}",
              flush=True)
        failed += bool(problem)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
