"""Run queries beside their SQL: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime as dt
import math
import sys
import tempfile
import time
from collections import Counter

import duckdb

from checks import all_queries, all_sql
from stratalake.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def sql_rows(sql: str, sf_dir: str) -> tuple[list[str], Counter]:
    base = duckdb.connect()
    for name in TABLES:
        base.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    done = base.execute(sql)
    columns = [d[0] for d in done.description]
    return sorted(columns), _rows(columns, done.fetchall())


def spark_rows(df) -> tuple[list[str], Counter]:
    return sorted(df.columns), _rows(df.columns, [tuple(r) for r in df.collect()])


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(all_queries())
    work = tempfile.mkdtemp(prefix="compare-")
    settings = {"spark.ui.enabled": "false", "spark.checkpoint.dir": work}
    spark = build_session("compare", "local[8]", 8, settings)
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names:
        begun = time.time()
        try:
            got = spark_rows(all_queries()[name](spark, sf_dir))
        except Exception as error:  # report and go on to the next query
            print(f"{name:28} ERROR {str(error)[:1500]}")
            failed += 1
            continue
        took = time.time() - begun
        if name not in all_sql():
            print(f"{name:28} no SQL, {sum(got[1].values())} rows {took:.2f}s")
            continue
        want = sql_rows(all_sql()[name], sf_dir)
        same = got == want
        failed += not same
        print(f"{name:28} {'ok' if same else 'DIFFERS'} {sum(got[1].values())} rows {took:.2f}s")
        if not same:
            print("   columns", got[0], want[0])
            print("   only spark", list((got[1] - want[1]).items())[:3])
            print("   only sql  ", list((want[1] - got[1]).items())[:3])
    return failed


if __name__ == "__main__":
    sys.exit(main())
