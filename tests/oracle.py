"""Compare catalogued queries with their SQL on DuckDB."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return repr(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, name, fn, sql) -> str | None:
    """None when both agree, else what differs."""
    df = fn(spark, folder)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got[1] else "no rows"
    cur = con.execute(sql)
    want = canonical([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        extra = list(set(got[1]) - set(want[1]))[:2], list(set(want[1]) - set(got[1]))[:2]
        return f"rows {len(got[1])} != {len(want[1])}: {extra}"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    return f"{len(bad)} rows differ, e.g. {bad[0]}" if bad else None


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as e
    from marketlane.session import build_session

    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
            "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    checks, failed = e.oracle_sql(), 0
    for name, fn in e.queries().items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, folder, name, fn, checks.get(name))
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    sys.exit(main(sys.argv[1], sys.argv[2:]))
