"""Runs registered queries and their SQL over one folder of tables and tells where they differ.

python tests/oracle.py DIR [NAME...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def key(row: tuple) -> tuple:
    return tuple((x is None, str(x)) for x in row)


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, (int, float)):
        return abs(a - b) <= 1e-9 * max(1, abs(a), abs(b))
    return a == b


def compare(spark, con, sf_dir: str, query, sql: str | None) -> str:
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*names).collect()), key=key)
    if sql is None:
        return f"rows only: {len(got)}"
    rel = con.sql(sql)
    if sorted(rel.columns) != names:
        return f"columns differ: {names} {sorted(rel.columns)}"
    want = sorted(rel.select(*(f'"{n}"' for n in names)).fetchall(), key=key)
    if len(got) != len(want):
        return f"row counts differ: {len(got)} {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if not all(map(same, g, w))]
    return f"{len(wrong)} rows differ: {wrong[:2]}" if wrong else f"equal: {len(got)}"


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = Path(sf_dir, f"{t}.parquet")
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return con


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    session = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "6g").config("spark.ui.enabled", "false").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    con = connect(sys.argv[1])
    sqls = e.oracle_sql()
    for name, query in e.queries().items():
        if sys.argv[2:] and not any(name.startswith(x) for x in sys.argv[2:]):
            continue
        t = time.time()
        try:
            said = compare(session, con, sys.argv[1], query, sqls.get(name))
        except Exception as x:  # a tool for the developer: say it and go on
            said = f"failed: {str(x)[:1500]}"
        print(f"{name}: {said} ({time.time() - t:.1f} s)", flush=True)
