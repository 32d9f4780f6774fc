"""Run queries beside their SQL in DuckDB: `python -m suite.compare [sf_dir] [name ...]`."""

from __future__ import annotations

import math
import sys
import tempfile
import time

import suite
from leafline.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(_cell(v) for v in value) + "]"
    return f"{type(value).__name__}:{value}"


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in data)


def differences(spark, con, name: str, sf_dir: str) -> tuple[str | None, int]:
    fn, sql = suite.CASES[name]
    got = fn(spark, sf_dir)
    left = rows(got.columns, [tuple(r) for r in got.collect()])
    if sql is None:
        return None, len(left)
    rel = con.sql(sql)
    right = rows(rel.columns, rel.fetchall())
    if sorted(got.columns) != sorted(rel.columns):
        return f"columns {sorted(got.columns)} != {sorted(rel.columns)}", len(left)
    if left != right:
        only_l = [r for r in left if r not in set(right)][:2]
        only_r = [r for r in right if r not in set(left)][:2]
        return f"{len(left)} rows against {len(right)}; ours {only_l}; sql {only_r}"[:1500], len(left)
    return None, len(left)


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    suite.load_all()
    names = sys.argv[2:] or list(suite.CASES)
    spark = build_session(
        "compare", "local[8]",
        {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
         "spark.driver.memory": "8g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="compare-")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            diff, n = differences(spark, con, name, sf_dir)
        except Exception as e:  # report and go on with the next query
            diff, n = f"{type(e).__name__}: {str(e)[:700]}", -1
        bad += diff is not None
        print(f"{'FAIL' if diff else 'ok  '} {name:24s} {n:7d} rows {time.time() - start:6.2f}s {diff or ''}", flush=True)
    print("failed:", bad, "of", len(names))
    return bad


if __name__ == "__main__":
    sys.exit(main())
