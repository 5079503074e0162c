"""Run registered queries in Spark and their SQL in DuckDB and compare the rows.

Usage: python -m tests.side_by_side [sf] [name-prefix ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normal(x):
    if isinstance(x, bool) or x is None:
        return x
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x)
    if isinstance(x, int):
        return x
    return str(x)


def compare(spark_df, con, text: str) -> str:
    """Empty string when both sides agree, else what differs."""
    cols = sorted(spark_df.columns)
    mine = [tuple(normal(row[c]) for c in cols) for row in spark_df.collect()]
    rel = con.execute(text)
    names = [d[0] for d in rel.description]
    if sorted(names) != cols:
        return f"columns {sorted(set(cols) ^ set(names))}"
    order = [names.index(c) for c in cols]
    theirs = [tuple(normal(row[i]) for i in order) for row in rel.fetchall()]
    if len(mine) != len(theirs):
        return f"rows {len(mine)} vs {len(theirs)}"
    a, b = sorted(mine, key=repr), sorted(theirs, key=repr)
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        return f"values differ in {len(bad)} of {len(a)} rows, {cols}: {bad[0][0]} vs {bad[0][1]}"
    return ""


def main(argv: list[str]) -> int:
    import __spark_entry__ as e
    from marketlake import build_session
    sf = argv[0] if argv else "0.01"
    prefixes = tuple(argv[1:])
    sf_dir = f"/root/testdata/sf{sf}"
    if os.environ.get("PLAIN"):  # a session somebody else set up, with Spark's own defaults
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    else:
        spark = build_session("check", "local[8]", {
            "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls, failed = e.oracle_sql(), 0
    for name, fn in e.queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sqls:
                note = compare(df, con, sqls[name]) or "ok"
            else:
                note = f"rows only: {df.count()}"
        except Exception as err:  # report and go on with the next query
            note = f"ERROR {type(err).__name__}: {str(err)[:600]}"
        failed += not note.startswith(("ok", "rows only"))
        print(f"{name:28s} {time.time() - start:6.1f}s  {note}", flush=True)
    missing = set(sqls) - set(e.queries())
    print(f"failed={failed} oracle without query={sorted(missing)}")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
