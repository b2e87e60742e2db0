"""Compare a registered query with its SQL in DuckDB, as the driver does.

python tests/oracle.py [SF_DIR] [NAME...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return con


def canonical(rows, names) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    fix = lambda v: repr(v) if isinstance(v, float) else str(v)
    return sorted(tuple(fix(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir: str, query, sql: str) -> str:
    """An empty string when both give the same names and rows."""
    df = query(spark, sf_dir)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    rel = connect(sf_dir).sql(sql)
    want = canonical(rel.fetchall(), rel.columns)
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} and {sorted(rel.columns)}"
    if got != want:
        bad = [(a, b) for a, b in zip(got, want) if a != b][:3]
        return f"{len(got)} and {len(want)} rows; first differences {bad}"
    return ""


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf, names = (sys.argv + ["/root/testdata/sf0.01"])[1], sys.argv[2:]
    spark = SparkSession.builder.master(f"local[{os.environ.get('ORACLE_CPUS', '8')}]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    queries, sqls = entry.queries(), entry.oracle_sql()
    for n in names or queries:
        t = time.time()
        if n in sqls:
            said = compare(spark, sf, queries[n], sqls[n]) or "ok"
        else:
            said = f"no SQL, {queries[n](spark, sf).count()} rows"
        print(f"{n}: {said[:1500]} ({time.time() - t:.1f} s)", flush=True)
