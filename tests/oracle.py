"""Run registered queries and their SQL side by side.

    python tests/oracle.py SF_DIR [name ...]
"""

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else 0.0 if v == 0 else v
    return v


def _rows(table):
    names = sorted(table.column_names)
    columns = [[_plain(v) for v in table.column(n).to_pylist()] for n in names]
    return names, sorted((tuple(r) for r in zip(*columns)), key=repr)


def compare(spark, con, sf_dir, run, sql):
    """Empty text if the rows agree, else what differs."""
    spark_names, ours = _rows(run(spark, sf_dir).toArrow())
    if sql is None:
        return ""
    names, theirs = _rows(con.execute(sql).to_arrow_table())
    if spark_names != names:
        return f"columns {spark_names} / {names}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(bad)} of {len(ours)} rows differ, e.g. {str(bad[0])[:700]}" if bad else ""


def main():
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(sf_dir), oracle_sql()
    failed = 0
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, run, sqls.get(name))
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:900]}"
        failed += bool(problem)
        kind = "sql " if name in sqls else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
