"""Run registered queries and their SQL side by side: ``python tests/oracle_check.py DIR [name...]``.

Columns are compared by name, rows as multisets, values exactly.
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    for c in frame.columns:
        if frame[c].dtype == object or str(frame[c].dtype).startswith("str"):
            frame = frame.assign(**{c: frame[c].map(lambda v: "" if v is None or v != v else str(v))})
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """None if equal, otherwise the first difference in words."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} vs {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"{len(spark_frame)} vs {len(sql_frame)} rows"
    a, b = normal(spark_frame), normal(sql_frame)
    for c in a.columns:
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            i = same.idxmin()
            return f"{(~same).sum()} rows differ in {c}, first {a.loc[i].to_dict()} vs {b.loc[i].to_dict()}"
        if a[c].dtype != b[c].dtype:
            return f"type of {c}: {a[c].dtype} vs {b[c].dtype}"
    return None


def main(folder, *names):
    from __spark_entry__ import oracle_sql, queries
    from gridscale.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name, run in queries().items():
        if names and name not in names or name not in oracle_sql():
            continue
        start = time.time()
        try:
            got = run(spark, folder).toPandas()
            middle = time.time()
            problem = difference(got, con.execute(oracle_sql()[name]).df())
        except Exception as e:
            middle = time.time()
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{name:28s} {len(got):8d} rows  spark {middle - start:6.2f}s  sql {time.time() - middle:6.2f}s  "
              f"{problem or 'ok'}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]) > 0)
