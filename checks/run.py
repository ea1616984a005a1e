"""Compare registered queries with their SQL twins: python -m checks.run [sf] [names...]"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from checks.oracle import ORACLE_SQL
from checks.registry import QUERIES
from tidewatch.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def rows(frame: pd.DataFrame) -> list[tuple]:
    """Rows in a comparable form: columns by name, NULLs alike, sorted."""

    def plain(value):
        if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
            return "<null>"
        if isinstance(value, bool):
            return f"b:{value}"
        if hasattr(value, "item"):
            value = value.item()
        if isinstance(value, bool):
            return f"b:{value}"
        if isinstance(value, (int, float)):
            return f"{float(value)!r}"
        return str(value)

    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(plain(v) for v in row) for row in frame.itertuples(index=False))


def compare(spark, con, sf_dir: str, name: str) -> tuple[bool, str]:
    got = QUERIES[name](spark, sf_dir).toPandas()
    if name not in ORACLE_SQL:
        return True, f"{len(got)} rows, no SQL"
    want = con.execute(ORACLE_SQL[name]).fetchdf()
    if sorted(got.columns) != sorted(want.columns):
        return False, f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    ours, theirs = rows(got), rows(want)
    if ours == theirs:
        return True, f"{len(got)} rows"
    only = [r for r in ours if r not in set(theirs)][:2], [r for r in theirs if r not in set(ours)][:2]
    return False, f"{len(ours)} != {len(theirs)} rows; ours {str(only[0])[:600]} SQL {str(only[1])[:600]}"


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(QUERIES)
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(
        "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                       "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            ok, note = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on to the next query
            ok, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:28s} {time.time() - start:6.2f}s  {note}", flush=True)
    spark.stop()
    sys.exit(1 if failed else 0)


if __name__ == "__main__":
    main()
