"""Compare a registered query with its SQL twin, value by value."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir):
    db = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            db.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return db


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        if isinstance(v, float):
            return None if math.isnan(v) else v + 0.0
        return v

    cells = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(cells, key=lambda r: [(v is None, str(type(v) is str), v if v is not None else 0) for v in r])


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}


def compare(spark, db, sf_dir, fn, sql):
    """None if equal, else a short description of the difference."""
    df = fn(spark, sf_dir)
    types = {d[0]: d[1] for d in db.execute(f"describe {sql}").fetchall()}
    other = {n: (t, types.get(n)) for n, t in df.dtypes if TYPES.get(t) != types.get(n)}
    if other:
        return f"types {other}"
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    cursor = db.execute(sql)
    want = canonical([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    different = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    if different:
        return f"{len(different)} of {len(got[1])} rows differ, first {different[0]} in {got[0]}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    sf_dir = sys.argv[1]
    chosen = sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    twins = contract.oracle_sql()
    for name, fn in contract.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            if name in twins:
                problem = compare(spark, db, sf_dir, fn, twins[name])
                verdict = problem or "equal"
            else:
                df = fn(spark, sf_dir)
                rows = df.collect()
                verdict = f"{len(rows)} rows, no twin: {rows[:3]}"
        except Exception as e:  # report and go on with the next query
            verdict = f"ERROR {type(e).__name__}: {str(e)[:600]}"
        print(f"{name:28s} {time.time() - start:6.1f}s  {verdict}", flush=True)
