"""Compare registered queries with their SQL on a folder of tables: python -m tests.check_oracles <dir> [name ...]"""

import sys
import time

import duckdb
import pandas as pd

import __spark_entry__ as spark_entry
from assaylake.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def rows(frame: pd.DataFrame):
    columns = sorted(frame.columns)

    def plain(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA:
            return None
        if isinstance(v, pd.Timestamp):
            return str(v.tz_localize(None) if v.tzinfo else v)
        if hasattr(v, "isoformat"):
            return str(pd.Timestamp(v))
        if hasattr(v, "item"):
            v = v.item()
        return v

    out = [tuple(plain(v) for v in r) for r in frame[columns].itertuples(index=False, name=None)]
    return columns, sorted(out, key=lambda r: tuple((x is not None, str(x)) for x in r))


def compare(spark, con, folder, name):
    """None if equal, else what differs."""
    df = spark_entry.queries()[name](spark, folder)
    got_c, got = rows(df.toPandas())
    want_c, want = rows(con.execute(spark_entry.oracle_sql()[name]).df())
    if got_c != want_c:
        return f"columns {got_c} != {want_c}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    kinds = lambda rs: [{type(x).__name__ for x in c if x is not None} for c in zip(*rs)]
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} rows differ, e.g. {bad[0][0]} != {bad[0][1]} ({got_c})"
    for c, g, w, values in zip(got_c, kinds(got), kinds(want), zip(*got)):
        # pandas turns integers with NULLs into floats, so such columns are compared by value only.
        if g and w and g != w and not ((g | w) <= {"int", "float"} and None in values):
            return f"column {c}: type {g} != {w}"
    return None


def main(folder, names):
    spark = build_session("oracles", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in names or spark_entry.queries():
        if name not in spark_entry.oracle_sql():
            print(f"{name:34s} no SQL")
            continue
        t = time.time()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{name:34s} {'ok' if problem is None else 'FAIL ' + problem}  {time.time() - t:.1f}s", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
