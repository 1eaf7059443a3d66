"""Compare registered queries with their SQL: python tests/check_oracle.py <sf_dir> [name prefix ...]"""

import datetime
import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(value):
    if isinstance(value, bool) or value is None or isinstance(value, (int, str)):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return int(value) if value == int(value) else round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(norm(v) for v in value)
    return str(value)


def connect(sf):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return con


def compare(spark, con, sf, fn, sql):
    """(ok, message)"""
    df = fn(spark, sf)
    names = sorted(df.columns)
    got = sorted((tuple(norm(r[n]) for n in names) for r in df.collect()), key=repr)
    if sql is None:
        return True, f"rows-only {len(got)}"
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    if sorted(cols) != names:
        return False, f"columns {names} vs {sorted(cols)}"
    index = [cols.index(n) for n in names]
    want = sorted((tuple(norm(r[i]) for i in index) for r in cur.fetchall()), key=repr)
    if got == want:
        return True, f"{len(got)} rows"
    extra = [r for r in got if r not in set(want)][:3] if len(got) < 20000 else got[:2]
    gone = [r for r in want if r not in set(got)][:3] if len(want) < 20000 else want[:2]
    return False, f"{len(got)} vs {len(want)} rows; cols {names}\n   spark: {str(extra)[:900]}\n   sql:   {str(gone)[:900]}"


def main():
    from briefwright.session import build_session
    import __spark_entry__ as entry

    sf, prefixes = sys.argv[1], tuple(sys.argv[2:])
    spark = build_session("oracle", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            ok, message = compare(spark, con, sf, fn, sqls.get(name))
        except Exception as error:
            ok, message = False, f"{type(error).__name__}: {str(error)[:400]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {message}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
