"""Compare the registered queries with their SQL twins: python tests/compare.py SF_DIR [name prefixes...]."""

from __future__ import annotations

import datetime
import decimal
import glob
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plain(v):
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dict):
        return {k: plain(x) for k, x in v.items()}
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    if hasattr(v, "asDict"):
        return plain(v.asDict())
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    kinds = {c: t for c, t in df.dtypes}
    return cols, kinds, sorted(repr([plain(x) for x in r]) for r in df.select(*[f"`{c}`" for c in cols]).collect())


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(f).split(".")[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{f}')")
    return con


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = sorted(repr([plain(r[i]) for i in order]) for r in cur.fetchall())
    return [names[i] for i in order], kinds, rows


SAME = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE", "date": "DATE",
}


def main(sf_dir, prefixes):
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, sql = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = []
    for name, fn in queries.items():
        if prefixes and not any(name == p or name.startswith(p) for p in prefixes):
            continue
        t0 = time.time()
        try:
            cols, kinds, rows = spark_rows(fn(spark, sf_dir))
        except Exception as e:  # noqa: BLE001
            bad.append(name)
            print(f"ERR  {name}: {str(e)[:600]}")
            if os.environ.get("TRACE"):
                traceback.print_exc()
            continue
        took = time.time() - t0
        if name not in sql:
            print(f"ROWS {name} rows={len(rows)} {took:.1f}s")
            continue
        try:
            t0 = time.time()
            dcols, dkinds, drows = duck_rows(con, sql[name])
            dtook = time.time() - t0
        except Exception as e:  # noqa: BLE001
            bad.append(name)
            print(f"SQL  {name}: {str(e)[:600]}")
            continue
        notes = []
        for c in cols:
            k, d = kinds.get(c), dkinds.get(c)
            want = SAME.get(k, (k or "").upper())
            if d and want != d:
                notes.append(f"{c}:{k}!={d}")
        ok = cols == dcols and rows == drows
        if not ok:
            bad.append(name)
            print(f"DIFF {name} rows={len(rows)}/{len(drows)} cols={cols if cols != dcols else ''}{dcols if cols != dcols else ''}")
            a, b = set(rows) - set(drows), set(drows) - set(rows)
            print("   spark only:", [x[:300] for x in sorted(a)[:2]], "\n   sql only:", [x[:300] for x in sorted(b)[:2]])
        else:
            flag = " EMPTY" if not rows else ""
            print(f"ok   {name} rows={len(rows)} {took:.1f}s/{dtook:.2f}s{flag} {' '.join(notes)}")
    print(f"{len(bad)} bad: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
