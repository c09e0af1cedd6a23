"""Compare registered queries with their DuckDB oracle (row count, column
names and types, order-insensitive values).  Usable from pytest and as a script:

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SPARK_TO_DUCK = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "date": "DATE",
}

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm_value(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "isoformat") and not isinstance(v, str):
        return v.replace(tzinfo=None) if hasattr(v, "tzinfo") else v
    try:
        import decimal

        if isinstance(v, decimal.Decimal):
            return round(float(v), 6)
    except Exception:
        pass
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm_value(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, name: str, sf_dir: str, query, sql: str | None):
    t0 = time.time()
    df = query(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    t1 = time.time()
    res = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    con = duck(sf_dir)
    rel = con.sql(sql)
    dtypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    res["oracle_rows"] = len(drows)
    if sorted(scols) != sorted(dcols):
        res["status"] = f"COLUMNS {sorted(scols)} != {sorted(dcols)}"
        return res
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    bad_types = {c: (stypes[c], dtypes[c]) for c in scols if stypes[c] != dtypes[c]}
    if bad_types:
        res["status"] = f"TYPES {bad_types}"
        return res
    a, b = _rows(scols, srows), _rows(dcols, drows)
    if a == b:
        res["status"] = "match"
    else:
        res["status"] = "VALUES"
        diff = [x for x in a if x not in set(b)][:3]
        res["example_spark_only"] = diff
        res["example_oracle_only"] = [x for x in b if x not in set(a)][:3]
    return res


def main(argv):
    from tollgate.session import build_session
    import __spark_entry__ as E

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(E.queries())
    spark = build_session("local[8]", shuffle_partitions=8, conf={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, qs[n], sqls.get(n))
        except Exception as exc:  # report and go on
            r = {"name": n, "status": f"ERROR {type(exc).__name__}: {str(exc)[:300]}"}
        bad += r["status"] not in ("match", "rows-only")
        print(r, flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv))
