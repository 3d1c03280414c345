"""Run registered queries on Spark and their SQL twins on DuckDB, compare.

Comparison: column names (sorted), a coarse type class per column, row
count, and the multiset of rows (values normalised to text; doubles exact).
Usable from pytest and as a script:

    python tests/oracle_harness.py /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import datetime as _dt
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from windowlens.sources.tables import TABLES  # noqa: E402


def duck(data_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{data_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(float(v))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (_dt.datetime,)):
        return v.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(v, _dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def _kind(type_name: str) -> str:
    t = type_name.lower()
    if t in ("tinyint", "smallint", "int", "integer", "bigint", "hugeint"):
        return "int"
    if t in ("float", "double", "real"):
        return "float"
    if "timestamp" in t:
        return "timestamp"
    if t in ("string", "varchar"):
        return "string"
    if t in ("boolean",):
        return "bool"
    return t


SPARK_TYPES = {"IntegerType": "integer", "LongType": "bigint", "DoubleType": "double",
               "StringType": "varchar", "BooleanType": "boolean", "TimestampNTZType": "timestamp",
               "TimestampType": "timestamp with time zone", "DateType": "date", "ShortType": "smallint",
               "FloatType": "float"}


def spark_rows(df):
    types = [SPARK_TYPES.get(type(f.dataType).__name__, f.dataType.simpleString()) for f in df.schema.fields]
    rows = [tuple(r) for r in df.collect()]
    return list(df.columns), types, rows


def duck_rows(con, sql):
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    types = [str(d[1]).lower() for d in rel.description]
    rows = rel.fetchall()
    return cols, types, rows


def compare(spark_result, duck_result) -> list[str]:
    s_cols, s_types, s_rows = spark_result
    d_cols, d_types, d_rows = duck_result
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        return [f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"]
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    for c, a, b in zip(order, [s_types[i] for i in si], [d_types[i] for i in di]):
        if a != b:
            problems.append(f"type {c}: spark={a} duck={b}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows: spark={len(s_rows)} duck={len(d_rows)}")
    sa = sorted(tuple(_norm(r[i]) for i in si) for r in s_rows)
    da = sorted(tuple(_norm(r[i]) for i in di) for r in d_rows)
    if sa != da:
        only_s = [r for r in sa if r not in set(da)][:3]
        only_d = [r for r in da if r not in set(sa)][:3]
        problems.append(f"values differ: cols={order} spark-only={only_s} duck-only={only_d}")
    return problems


def pandas_compare(spark_df, con, sql) -> list[str]:
    """A second, stricter view: both results through pandas (``toPandas`` /
    ``fetchdf``), columns sorted by name, values stringified, rows sorted.
    Differences here mean a pandas-based comparison would see different
    dtypes (e.g. nullable integers, dates) even when the values agree."""
    a = spark_df.toPandas()
    b = con.execute(sql).fetchdf()
    a = a[sorted(a.columns)]
    b = b[sorted(b.columns)]
    problems = []
    if list(a.columns) != list(b.columns):
        return [f"pandas columns differ {list(a.columns)} {list(b.columns)}"]
    for c in a.columns:
        if str(a[c].dtype) != str(b[c].dtype) and not (
                str(a[c].dtype).startswith("datetime64") and str(b[c].dtype).startswith("datetime64")):
            problems.append(f"pandas dtype {c}: spark={a[c].dtype} duck={b[c].dtype}")
    sa = sorted(map(tuple, a.astype(str).values.tolist()))
    sb = sorted(map(tuple, b.astype(str).values.tolist()))
    if sa != sb:
        problems.append(f"pandas values differ, e.g. spark={sa[:1]} duck={sb[:1]}")
    return problems


def run(spark, data_dir: str, keys=None, verbose=True) -> dict[str, list[str]]:
    import __spark_entry__ as entry
    qs = entry.queries()
    sql = entry.oracle_sql()
    con = duck(data_dir)
    results = {}
    for key in keys or sorted(qs):
        t0 = time.time()
        try:
            s = spark_rows(qs[key](spark, data_dir))
        except Exception as exc:  # noqa: BLE001
            results[key] = [f"spark error: {type(exc).__name__}: {str(exc)[:400]}"]
            if verbose:
                print(f"{key:28s} SPARK ERROR {results[key][0]}", flush=True)
            continue
        t1 = time.time()
        if key not in sql:
            results[key] = []
            if verbose:
                print(f"{key:28s} rows-only ({len(s[2])} rows) spark {t1 - t0:.1f}s", flush=True)
            continue
        try:
            d = duck_rows(con, sql[key])
        except Exception as exc:  # noqa: BLE001
            results[key] = [f"duck error: {str(exc)[:400]}"]
            if verbose:
                print(f"{key:28s} DUCK ERROR {results[key][0]}", flush=True)
            continue
        results[key] = compare(s, d)
        if os.environ.get("HARNESS_PANDAS"):
            results[key] += pandas_compare(qs[key](spark, data_dir), con, sql[key])
        if verbose:
            status = "OK" if not results[key] else "MISMATCH " + " | ".join(results[key])
            print(f"{key:28s} {status} ({len(s[2])} rows, spark {t1 - t0:.1f}s)", flush=True)
    return results


if __name__ == "__main__":
    from windowlens.session import build_session
    data_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    tz = os.environ.get("HARNESS_TZ")
    spark = build_session("local[8]", shuffle_partitions=8,
                          extra={"spark.sql.session.timeZone": tz} if tz else None)
    res = run(spark, data_dir, keys)
    bad = {k: v for k, v in res.items() if v}
    print(f"\n{len(res) - len(bad)}/{len(res)} ok; bad: {sorted(bad)}")
