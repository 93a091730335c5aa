"""Compare a registered Spark query with its DuckDB oracle (test helper / CLI).

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


EXACT = os.environ.get("ORACLE_EXACT") == "1"


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else round(v, 9)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            return v
    return v


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT",
                 "smallint": "SMALLINT", "tinyint": "TINYINT"}


def type_mismatches(sdf, rel) -> dict:
    """Columns whose Spark type differs from the oracle's DuckDB type."""
    st = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
          for f in sdf.schema.fields}
    dt = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    return {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}


def _key(row):
    return tuple((v is None, str(type(v).__name__) if v is not None else "", v if v is not None else 0)
                 for v in row)


def compare(spark, con, name: str, fn, sql: str, sf_dir: str, max_show: int = 5) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    cols = sorted(sdf.columns)
    srows = [tuple(_norm(r[c]) for c in cols) for r in sdf.collect()]
    t1 = time.time()
    res = con.sql(sql)
    types_bad = type_mismatches(sdf, res)
    dcols = list(res.columns)
    drows_raw = res.fetchall()
    order = sorted(range(len(dcols)), key=lambda i: dcols[i])
    dsorted = [dcols[i] for i in order]
    drows = [tuple(_norm(r[i]) for i in order) for r in drows_raw]
    out = {"name": name, "spark_rows": len(srows), "oracle_rows": len(drows),
           "spark_sec": round(t1 - t0, 2), "cols_match": cols == dsorted,
           "types_match": not types_bad, "type_mismatches": types_bad}
    if cols != dsorted:
        out["spark_cols"] = cols
        out["oracle_cols"] = dsorted
        out["match"] = False
        return out
    ss = sorted(srows, key=_key)
    ds = sorted(drows, key=_key)
    out["match"] = ss == ds
    if not out["match"]:
        sset, dset = {}, {}
        for r in ss:
            sset[r] = sset.get(r, 0) + 1
        for r in ds:
            dset[r] = dset.get(r, 0) + 1
        only_s = [r for r in sset if sset[r] != dset.get(r, 0)][:max_show]
        only_d = [r for r in dset if dset[r] != sset.get(r, 0)][:max_show]
        out["cols"] = cols
        out["only_spark"] = only_s
        out["only_oracle"] = only_d
    return out


def main(argv):
    import __spark_entry__ as entry
    from lamina.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    if os.environ.get("ORACLE_DEFAULT_SESSION") == "1":  # as a driver would build it
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]")
                 .config("spark.ui.enabled", "false").getOrCreate())
    else:
        spark = local_session()
    con = duck(sf_dir)
    qs = entry.queries()
    sqls = entry.oracle_sql()
    bad = 0
    for name in (names or sorted(qs)):
        if name not in sqls:
            t0 = time.time()
            n = qs[name](spark, sf_dir).count()
            print(f"ROWS-ONLY {name}: {n} rows ({time.time() - t0:.1f}s)", flush=True)
            continue
        try:
            r = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # report and go on
            bad += 1
            print(f"ERROR {name}: {type(e).__name__}: {str(e)[:600]}", flush=True)
            continue
        status = "OK  " if r["match"] else "FAIL"
        bad += 0 if r["match"] else 1
        print(f"{status} {name}: spark={r['spark_rows']} oracle={r['oracle_rows']} "
              f"({r['spark_sec']}s)", flush=True)
        if not r["match"]:
            for k in ("spark_cols", "oracle_cols", "cols", "only_spark", "only_oracle"):
                if k in r:
                    print(f"     {k}: {r[k]}", flush=True)
    print(f"failures: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
