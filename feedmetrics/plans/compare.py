"""Side-by-side check of a Spark query against DuckDB SQL on the same parquet tables.

Used by the tests and by ``python -m feedmetrics.plans.compare``. Columns are compared by
name, rows as an order-insensitive multiset; doubles are compared after rounding to 9
significant digits.
"""

from __future__ import annotations

import math
import os
import sys
import time

STRICT = bool(os.environ.get("FEEDMETRICS_STRICT"))  # exact doubles instead of 9 significant digits

DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
              "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def duck_connection(sf_dir: str):
    import duckdb

    from feedmetrics.plans.registry import TABLES

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if STRICT:
            return repr(v)
        if v == 0:
            return "0"
        return repr(float(f"{v:.9g}"))
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name, spark_fn, sql, sf_dir):
    t0 = time.time()
    sdf = spark_fn(spark, sf_dir)
    s_names = sdf.columns
    s_types = [f.dataType.simpleString() for f in sdf.schema.fields]
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_names = [d[0] for d in res.description]
    d_rows = res.fetchall()
    d_types = [str(r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()]
    out = {"query": name, "spark_rows": len(s_rows), "duck_rows": len(d_rows), "spark_sec": round(t1 - t0, 2)}
    out["names_ok"] = sorted(s_names) == sorted(d_names)
    st = dict(zip(s_names, s_types))
    dt = dict(zip(d_names, d_types))
    out["type_diff"] = {c: (st[c], dt.get(c)) for c in s_names
                        if c in dt and DUCK_TYPES.get(st[c], st[c]) != dt.get(c)}
    out["values_ok"] = out["names_ok"] and rows_of(s_names, s_rows) == rows_of(d_names, d_rows)
    if not out["values_ok"] and out["names_ok"]:
        a, b = rows_of(s_names, s_rows), rows_of(d_names, d_rows)
        sa, sb = set(a), set(b)
        out["only_spark"] = [r for r in a if r not in sb][:3]
        out["only_duck"] = [r for r in b if r not in sa][:3]
    if not out["names_ok"]:
        out["names"] = (sorted(s_names), sorted(d_names))
    return out


def main(argv):
    from feedmetrics.plans.registry import oracle_sql, queries
    from feedmetrics.session import local_session

    sf_dir = "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("/")]
    for a in argv:
        if a.startswith("/"):
            sf_dir = a
    spark = local_session(8)
    con = duck_connection(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for n in (names or list(qs)):
        if n not in sqls:
            df = qs[n](spark, sf_dir)
            print({"query": n, "oracle": None, "rows": df.count()})
            continue
        try:
            r = compare(spark, con, n, qs[n], sqls[n], sf_dir)
        except Exception as e:  # report and go on
            r = {"query": n, "error": repr(e)[:400]}
        ok = r.get("values_ok") and not r.get("type_diff")
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{bad} problems")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
