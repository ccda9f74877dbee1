"""Side-by-side check of a registered query against its DuckDB SQL.

Mirrors the external correctness gate: same row count, same column names
(compared sorted), the same column types and the same multiset of rows,
compared exactly ("match") or, failing that, with floats rounded to 9
significant digits ("match-rounded").

Usage: python -m tessera.plans.oracle_check [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duckdb_conn(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


_CANON = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
          "boolean": "BOOLEAN", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def _exact(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (list, tuple)):
        return tuple(_exact(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _exact(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _exact(v.asDict())
    if isinstance(v, bool):
        return int(v)
    return v


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}")
    if hasattr(v, "is_nan") and hasattr(v, "as_tuple"):  # Decimal
        return float(f"{float(v):.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    if isinstance(v, bool):
        return int(v)
    return v


def compare(spark, name: str, sf_dir: str, queries: dict, oracle: dict, con=None) -> dict:
    con = con or duckdb_conn(sf_dir)
    t0 = time.time()
    sdf = queries[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = sdf.collect()
    t1 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 3)}
    if name not in oracle:
        res["status"] = "rows-only"
        return res
    rel = con.sql(oracle[name])
    d_cols = list(rel.columns)
    d_types = dict(zip(d_cols, (str(t) for t in rel.types)))
    d_rows = rel.fetchall()
    res["duck_rows"] = len(d_rows)
    res["duck_sec"] = round(time.time() - t1, 3)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = f"COLUMNS differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
        return res
    s_types = {f.name: _CANON.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
               for f in sdf.schema.fields}
    type_diff = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
    if type_diff:
        res["status"] = f"TYPES differ (spark, duck): {type_diff}"
        return res
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    exact_s = Counter(tuple(_exact(r[i]) for i in si) for r in s_rows)
    exact_d = Counter(tuple(_exact(r[i]) for i in di) for r in d_rows)
    sc = Counter(tuple(_norm(r[i]) for i in si) for r in s_rows)
    dc = Counter(tuple(_norm(r[i]) for i in di) for r in d_rows)
    if exact_s == exact_d:
        res["status"] = "match"
    elif sc == dc:
        res["status"] = "match-rounded"  # equal only after rounding floats
    else:
        only_s = list((sc - dc).elements())[:3]
        only_d = list((dc - sc).elements())[:3]
        res["status"] = f"VALUES differ: spark-only={only_s} duck-only={only_d}"
    return res


def main(argv):
    sys.path.insert(0, ".")
    from tessera.plans.registry import oracle_sql, queries
    from tessera.session import get_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    qs, orc = queries(), oracle_sql()
    names = argv[2:] or list(qs)
    con = duckdb_conn(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, qs, orc, con)
        except Exception as e:  # report and continue with the next query
            r = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        bad += r["status"] not in ("match", "match-rounded", "rows-only")
        print(r, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
