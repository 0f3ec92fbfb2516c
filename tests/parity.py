"""Spark query vs DuckDB oracle, the way the driver compares them:
row count, column names, order-insensitive hash of the values."""

from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


SPARK_TO_DUCK = {"double": "DOUBLE", "bigint": "BIGINT", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return repr(round(v, 6) + 0.0)
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    return str(v)


def digest(pdf: pd.DataFrame) -> tuple[int, list[str], str]:
    cols = sorted(pdf.columns)
    rows = sorted("|".join(_norm(v) for v in r) for r in pdf[cols].astype(object).itertuples(index=False))
    return len(rows), cols, hashlib.sha256("\n".join(rows).encode()).hexdigest()


def compare(spark, name: str, sf_dir: str, con=None, verbose=False):
    import __spark_entry__ as E

    q = E.queries()[name]
    sql = E.oracle_sql().get(name)
    t0 = time.time()
    sdf = q(spark, sf_dir)
    sp_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    sp = sdf.toPandas()
    t1 = time.time()
    if sql is None:
        return {"name": name, "rows": len(sp), "oracle": None, "spark_s": round(t1 - t0, 2)}
    con = con or duck(sf_dir)
    dk = con.sql(sql).df()
    dk_types = {c[0]: c[1] for c in con.execute(f"DESCRIBE {sql}").fetchall()}
    types_ok = all(SPARK_TO_DUCK.get(t, t) == dk_types.get(c) for c, t in sp_types.items())
    a, b = digest(sp), digest(dk)
    res = {"name": name, "rows": (a[0], b[0]), "cols": a[1] == b[1], "hash": a[2] == b[2],
           "types": types_ok, "spark_s": round(t1 - t0, 2)}
    if verbose and not (a[1] == b[1] and a[2] == b[2]):
        res["spark_cols"], res["duck_cols"] = a[1], b[1]
        if a[1] == b[1]:
            cols = a[1]
            s1 = sp[cols].astype(object).map(_norm)
            s2 = dk[cols].astype(object).map(_norm)
            m = s1.merge(s2, how="outer", indicator=True)
            res["diff"] = m[m["_merge"] != "both"].sort_values(cols).head(10).to_string()
    return res


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from voltwatch.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session()
    import __spark_entry__ as E

    con = duck(sf)
    for n in names or list(E.queries()):
        try:
            print(compare(spark, n, sf, con, verbose=True), flush=True)
        except Exception as e:  # noqa: BLE001
            print({"name": n, "error": repr(e)[:800]}, flush=True)
