"""Run a Spark DataFrame and a DuckDB SQL string on the same tables and diff them.

Used by the tests; mirrors what the driver's correctness gate checks:
row count, column names, and the multiset of rows.
"""

from __future__ import annotations

import decimal
import math

DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=_key)
    return cols, out


def spark_rows(df):
    cols = df.columns
    return cols, [tuple(r) for r in df.collect()]


def duck_rows(con, sql):
    rel = con.sql(sql)
    return list(rel.columns), rel.fetchall()


def diff(spark_df, con, sql, limit=5):
    sc, sr = canonical(*spark_rows(spark_df))
    dc, dr = canonical(*duck_rows(con, sql))
    problems = []
    if sc != dc:
        problems.append(f"columns differ: spark={sc} duck={dc}")
        return problems
    if len(sr) != len(dr):
        problems.append(f"row count spark={len(sr)} duck={len(dr)}")
    from collections import Counter

    cs, cd = Counter(sr), Counter(dr)
    only_s = list((cs - cd).elements())
    only_d = list((cd - cs).elements())
    if only_s or only_d:
        problems.append(f"{len(only_s)} rows only in spark, {len(only_d)} only in duck")
        for r in only_s[:limit]:
            problems.append(f"  spark: {r}")
        for r in only_d[:limit]:
            problems.append(f"  duck : {r}")
    return problems
