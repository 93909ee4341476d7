"""Compare a Spark query with its DuckDB twin (row count, column names,
order-insensitive values)."""

from __future__ import annotations

import math
from collections import Counter

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 5)
    if isinstance(v, bool):
        return int(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_cols = spark_df.columns
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in spark_df.schema.fields}
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = dict(zip(d_cols, [str(t) for t in rel.types]))
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    type_diff = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
    if type_diff:
        return False, f"column types differ: {type_diff}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    if not s_rows:
        return False, "no rows: nothing is compared"
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_idx = {c: i for i, c in enumerate(d_cols)}
    cs = Counter(tuple(_norm(r[i]) for i in order) for r in s_rows)
    cd = Counter(tuple(_norm(r[d_idx[s_cols[i]]]) for i in order) for r in d_rows)
    if cs != cd:
        diff = list((cs - cd).items())[:3]
        diff2 = list((cd - cs).items())[:3]
        return False, f"values differ ({sum((cs - cd).values())} rows): spark-only {diff} duck-only {diff2}"
    return True, f"{len(s_rows)} rows"
