"""Run a registered query and its SQL, and compare the results as multisets of rows."""

import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        return v + 0.0
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark, con, name, fn, sql, sf):
    """None if equal, else a text that shows where they differ."""
    df = fn(spark, sf)
    got_columns = df.columns
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    want_columns = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return f"{name}: columns {sorted(set(got_columns) ^ set(want_columns))}"
    if len(got) != len(want):
        return f"{name}: {len(got)} rows, SQL has {len(want)}"
    a, b = rows_of(got_columns, got), rows_of(want_columns, want)
    if a != b:
        extra, missing = list((a - b))[:2], list((b - a))[:2]
        cols = sorted(got_columns)
        hint = ""
        if extra and missing:
            x = extra[0]
            best = min((b - a), key=lambda m: sum(p != q for p, q in zip(x, m)))
            hint = str([(c, p, q) for c, p, q in zip(cols, x, best) if p != q][:8])
        return f"{name}: {sum((a - b).values())} of {len(got)} rows differ; nearest: {hint}"
    kinds_a = {c: {type(v).__name__ for r in got for v in [r[i]] if v is not None} for i, c in enumerate(got_columns)}
    kinds_b = {c: {type(v).__name__ for r in want for v in [r[i]] if v is not None} for i, c in enumerate(want_columns)}
    if kinds_a != kinds_b:
        return f"{name}: types {[(c, kinds_a[c], kinds_b[c]) for c in kinds_a if kinds_a[c] != kinds_b[c]]}"
    return None if got else f"{name}: no rows"


def by(df, *keys):
    """Rows as {key: dict}."""
    out = {}
    for r in df.collect():
        d = r.asDict()
        out[tuple(d[k] for k in keys) if len(keys) > 1 else d[keys[0]]] = d
    return out
