"""Run a registered query and its SQL counterpart on the same files and compare them as multisets."""

from __future__ import annotations

import datetime
import math
import os
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(_value(row[i]) for i in order) for row in rows)


def sql_rows(statement: str, sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    result = con.execute(statement)
    return _rows([d[0] for d in result.description], result.fetchall())


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def difference(df, statement: str, sf_dir: str) -> str | None:
    """None when equal, otherwise what differs."""
    names, ours = spark_rows(df)
    other_names, theirs = sql_rows(statement, sf_dir)
    if names != other_names:
        return f"columns {sorted(set(names) ^ set(other_names))}"
    if ours == theirs:
        return None
    only, missing = list((ours - theirs).items()), list((theirs - ours).items())
    text = f"{sum(ours.values())} rows against {sum(theirs.values())}; {len(only)} differ"
    key = repr
    for a, b in list(zip(sorted(only, key=key), sorted(missing, key=key)))[:3]:
        text += "\n  " + str([(n, x, y) for n, x, y in zip(names, a[0], b[0]) if x != y])
    return text + ("" if only and missing else f"\n  {(only or missing)[:2]}")
