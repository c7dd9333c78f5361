"""Holds a query's rows against those of its SQL in DuckDB."""

import collections
import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else 0.0 if x == 0 else x
    return str(x) if not isinstance(x, (int, str, bool, type(None))) else x


def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir, f"{t}.parquet")
        if p.exists():
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    return c


def rows_of(df):
    names = sorted(df.columns)
    return names, collections.Counter(tuple(map(_plain, r)) for r in df.select(*(f"`{n}`" for n in names)).collect())


def differences(df, sql, sf_dir):
    """What either side has more of, as text; empty if the rows are the same."""
    found = duck(sf_dir).execute(sql)
    names = [d[0] for d in found.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    theirs = collections.Counter(tuple(_plain(r[i]) for i in order) for r in found.fetchall())
    own_names, own = rows_of(df)
    if own_names != sorted(names):
        return f"columns {own_names} and {sorted(names)}"
    more, less = own - theirs, theirs - own
    return f"{more.total()} rows of ours only: {list(more)[:3]}; of theirs only: {list(less)[:3]}" if more or less else ""
