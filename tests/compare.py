"""Side-by-side run of a registered query and its SQL."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, float):
        return (3, "nan") if math.isnan(value) else (2, value)
    if isinstance(value, int):
        return (2, value)
    return (4, str(value))


def rows_of_spark(df):
    names = sorted(df.columns)
    return names, sorted([tuple(_plain(r[n]) for n in names) for r in df.collect()])


def rows_of_duck(con, sql):
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    names = sorted(columns)
    order = [columns.index(n) for n in names]
    return names, sorted([tuple(_plain(r[i]) for i in order) for r in cursor.fetchall()])


def difference(spark_side, duck_side) -> str | None:
    """None when equal, else what differs first."""
    (names, ours), (theirs_names, theirs) = spark_side, duck_side
    if names != theirs_names:
        return f"columns {names} vs {theirs_names}"
    if len(ours) != len(theirs):
        return f"row counts {len(ours)} vs {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{dict(zip(names, a))} vs {dict(zip(names, b))}"
    return None
