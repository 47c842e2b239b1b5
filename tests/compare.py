"""Running a query and its SQL counterpart side by side."""

from __future__ import annotations

import os

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]

    def cell(value):
        if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
            return "~"
        if isinstance(value, pd.Timestamp):
            return value.isoformat()
        if hasattr(value, "item"):
            value = value.item()
        return repr(value)

    return sorted(tuple(map(cell, row)) for row in frame.itertuples(index=False, name=None))


# how the types of the two engines correspond
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(spark_df, con, sql: str) -> str | None:
    """None when columns, types and rows agree, otherwise the first difference."""
    kinds = {c: KINDS.get(t, t) for c, t in spark_df.dtypes}
    wanted = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    if kinds != wanted:
        return f"columns {sorted(kinds.items())} and {sorted(wanted.items())}"
    got, want = spark_df.toPandas(), con.execute(sql).fetchdf()
    for name, kind in kinds.items():
        if kind in ("BIGINT", "INTEGER"):  # with nulls, pandas would hold one side as floats
            got[name], want[name] = got[name].astype("Int64"), want[name].astype("Int64")
    if len(got) != len(want):
        return f"{len(got)} rows and {len(want)} rows"
    for a, b in zip(_plain(got), _plain(want)):
        if a != b:
            return f"{sorted(got.columns)}\n  spark {a}\n  sql   {b}"
    return None
