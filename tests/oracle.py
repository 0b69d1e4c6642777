"""Compare a query with its SQL answer the way the catalogue's contract asks for."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
SAME_TYPE = {
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def differences(df, sql: str, con) -> list[str]:
    """What differs between a Spark result and a DuckDB result; empty if nothing does."""
    relation = con.sql(sql)
    wanted = dict(zip(relation.columns, map(str, relation.types)))
    got = {f.name: f.dataType.simpleString() for f in df.schema}
    if set(wanted) != set(got):
        return [f"columns {sorted(got)} instead of {sorted(wanted)}"]
    found = [
        f"{name}: {kind} instead of {wanted[name]}"
        for name, kind in got.items()
        if SAME_TYPE.get(kind) != wanted[name]
    ]
    names = sorted(got)
    mine = Counter(tuple(row[n] for n in names) for row in df.collect())
    order = [relation.columns.index(n) for n in names]
    theirs = Counter(tuple(row[i] for i in order) for row in relation.fetchall())
    for label, rows in (("extra", mine - theirs), ("missing", theirs - mine)):
        if rows:
            found.append(f"{sum(rows.values())} {label}, e.g. {next(iter(rows))}")
    nan = [row for row in mine if any(isinstance(v, float) and math.isnan(v) for v in row)]
    if nan:
        found.append(f"NaN in {nan[0]}")
    return found
