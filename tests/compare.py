"""Compare a Spark result with its SQL: columns, types, and every row regardless of order."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
_KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def differences(spark_df, con, sql: str) -> list[str]:
    """Human-readable differences; empty when both sides agree."""
    relation = con.sql(sql)
    ours = dict(spark_df.dtypes)
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    if sorted(ours) != sorted(theirs):
        return [f"columns {sorted(ours)} != {sorted(theirs)}"]
    names = sorted(ours)
    found = [
        f"type of {n}: {ours[n]} != {theirs[n]}"
        for n in names
        if _KINDS.get(ours[n]) != theirs[n]
    ]
    quoted = [f"`{n}`" for n in names]
    left = Counter(tuple(r) for r in spark_df.select(*quoted).collect())
    right = Counter(relation.project(", ".join(f'"{n}"' for n in names)).fetchall())
    if left != right:
        found.append(
            f"rows {sum(left.values())} vs {sum(right.values())}; "
            f"only Spark {list((left - right).items())[:3]}; "
            f"only SQL {list((right - left).items())[:3]}"
        )
    return found
