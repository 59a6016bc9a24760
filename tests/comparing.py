"""Compare a Spark result with the SQL counterpart run by DuckDB."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(folder: str):
    db = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows(records, columns) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(plain(r[i]) for i in order) for r in records),
        key=lambda t: tuple((v is None, str(type(v)), str(v)) for v in t),
    )


def compare(spark, folder: str, function, sql: str, db) -> list[str]:
    """The differences found; an empty list means the results are equal."""
    result = function(spark, folder)
    mine = rows(result.collect(), result.columns)
    answer = db.sql(sql)
    theirs = rows(answer.fetchall(), answer.columns)
    problems = []
    if sorted(result.columns) != sorted(answer.columns):
        problems.append(f"columns {sorted(result.columns)} != {sorted(answer.columns)}")
    if len(mine) != len(theirs):
        problems.append(f"{len(mine)} rows != {len(theirs)}")
    for a, b in zip(mine, theirs):
        if a != b:
            problems.append(f"{a}\n  != {b}")
            break
    kinds = {f.name: f.dataType.simpleString() for f in result.schema.fields}
    for name, kind in zip(answer.columns, answer.types):
        pair = (kinds.get(name), str(kind))
        known = {
            ("bigint", "BIGINT"), ("int", "INTEGER"), ("string", "VARCHAR"), ("double", "DOUBLE"),
            ("boolean", "BOOLEAN"), ("date", "DATE"), ("timestamp", "TIMESTAMP"),
            ("timestamp_ntz", "TIMESTAMP"),
        }
        if pair not in known:
            problems.append(f"type of {name}: {pair}")
    return problems


def records(df) -> list[dict]:
    return [row.asDict(recursive=True) for row in df.collect()]


def by_key(df, key: str) -> dict:
    return {row[key]: row for row in records(df)}
