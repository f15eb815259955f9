"""Run a registered query next to its SQL in DuckDB and compare the two results exactly."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else (value + 0.0)
    return value


def _kind(name: str) -> str:
    name = name.lower()
    for prefix, kind in (
        ("bigint", "int64"), ("long", "int64"), ("hugeint", "hugeint"), ("integer", "int32"), ("int", "int32"),
        ("varchar", "text"), ("string", "text"), ("double", "double"), ("float", "float"), ("bool", "bool"),
        ("smallint", "int16"), ("short", "int16"), ("tinyint", "int8"), ("byte", "int8"), ("timestamp", "time"),
        ("date", "date"), ("decimal", "decimal"),
    ):
        if name.startswith(prefix):
            return kind
    return name


def compare(df, con, sql: str) -> str:
    """Empty text when columns, types, row counts and values agree; otherwise what differs."""
    names = sorted(df.columns)
    relation = con.sql(sql)
    if sorted(relation.columns) != names:
        return f"columns {names} != {sorted(relation.columns)}"
    spark_types = {f.name: _kind(f.dataType.typeName()) for f in df.schema.fields}
    duck_types = {c: _kind(str(t)) for c, t in zip(relation.columns, relation.types)}
    if spark_types != duck_types:
        differing = {c: (spark_types[c], duck_types[c]) for c in names if spark_types[c] != duck_types[c]}
        return f"types {differing}"
    order = [relation.columns.index(c) for c in names]
    expected = [tuple(_plain(r[i]) for i in order) for r in relation.fetchall()]
    actual = [tuple(_plain(r[c]) for c in names) for r in df.select(*[f"`{n}`" for n in names]).collect()]
    if len(expected) != len(actual):
        return f"rows {len(actual)} != {len(expected)}"
    expected.sort(key=repr)
    actual.sort(key=repr)
    differing = [(a, e) for a, e in zip(actual, expected) if a != e]
    return f"{len(differing)} of {len(actual)} rows differ, first {differing[0]}" if differing else ""
