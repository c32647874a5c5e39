"""Compare a Spark result with its DuckDB counterpart, types and values."""

from __future__ import annotations

import math

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _plain(t: pa.DataType) -> str:
    if pa.types.is_large_string(t) or pa.types.is_string(t) or str(t) == "string_view":
        return "string"
    if pa.types.is_list(t) or pa.types.is_large_list(t):
        return f"list<{_plain(t.value_type)}>"
    if pa.types.is_struct(t):
        return "struct<" + ",".join(f"{f.name}:{_plain(f.type)}" for f in t) + ">"
    return str(t)


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
    if isinstance(v, list):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple((k, _norm(x)) for k, x in sorted(v.items()))
    return v


def _rows(tbl: pa.Table, names: list[str]) -> list[tuple]:
    cols = [tbl.column(n).to_pylist() for n in names]
    rows = [tuple(_norm(v) for v in r) for r in zip(*cols)]
    return sorted(rows, key=repr)


def compare(spark_tbl: pa.Table, duck_tbl: pa.Table) -> list[str]:
    """Empty list when both agree, else readable differences."""
    names, other = sorted(spark_tbl.column_names), sorted(duck_tbl.column_names)
    if names != other:
        return [f"columns {names} vs {other}"]
    problems = []
    for n in names:
        a, b = _plain(spark_tbl.schema.field(n).type), _plain(duck_tbl.schema.field(n).type)
        if a != b:
            problems.append(f"type of {n}: {a} vs {b}")
    if spark_tbl.num_rows != duck_tbl.num_rows:
        return [*problems, f"rows {spark_tbl.num_rows} vs {duck_tbl.num_rows}"]
    a, b = _rows(spark_tbl, names), _rows(duck_tbl, names)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        only_a, only_b = set(map(repr, a)) - set(map(repr, b)), set(map(repr, b)) - set(map(repr, a))
        problems.append(f"{len(diff)} rows differ {names}; spark {sorted(only_a)[:3]}; duck {sorted(only_b)[:3]}")
    return problems
