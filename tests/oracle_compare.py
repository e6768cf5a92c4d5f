"""Run a query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect())


def oracle_rows(con, sql: str):
    table = con.sql(sql).to_arrow_table()
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, Counter(zip(*columns)), {n: str(table.schema.field(n).type) for n in names}


def compare(spark, con, query, sql: str, sf_dir: str) -> list[str]:
    """Differences between the two results; empty when they agree."""
    df = query(spark, sf_dir)
    names, ours = spark_rows(df)
    theirs_names, theirs, types = oracle_rows(con, sql)
    problems = []
    if names != theirs_names:
        return [f"columns {names} against {theirs_names}"]
    kinds = {"bigint": "int64", "int": "int32", "double": "double", "string": "string", "date": "date32[day]",
             "boolean": "bool"}
    for name, dtype in df.dtypes:
        if kinds.get(dtype) != types[name]:
            problems.append(f"type of {name}: {dtype} against {types[name]}")
    if ours != theirs:
        extra, lacking = ours - theirs, theirs - ours
        problems.append(
            f"{sum(ours.values())} rows against {sum(theirs.values())}; only in Spark {sum(extra.values())}: "
            f"{list(extra)[:2]}; only in SQL {sum(lacking.values())}: {list(lacking)[:2]}"
        )
    return problems
