from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns whose expressions run once per row, however often they are used.

    Spark merges a plain projection into the filters above it, so a costly
    expression (a date parse, a pattern) would run again for each use. The rows of
    a generator are not merged; here it makes exactly one row out of each.
    """
    row = F.struct(*[expr.alias(name) for name, expr in columns.items()])
    return df.select("*", F.inline(F.array(row)))
