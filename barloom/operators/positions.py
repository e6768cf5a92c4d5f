"""Running totals and row numbers over sorted data of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.session import scratch_dir

PART = "_part"


def running(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    ranges: Sequence[Column],
    sums: dict[str, Column] | None = None,
    xors: dict[str, Column] | None = None,
) -> DataFrame:
    """``df`` with running sums and exclusive-ors per ``group`` in ``order``, the own row included.

    Rows are cut into range partitions by the group and ``ranges`` (leading parts of the order),
    and each partition is scanned on its own; what lies before it comes from the totals of the
    partitions, of which there is one row each. So no group needs a task of its own, however
    many rows it has. The cut is written below the checkpoint folder, so a task that is run again
    sees the same one. Null groups are a group. Rows equal in all of ``order`` may stand either way.
    """
    spark = df.sparkSession
    sums, xors = sums or {}, xors or {}
    values = {**sums, **xors}
    path = scratch_dir(spark)
    inputs = {f"_of_{name}": column for name, column in values.items()}
    cut = df.withColumns(inputs).repartitionByRange(*[F.col(g).asc_nulls_first() for g in group], *ranges)
    cut = cut.withColumn(PART, F.spark_partition_id())
    cut.write.parquet(path)
    cut = spark.read.schema(cut.schema).parquet(path)

    def total(name: str) -> Column:
        return (F.sum if name in sums else F.bit_xor)(f"_of_{name}")

    within = Window.partitionBy(PART, *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    scanned = cut.select("*", *[total(name).over(within).alias(name) for name in values])
    parts = cut.groupBy(*group, PART).agg(*[total(name).alias(f"_of_{name}") for name in values])
    earlier = Window.partitionBy(*group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select(*group, PART, *[total(name).over(earlier).alias(f"_before_{name}") for name in values], F.lag(PART).over(earlier.rowsBetween(-1, -1)).alias("_last"))
    # A group begins in one partition only: at most one row per partition is left.
    before = before.where(F.col("_last").isNotNull()).drop("_last")
    renamed = before.withColumnsRenamed({c: f"_b_{c}" for c in (*group, PART)})
    same = F.lit(True)
    for c in (*group, PART):
        same = same & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    joined = scanned.join(F.broadcast(renamed), same, "left")
    result = {}
    for name in values:
        earlier_value = F.coalesce(F.col(f"_before_{name}"), F.lit(0))
        result[name] = F.col(name) + earlier_value if name in sums else F.col(name).bitwiseXOR(earlier_value)
    return joined.select(*df.columns, *[c.alias(n) for n, c in result.items()])


def numbered(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """``df`` with the place of each row (from 1) in ``order``, without one task for all rows."""
    return running(df, [], order, order, {name: F.lit(1).cast("bigint")})
