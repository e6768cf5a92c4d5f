"""Running totals without a task per group."""

import random

from pyspark.sql import functions as F

from barloom.operators.positions import numbered, running


def test_running_sums_in_and_across_groups(spark):
    rng = random.Random(5)
    # One group has most rows, one is null; places within a group are distinct.
    rows = [(g, n, rng.randrange(100)) for g, size in (("hot", 3000), ("a", 5), (None, 40), ("z", 1)) for n in range(size)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, n int, v bigint").repartition(7)
    order = [F.col("n").asc()]
    found = running(df, ["g"], order, order, {"s": F.col("v"), "place": F.lit(1).cast("bigint")}, {"x": F.col("v")})
    found = {(r.g, r.n): (r.s, r.place, r.x) for r in found.collect()}
    expected, state = {}, {}
    for g, n, v in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        s, place, x = state.get(g, (0, 0, 0))
        state[g] = expected[g, n] = (s + v, place + 1, x ^ v)
    assert found == expected


def test_numbered_spreads_rows(spark):
    df = numbered(spark.range(1000).repartition(5), [F.col("id").desc()])
    assert {(r.id, r.position) for r in df.collect()} == {(i, 1000 - i) for i in range(1000)}
    assert numbered(spark.range(0), [F.col("id").desc()]).count() == 0
