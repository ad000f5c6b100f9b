"""The chunked operators equal plain windows, also when one group holds most rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from homeload.operators import ordered as o

LEVELS = [[], ["hundreds"], ["hundreds", "tens"]]


@pytest.fixture(scope="module")
def skewed(spark):
    df = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("g"),
        F.pmod(F.xxhash64("id"), F.lit(3)).alias("v"), F.expr("id div 100").alias("hundreds"), F.expr("id div 10").alias("tens"),
    )
    return df.withColumn("n", F.when(F.col("v") > 0, F.col("v")))


@pytest.mark.parametrize("levels", LEVELS)
@pytest.mark.parametrize("group", [["g"], []])
def test_running_number_and_total(skewed, levels, group):
    w = Window.partitionBy(*group).orderBy("id")
    got = o.running_number(skewed, group, ["id"], "k", levels).withColumn("want", F.row_number().over(w))
    assert got.where("k <> want").count() == 0
    got = o.running_total(skewed, group, ["id"], F.col("v"), "s", levels)
    got = got.withColumn("want", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert got.where("s <> want").count() == 0 and got.count() == 3000


@pytest.mark.parametrize("levels", LEVELS)
@pytest.mark.parametrize("following", [False, True])
def test_neighbour_keeps_nulls_apart_from_ends(skewed, levels, following):
    got = o.neighbour(skewed, ["g"], ["id"], ["n", "id"], "near", levels, following)
    w = Window.partitionBy("g").orderBy("id")
    want = (F.lead if following else F.lag)(F.struct("n", "id")).over(w)
    assert got.withColumn("want", want).where(~F.col("near").eqNullSafe(F.col("want"))).count() == 0


@pytest.mark.parametrize("levels", LEVELS)
def test_runs(skewed, levels):
    got = sorted(map(tuple, o.runs(skewed, ["g"], ["id"], "n", levels).collect()), key=repr)
    want, groups = [], {}
    for r in sorted(skewed.collect(), key=lambda r: r.id):
        groups.setdefault(r.g, []).append((r.id, r.n))
    for g, rows in groups.items():
        start = 0
        for i in range(1, len(rows) + 1):
            if i == len(rows) or rows[i][1] != rows[start][1]:
                want.append((g, rows[start][0], rows[start][1], i - start))
                start = i
    assert got == sorted(want, key=repr)


def test_latest(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("b", 2, "y")], "k STRING, t INT, v STRING")
    assert sorted(map(tuple, o.latest(df, ["k"], ["t"]).collect())) == [("a", 3, None), ("b", 2, "y")]
