"""Positions, ranks, tiles and medians with forced cuts, against plain Python."""

import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from yieldstone.operators.position import rank_in, row_number_in, tile_of
from yieldstone.operators.stats import exact_median


def rows(seed):
    """Two groups, one holding most rows, with one value shared by a third of them."""
    r = random.Random(seed)
    out = []
    for n in range(900):
        group = "hot" if n % 10 else "cold"
        out.append((group, 0.0 if n % 3 == 0 else round(r.uniform(-5, 5), 1), f"T{n:04d}"))
    return out


@pytest.mark.parametrize("cut", [{}, {"sample_bits": 3}, {"sample_bits": 0, "max_cuts": 40}])
def test_numbers_ranks_and_tiles(spark, cut):
    data = rows(7)
    df = spark.createDataFrame(data, "g string, v double, t string").repartition(5)
    got = {r["t"]: (r["rn"], r["size"]) for r in row_number_in(df, "g", ["v", "t"], "rn", "size", **cut).collect()}
    ranks = {r["t"]: r["rk"] for r in rank_in(df, "g", "v", "rk", **cut).collect()}
    assert len(got) == len(ranks) == len(data)
    for group in ("hot", "cold"):
        members = sorted((v, t) for g, v, t in data if g == group)
        for i, (v, t) in enumerate(members, 1):
            assert got[t] == (i, len(members))
            assert ranks[t] == 1 + sum(w < v for w, _ in members)


def test_cuts_split_a_hot_value(spark):
    df = spark.createDataFrame([("g", 0.0, f"T{n:05d}") for n in range(2000)], "g string, v double, t string")
    from yieldstone.operators.position import _sliced

    sizes = [r["count"] for r in _sliced(df, "g", ["v", "t"], 6, 1000).groupBy("_slice").count().collect()]
    assert sum(sizes) == 2000 and max(sizes) < 700


@pytest.mark.parametrize("size", [1, 3, 4, 5, 6, 7, 10, 23])
def test_tiles_equal_ntile(spark, size):
    from pyspark.sql import Window

    w = Window.orderBy("id")
    df = spark.range(size).select("id", F.ntile(5).over(w).alias("want"))
    mine = tile_of(F.col("id") + 1, F.lit(size), 5)
    assert df.filter(mine != F.col("want")).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 50, 51])
def test_median(spark, n):
    r = random.Random(n)
    values = [float(r.randint(0, 9)) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    assert exact_median(df, "v", "m", sample_bits=1).first()["m"] == statistics.median(values)
    assert Counter(values).total() == n


def test_cost_does_not_grow_with_the_number_of_slices(spark):
    """5,000 cuts and more in one group: each row is placed by a binary search."""
    import time

    df = spark.range(80_000).selectExpr("1 AS g", "pmod(xxhash64(id), 1000003) / 7 AS v", "id AS t")
    began = time.perf_counter()
    got = row_number_in(df, "g", ["v", "t"], "rn", sample_bits=3, max_cuts=8000).cache()
    assert got.agg(F.countDistinct("rn"), F.max("rn")).first() == (80_000, 80_000)
    assert time.perf_counter() - began < 60
    wrong = got.alias("a").join(got.alias("b"), F.expr("a.rn + 1 = b.rn")).where("a.v > b.v OR (a.v = b.v AND a.t > b.t)")
    assert wrong.isEmpty()
    got.unpersist()
