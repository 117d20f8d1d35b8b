"""Order statistics against plain Python, on skewed groups and any partitioning."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from staylens.operators import order, quality


def data():
    rng = random.Random(5)
    rows = [("hot", rng.choice([1.0, 2.0, 2.0, 7.5])) for _ in range(4000)]
    rows += [(g, rng.uniform(-1e4, 1e6)) for g in ("a", "b", None) for _ in range(rng.randint(1, 300))]
    rows += [("a", None), ("a", float("nan")), ("empty", None)]
    return [(i, g, v) for i, (g, v) in enumerate(rows)]


@pytest.mark.parametrize("partitions", [1, 17])
def test_quantiles(spark, partitions):
    rows = data()
    df = spark.createDataFrame(rows, "i long, g string, v double").repartition(partitions)
    found = {r.g: r for r in order.quantiles(df, ["g"], "v", {"m": 0.5, "q": 0.25, "p": (0.95, "nearest")}).collect()}
    groups = {}
    for _, g, v in rows:
        if v is not None and v == v:
            groups.setdefault(g, []).append(v)
    assert set(found) == set(groups)
    for g, values in groups.items():
        values.sort()
        assert found[g].m == pytest.approx(statistics.median(values))
        place = (len(values) - 1) * 0.25
        low = int(place)
        high = min(low + 1, len(values) - 1)
        assert found[g].q == pytest.approx(values[low] + (values[high] - values[low]) * (place - low))
        assert found[g].p == values[int((len(values) - 1) * 0.95 + 0.5)]


def test_average_ranks(spark):
    df = spark.createDataFrame([(v,) for v in (3.0, 1.0, 3.0, -2.0, 3.0, None)], "v double")
    found = {r.value: (r.t, r["rank"]) for r in order.average_ranks(df, "v").collect()}
    assert found == {-2.0: (1, 1.0), 1.0: (1, 2.0), 3.0: (3, 4.0)}


@pytest.mark.parametrize("partitions", [1, 13])
def test_dense_keys_follow_the_order(spark, partitions):
    df = spark.createDataFrame([(f"k{i:04d}",) for i in range(2000)] + [(None,)], "k string").repartition(partitions)
    found = [(r.k, r.sk) for r in order.dense_keys(df, ["k"], "sk").orderBy("sk").collect()]
    assert [sk for _, sk in found] == list(range(1, 2002))
    assert [k for k, _ in found] == [None] + [f"k{i:04d}" for i in range(2000)]


def test_keep_first_counts_null_as_one_key(spark):
    df = spark.createDataFrame([(1, None, "x"), (0, None, "y"), (5, 7, "z"), (4, 7, "w"), (9, 8, None)], "r long, k long, v string")
    found = sorted(order.keep_first(df.repartition(5), ["k"], ["r"]).collect(), key=repr)
    assert {(r.k, r.r, r.v) for r in found} == {(None, 0, "y"), (7, 4, "w"), (8, 9, None)}


def test_first_k(spark):
    df = spark.range(5000).select(F.col("id").alias("r"), F.when(F.col("id") % 3 == 0, "hot").otherwise("rest").alias("g"))
    found = order.first_k(df.repartition(9), ["g"], "r", 4).collect()
    assert sorted((r.g, r.r) for r in found) == [("hot", v) for v in (0, 3, 6, 9)] + [("rest", v) for v in (1, 2, 4, 5)]


def test_exact_duplicates_with_nulls(spark):
    rows = [(1, None), (1, None), (None, 1), (2, 2), (2, 2), (2, 2)]
    df = spark.createDataFrame(rows, "a long, b long")
    assert quality.exact_duplicates(df, ["a", "b"]).first()[0] == 3
    assert quality.key_duplicates(df, ["a"]).first()[0] == 3
    assert quality.exact_duplicates(df.where("a = 9"), ["a", "b"]).first()[0] == 0


@pytest.mark.parametrize("value", [
    "40 + id * 4e-9", "1e13 + id", "case when id % 2 = 0 then 1e13 + id * 1e-2 else 1e13 + 5e7 + id end",
    "case when id = 0 then -1e300 else 1e9 + id end",
])
def test_crowded_buckets_follow_the_data(spark, value):
    df = spark.range(100_000).repartition(8).select(F.expr(value).alias("v"))
    sizes = order.refined(order.counted(df, [], "v"), []).groupBy("_b").agg(
        F.count(F.lit(1)).alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high")
    ).orderBy("_b").collect()
    assert sum(r.n for r in sizes) == 100_000 and max(r.n for r in sizes) <= 8192
    assert all(a.high < b.low for a, b in zip(sizes, sizes[1:]))
    values = sorted(r.v for r in df.collect())
    assert order.quantiles(df, [], "v", {"m": 0.5}).first().m == pytest.approx(statistics.median(values), rel=1e-12)
    assert order.average_ranks(df, "v").agg(F.sum("rank")).first()[0] == 100_000 * 100_001 / 2


def test_first_k_is_cut_before_the_shuffle(spark):
    """A hot group sends few rows to the task that orders it, in either way."""
    df = spark.range(200_000).repartition(8).select(
        F.when(F.col("id") % 3 > 0, "hot").alias("g"),
        F.when(F.col("id") < 3, F.col("id")).otherwise(F.lit(10**13) + F.col("id")).alias("r"),
    )
    plan = order.first_k(df, ["g"], "r", 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan[plan.rindex("Exchange hashpartitioning(g"):]
    assert order.cut_above(df, ["g"], "r", 1000).count() < 5000
    for k in (5, 1000, 3000):
        found = order.first_k(df, ["g"], "r", k).collect()
        for g, start in (("hot", 1), (None, 0)):
            ids = [i for i in range(start, 3 * k + 3) if (i % 3 > 0) == (start == 1)][:k]
            assert sorted(r.r for r in found if r.g == g) == sorted(i if i < 3 else 10**13 + i for i in ids)
