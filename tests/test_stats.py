"""Test statistics and p-values against worked examples."""

import math

import pytest
from pyspark.sql import functions as F

from staylens.functions import tails
from staylens.operators import market, models, stats


def test_tails():
    assert tails.t_tail(2.228138852, 10) == pytest.approx(0.025, rel=1e-7)
    assert tails.t_tail(-1.0, 5) == pytest.approx(1 - tails.t_tail(1.0, 5))
    assert tails.f_tail(4.102821, 2, 10) == pytest.approx(0.05, rel=1e-6)
    assert tails.chi2_tail(5.991464547, 2) == pytest.approx(0.05, rel=1e-9)
    assert tails.chi2_tail(0.5, 2) == pytest.approx(math.exp(-0.25))
    assert tails.normal_tail(1.959963985) == pytest.approx(0.025, rel=1e-7)


def frame(spark, groups):
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    return spark.createDataFrame(rows + [("x", None), ("other", 5.0)], "g string, v double")


def test_two_groups(spark):
    x, y = [19, 22, 16, 29, 24], [20, 11, 17, 12]
    one = stats.two_group_test(frame(spark, {"x": x, "y": y}), "v", "g", "x", "y").first()
    mean = [sum(v) / len(v) for v in (x, y)]
    var = [sum((a - m) ** 2 for a in v) / (len(v) - 1) for v, m in zip((x, y), mean)]
    error = [v / len(g) for v, g in zip(var, (x, y))]
    assert one.t == pytest.approx((mean[0] - mean[1]) / math.sqrt(sum(error)))
    assert one.t_df == pytest.approx(sum(error) ** 2 / (error[0] ** 2 / 4 + error[1] ** 2 / 3))
    assert (one.u, one.median_a, one.median_b) == (17.0, 22.0, 14.5)
    assert one.u_p == pytest.approx(0.1113, abs=1e-3)  # normal approximation with continuity correction
    pooled = math.sqrt((4 * var[0] + 3 * var[1]) / 7)
    assert one.cohen_d == pytest.approx((mean[0] - mean[1]) / pooled) and one.effect == "large"
    assert one.rank_biserial == pytest.approx(abs(1 - 2 * 17 / 20))


def test_k_groups(spark):
    groups = {"a": [6, 8, 4, 5, 3, 4], "b": [8, 12, 9, 11, 6, 8], "c": [13, 9, 11, 8, 7, 12], "small": [1]}
    one = stats.k_group_test(frame(spark, groups), "v", "g", min_size=6, log=False).first()
    assert (one.k, one.n_total) == (3, 18)
    assert one.f == pytest.approx(9.2647, abs=1e-4)
    assert one.f_p == pytest.approx(0.00239, abs=1e-5)
    assert one.eta2 == pytest.approx(84 / 152)
    assert one.epsilon2 == pytest.approx((one.h - 2) / 15)


def test_proportions(spark):
    rows = [("w", i < 60) for i in range(100)] + [("d", i < 45) for i in range(100)] + [("d", None)]
    one = stats.two_proportion_test(spark.createDataFrame(rows, "g string, f boolean"), "f", "g", "w", "d").first()
    assert one.z == pytest.approx(0.15 / math.sqrt(0.525 * 0.475 * 0.02))
    assert one.p == pytest.approx(math.erfc(one.z / math.sqrt(2)))


def test_least_squares_recovers_the_plane(spark):
    rows = spark.range(200).selectExpr("cast(id % 7 as double) a", "cast(id % 11 as double) b").withColumn("y", 2 + 3 * F.col("a") - F.col("b"))
    found = {r.term: r.coefficient for r in stats.ols(rows, F.col("y"), ["a", "b"]).collect()}
    assert found == pytest.approx({"Intercept": 2.0, "a": 3.0, "b": -1.0})


def test_constant_column_has_no_correlation(spark):
    df = spark.range(10).selectExpr("cast(id as double) a", "1.5D as c", "cast(-id as double) b")
    found = {r.variable: r["corr"] for r in stats.corr_with(df, "a", ["b", "c"]).collect()}
    assert found["c"] is None and found["b"] == pytest.approx(-1.0)


def test_concentration(spark):
    sizes = spark.createDataFrame([("a", i, n) for i, n in enumerate([10, 5, 5, 1, 1])] + [("b", 9, 3)], "city string, host_id long, n_listings long")
    half = {r.city: (r.hosts_needed, r.n_hosts) for r in market.holders_of(sizes, ["city"]).collect()}
    assert half == {"a": (2, 5), "b": (1, 1)}
    top = {(r.city, r.top): r.share for r in market.top_share(sizes, ["city"], [0.01, 0.5]).collect()}
    assert top == pytest.approx({("a", 0.01): 10 / 22, ("a", 0.5): 15 / 22, ("b", 0.01): 1.0, ("b", 0.5): 1.0})


def test_models(spark):
    rows = spark.range(600).selectExpr(
        "id", "cast(id % 13 as double) a", "cast(id * 7 % 17 as double) b", "exp(3 + (id % 13) / 10D * (id * 7 % 17) / 10D) price"
    )
    ready = models.assemble(rows, ["a", "b"], "price", "id")
    chosen = {"linear": models.linear, "forest": lambda: models.forest(trees=15, depth=8)}
    scores = models.cross_validate(ready, "id", chosen, k=3).collect()
    assert [s.model for s in scores] == ["forest", "linear"]
    assert all(0 < s.mae <= s.rmse and s.mape > 0 for s in scores)
    train, test = models.split(rows, "id")
    assert train.count() + test.count() == 600 and 80 < test.count() < 160
    again = {r.id for r in models.split(rows.repartition(5), "id")[1].collect()}
    assert again == {r.id for r in test.collect()}
    weights = models.feature_importance(ready, ["a", "b"], lambda: models.forest(trees=5, depth=5)).collect()
    assert sum(w.importance for w in weights) == pytest.approx(1.0)


def test_exact_rank_sums(spark):
    """Small groups without equal values: p by counting all orders in SQL."""
    import duckdb

    a, b = [1.5, 9.0, 4.0, 7.5, 3.25], [2.0, 8.0, 10.0, 11.0, 12.5, 6.0]
    counted = duckdb.sql(
        """
        WITH o AS (SELECT bit_count(m) AS n, list_sum([CASE WHEN (m >> i) & 1 = 1 THEN i + 1 ELSE 0 END FOR i IN range(11)]) - 15 AS u
                   FROM (SELECT unnest(range(2048)) AS m))
        SELECT u, count(*) FROM o WHERE n = 5 GROUP BY 1
        """
    ).fetchall()
    u = sum(x > y for x in a for y in b)
    total = sum(n for _, n in counted)
    more, less = (sum(n for v, n in counted if ok(v)) / total for ok in (lambda v: v >= u, lambda v: v <= u))
    for alternative, p in (("greater", more), ("less", less), ("two-sided", min(1, 2 * min(more, less)))):
        one = stats.two_group_test(frame(spark, {"x": a, "y": b}), "v", "g", "x", "y", alternative).first()
        assert one.u == u and abs(one.u_p - p) < 1e-12, alternative
    tied = stats.two_group_test(frame(spark, {"x": [*a, 2.0], "y": b}), "v", "g", "x", "y").first()
    assert tied.u_p is not None and "u_ties" not in tied.asDict()
