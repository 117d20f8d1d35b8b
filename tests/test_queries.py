"""Every registered query against its SQL form, on the smallest tables. A query
without one has expected rows here."""

from concurrent.futures import ThreadPoolExecutor

import __spark_entry__ as driver
from compare import connect, difference

FOLDER = "/root/testdata/sf0.001"


def beats_the_mean(df) -> str | None:
    """Predictions of log prices are closer than their mean would be."""
    rows = df.collect()
    mean = sum(r["label"] for r in rows) / len(rows)
    own, plain = (sum(e * e for e in errors) for errors in (
        [r["label"] - r["prediction"] for r in rows], [r["label"] - mean for r in rows],
    ))
    return None if len(rows) > 100 and own < 0.3 * plain else f"{own} against {plain} on {len(rows)} rows"


def three_models(df) -> str | None:
    rows = df.collect()
    ordered = [r["rmse"] for r in rows]
    good = len(rows) == 3 and ordered == sorted(ordered) and rows[-1]["model"] == "Linear Regression" and all(0 < r["mae"] <= r["rmse"] < 2 for r in rows)
    return None if good else str(rows)


def sums_to_one(df) -> str | None:
    total = sum(r["importance"] for r in df.collect())
    return None if abs(total - 1) < 1e-9 else f"importances sum to {total}"


def p_values(df) -> str | None:
    one = df.first().asDict()
    bad = {k: v for k, v in one.items() if (k == "p" or k.endswith("_p")) and not 0 <= v <= 1}
    return None if df.count() == 1 and not bad else str(bad)


def clusters(df) -> str | None:
    """Every distinct place once, core points in a cluster, noise in none."""
    rows = df.collect()
    places = {(r["room_type"], r["lat"], r["lon"]) for r in rows}
    bad = [r for r in rows if r["core"] and r["cluster"] < 0]
    return None if len(places) == len(rows) > 0 and not bad else f"{len(rows)} rows, {len(places)} places, {len(bad)} bad"


def counted(df) -> str | None:
    rows = df.collect()
    return None if rows and all(r["clusters"] >= 1 and r["clustered"] > 0 for r in rows) else str(rows)


EXPECTED = {
    "M7_forest_predictions": beats_the_mean, "M8_boosted_predictions": beats_the_mean,
    "M9_cross_validated_errors": three_models, "M10_feature_importance": sums_to_one,
    "T5_T14_two_group_test_with_p": p_values, "T8_T12_k_group_test_with_p": p_values,
    "T13_two_proportion_test_with_p": p_values, "G2_density_clusters": clusters, "G2_cluster_count": counted,
}


def test_queries_equal_their_sql(spark):
    queries, statements = driver.queries(), driver.oracle_sql()
    # the training-data operators have tests of their own
    own = [n for n in queries if not (n.startswith("op") and n[2:3].isdigit()) and n != "pipeline"]
    assert set(own) <= set(statements) | set(EXPECTED)
    con = connect(FOLDER)

    def check(name):
        try:
            df = queries[name](spark, FOLDER)
            if name in statements:
                return name, difference(df, con.cursor(), statements[name])
            return name, EXPECTED[name](df)
        except Exception as error:  # reported with the name of the query
            return name, str(error)[:500]

    with ThreadPoolExecutor(6) as pool:
        found = dict(pool.map(check, own))
    assert {n: d for n, d in found.items() if d is not None} == {}


def test_entry(spark):
    assert driver.entry(spark).count() > 0
