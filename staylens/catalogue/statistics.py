"""Tests, correlations, ranks and fits (T, W7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from staylens.catalogue.registry import SQL, query, rounded
from staylens.config import SUBSCORES
from staylens.functions.numbers import day_type
from staylens.operators import order, stats
from staylens.plans import hypotheses

A, B = "1-URGENT", "5-LOW"
PAIRS = "(SELECT CASE room_type WHEN '1-URGENT' THEN 1 ELSE 0 END AS g, price AS x FROM listing WHERE room_type IN ('1-URGENT', '5-LOW') AND price IS NOT NULL)"
MOMENTS = (
    "(SELECT count(*) FILTER (g = 1) AS na, count(*) FILTER (g = 0) AS nb, avg({x}) FILTER (g = 1) AS ma, avg({x}) FILTER (g = 0) AS mb, "
    "var_samp({x}) FILTER (g = 1) AS va, var_samp({x}) FILTER (g = 0) AS vb FROM {pairs})"
)
RANKED = (
    "(SELECT *, before + (t + 1) / 2 AS r FROM (SELECT {x} AS x, CAST(count(*) AS DOUBLE) AS t, "
    "CAST(sum(count(*)) OVER (ORDER BY {x}) AS DOUBLE) - count(*) AS before FROM {rows} GROUP BY {x}))"
)
ANOVA = """(SELECT count(*) AS k, sum(n) AS big, sum(n * pow(m - grand, 2)) AS ssb, sum((n - 1) * v) AS ssw
    FROM (SELECT {g} AS g, CAST(count(*) AS DOUBLE) AS n, avg({x}) AS m, var_samp({x}) AS v FROM {rows} GROUP BY 1),
    (SELECT avg({x}) AS grand FROM {rows}))"""


def _pairs(t):
    return stats.pairs_of(t.listing("room_type", "price"), "price", "room_type", A, B)


@query(
    "T5_T10_welch_and_cohen",
    "SELECT CAST(na AS BIGINT) AS n_a, CAST(nb AS BIGINT) AS n_b, round((ma - mb) / sqrt(va / na + vb / nb), 6) AS t, "
    "round(pow(va / na + vb / nb, 2) / (pow(va / na, 2) / (na - 1) + pow(vb / nb, 2) / (nb - 1)), 4) AS t_df, "
    "round((ma - mb) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2)), 6) AS cohen_d FROM " + MOMENTS.format(x="ln(x)", pairs=PAIRS),
)
def _(t):
    out = stats.welch(_pairs(t), log=True)
    parts = rounded(out.select("n_a", "n_b", "t", "cohen_d"), 6)
    return parts.join(rounded(out.select("n_a", "t_df"), 4), "n_a").select("n_a", "n_b", "t", "t_df", "cohen_d")


@query(
    "T6_levene",
    "WITH far AS (SELECT g, abs(ln(x) - median(ln(x)) OVER (PARTITION BY g)) AS z FROM " + PAIRS + ") "
    "SELECT round((ssb / (k - 1)) / (ssw / (big - k)), 6) AS levene_w, CAST(k AS BIGINT) AS k, CAST(big AS BIGINT) AS n_total FROM " + ANOVA.format(g="g", x="z", rows="far"),
)
def _(t):
    return rounded(stats.levene(_pairs(t), log=True), 6)


RANK_SUM = (
    "WITH p AS " + PAIRS + ", r AS " + RANKED.format(x="x", rows="p")
    + ", s AS (SELECT CAST(count(*) FILTER (g = 1) AS DOUBLE) AS na, CAST(count(*) FILTER (g = 0) AS DOUBLE) AS nb, sum(r) FILTER (g = 1) AS ra FROM p JOIN r USING (x)), "
    "u AS (SELECT *, ra - na * (na + 1) / 2 AS u, na * nb / 2 AS mu, sqrt(na * nb / 12 * (na + nb + 1 - (SELECT sum(t * t * t - t) FROM r) / ((na + nb) * (na + nb - 1)))) AS sd FROM s) "
)


@query(
    "T7_T11_mann_whitney",
    RANK_SUM + "SELECT u, round((u - mu - 0.5e0) / sd, 6) AS u_z, round(1 - 2 * u / (na * nb), 6) AS rank_biserial, CAST(na AS BIGINT) AS n_a, CAST(nb AS BIGINT) AS n_b FROM u",
)
def _(t):
    return rounded(stats.mann_whitney(_pairs(t), "greater"), 6)


@query(
    "T7_mann_whitney_with_ties",
    RANK_SUM.replace("price AS x", "availability_365 AS x").replace("price IS NOT NULL", "availability_365 IS NOT NULL")
    + "SELECT u, round(sign(u - mu) * (abs(u - mu) - 0.5e0) / sd, 6) AS u_z, round(1 - 2 * u / (na * nb), 6) AS rank_biserial, CAST(na AS BIGINT) AS n_a, CAST(nb AS BIGINT) AS n_b FROM u",
)
def _(t):
    pairs = stats.pairs_of(t.listing("room_type", "availability_365"), "availability_365", "room_type", A, B)
    return rounded(stats.mann_whitney(pairs), 6)


GROUPS = "(SELECT neighbourhood AS g, price AS x FROM listing WHERE price IS NOT NULL AND neighbourhood IN (SELECT neighbourhood FROM listing WHERE price IS NOT NULL GROUP BY 1 HAVING count(*) >= 30))"


@query(
    "T8_T9_T12_k_groups",
    "WITH rows_kept AS " + GROUPS + ", r AS " + RANKED.format(x="x", rows="rows_kept") + ", a AS " + ANOVA.format(g="g", x="ln(x)", rows="rows_kept")
    + ", s AS (SELECT sum(rs * rs / n) AS spread FROM (SELECT g, sum(r) AS rs, CAST(count(*) AS DOUBLE) AS n FROM rows_kept JOIN r USING (x) GROUP BY 1)), "
    "f AS (SELECT *, (12 / (big * (big + 1)) * spread - 3 * (big + 1)) / (1 - (SELECT sum(t * t * t - t) FROM r) / (big * big * big - big)) AS h FROM a, s) "
    "SELECT CAST(k AS BIGINT) AS k, CAST(big AS BIGINT) AS n_total, round((ssb / (k - 1)) / (ssw / (big - k)), 6) AS f, round(ssb / (ssb + ssw), 6) AS eta2, round(h, 6) AS h, round((h - k + 1) / (big - k), 6) AS epsilon2 FROM f",
)
def _(t):
    return rounded(stats.k_group_statistics(t.listing("neighbourhood", "price"), "price", "neighbourhood"), 6)


@query(
    "T13_two_proportions",
    """WITH c AS (SELECT count(*) FILTER (w) AS na, count(*) FILTER (NOT w) AS nb, count(*) FILTER (w AND available) / count(*) FILTER (w) AS pa,
      count(*) FILTER (NOT w AND available) / count(*) FILTER (NOT w) AS pb, count(*) FILTER (available) / count(*) AS p
      FROM (SELECT available, isodow(date) IN (6, 7) AS w FROM cal WHERE available IS NOT NULL))
    SELECT CAST(na AS BIGINT) AS n_a, CAST(nb AS BIGINT) AS n_b, round(pa, 6) AS share_a, round(pb, 6) AS share_b,
    round((pa - pb) / sqrt(p * (1 - p) * (1e0 / na + 1e0 / nb)), 6) AS z, round(2 * asin(sqrt(pa)) - 2 * asin(sqrt(pb)), 6) AS cohen_h FROM c""",
)
def _(t):
    days = t.calendar("date", "available").withColumn("daytype", day_type(F.col("date")))
    return rounded(stats.two_proportion_statistics(days, "available", "daytype", "weekend", "weekday"), 6)


@query(
    "T14_group_medians",
    "SELECT room_type, round(median(price), 4) AS median_price, CAST(count(price) AS BIGINT) AS n FROM listing WHERE room_type IN ('1-URGENT', '5-LOW') GROUP BY 1",
)
def _(t):
    kept = t.listing("room_type", "price").where(F.col("room_type").isin(A, B))
    return rounded(order.grouped(kept, ["room_type"], [F.count("price").alias("n")], {"median_price": "price"}))


@query("T5_T14_two_group_test_with_p")
def _(t):
    """All two-group results with p-values; the statistics are checked above."""
    return stats.two_group_test(t.listing("room_type", "price"), "price", "room_type", A, B, "greater", log=True)


@query("T8_T12_k_group_test_with_p")
def _(t):
    return stats.k_group_test(t.listing("neighbourhood", "price"), "price", "neighbourhood")


@query("T13_two_proportion_test_with_p")
def _(t):
    days = t.calendar("date", "available").withColumn("daytype", day_type(F.col("date")))
    return stats.two_proportion_test(days, "available", "daytype", "weekend", "weekday")


@query(
    "T1_correlation_pair",
    "SELECT round(corr(reviews_per_month, estimated_occupancy_l365d), 6) AS corr FROM listing",
)
def _(t):
    return rounded(stats.corr_pair(t.listing("reviews_per_month", "estimated_occupancy_l365d"), "reviews_per_month", "estimated_occupancy_l365d"), 6)


@query(
    "T1_correlation_with_target",
    " UNION ALL ".join(
        f"SELECT '{s}' AS variable, round(corr({s}, review_scores_rating), 6) AS corr FROM listing" for s in SUBSCORES
    ),
)
def _(t):
    return rounded(stats.corr_with(t.listing("review_scores_rating", *SUBSCORES), "review_scores_rating", SUBSCORES), 6)


@query("T3_slope", "SELECT city, round(regr_slope(price, availability_365), 6) AS slope FROM listing GROUP BY 1")
def _(t):
    return rounded(stats.slope(t.listing("city", "price", "availability_365"), "price", "availability_365", ["city"]), 6)


FEATS = ("price", "number_of_reviews", "reviews_per_month", "review_scores_rating", "estimated_occupancy_l365d")
RANKS = ", ".join(
    f"rank() OVER (ORDER BY {f}) + (count(*) OVER (PARTITION BY {f}) - 1) / 2e0 AS r{i}" for i, f in enumerate(FEATS)
)


@query(
    "T2_spearman",
    f"WITH whole AS (SELECT {', '.join(FEATS)} FROM listing WHERE {' AND '.join(f + ' IS NOT NULL' for f in FEATS)}), ranked AS (SELECT {RANKS} FROM whole) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, " + ("1e0" if i == j else f"round(corr(r{i}, r{j}), 6)") + " AS rho FROM "
        + ("(SELECT 1)" if i == j else "ranked")
        for i, a in enumerate(FEATS)
        for j, b in enumerate(FEATS)
    ),
)
def _(t):
    return rounded(stats.spearman(t.listing(*FEATS), FEATS), 6)


@query(
    "W7_average_ranks",
    "SELECT DISTINCT availability_365 AS value, CAST(count(*) OVER (PARTITION BY availability_365) AS BIGINT) AS t, "
    "rank() OVER (ORDER BY availability_365) + (count(*) OVER (PARTITION BY availability_365) - 1) / 2e0 AS rank, CAST(count(*) OVER () AS BIGINT) AS n FROM listing",
)
def _(t):
    return order.average_ranks(t.listing("availability_365"), "availability_365")


def coefficients_sql(y: str, xs, rows: str) -> str:
    """Least squares: the slope of the target on what is left of each variable once the
    others are taken out of it, and what the means leave for the intercept."""
    from staylens.catalogue.models_and_features import least_squares_sql

    parts, n = [], len(xs)
    for x in xs:
        others = [o for o in xs if o != x]
        steps = least_squares_sql("kept", "i", y, [*others, x], "true")
        last = f"r{n}"
        parts.append(f"SELECT '{x}' AS term, b FROM ({steps} SELECT sum(y * x{n - 1}) / sum(x{n - 1} * x{n - 1}) AS b FROM {last})")
    fit = least_squares_sql("kept", "i", y, list(xs), "true")
    means = " + ".join(f"max(b) FILTER (term = '{x}') * (SELECT avg({x}) FROM kept)" for x in xs)
    return (
        f"WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS i, * FROM {rows}), slopes AS MATERIALIZED ({' UNION ALL '.join(parts)}), "
        f"quality AS (SELECT 1 - sum(pow(label - prediction, 2)) / (count(*) * var_pop(label)) AS r2 FROM ({fit} SELECT * FROM fitted)) "
        f"SELECT term, round(b, 6) AS coefficient, round(r2, 6) AS r2 FROM (SELECT term, b FROM slopes UNION ALL "
        f"SELECT 'Intercept', (SELECT avg({y}) FROM kept) - ({means}) FROM slopes), quality"
    )


SCORED = "(SELECT price, " + ", ".join(SUBSCORES) + " FROM listing WHERE price IS NOT NULL AND " + " AND ".join(f"{s} IS NOT NULL" for s in SUBSCORES) + ")"


@query("T4_least_squares", coefficients_sql("ln(price)", SUBSCORES, SCORED))
def _(t):
    listing = t.listing("price", *SUBSCORES)
    return rounded(stats.ols(listing, F.ln("price"), SUBSCORES), 6)


@query(
    "T4_least_squares_one_variable",
    "SELECT unnest(['Intercept', 'review_scores_value']) AS term, round(unnest([regr_intercept(ln(price), review_scores_value), regr_slope(ln(price), review_scores_value)]), 6) AS coefficient, "
    "round(max(regr_r2(ln(price), review_scores_value)) OVER (), 6) AS r2 FROM listing",
)
def _(t):
    listing = t.listing("price", "review_scores_value")
    return rounded(stats.ols(listing, F.ln("price"), ["review_scores_value"]), 6)


# ---- the five hypotheses over the star -----------------------------------


def _over_star(t, ask, *names: str, **options):
    from staylens.catalogue.keys_and_tables import _star

    return rounded(ask(_star(t), **options).select(*names), 6)


TWO_GROUPS = (
    "WITH p AS ({pairs}), m AS " + MOMENTS.format(x="ln(x)", pairs="p") + " "
    "SELECT CAST(na AS BIGINT) AS n_a, CAST(nb AS BIGINT) AS n_b, (SELECT round(median(x), 6) FROM p WHERE g = 1) AS median_a, "
    "(SELECT round(median(x), 6) FROM p WHERE g = 0) AS median_b, round((ma - mb) / sqrt(va / na + vb / nb), 6) AS t, "
    "round((ma - mb) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2)), 6) AS cohen_d FROM m"
)
TWO_GROUP_NAMES = ("n_a", "n_b", "median_a", "median_b", "t", "cohen_d")


@query("H1_dearer_rooms", TWO_GROUPS.format(pairs="SELECT * FROM " + PAIRS))
def _(t):
    return _over_star(t, hypotheses.dearer_rooms, *TWO_GROUP_NAMES, one=A, other=B)


SUPER = (
    "(SELECT CASE WHEN s THEN 1 ELSE 0 END AS g, review_scores_rating AS x FROM listing l JOIN (SELECT host_id, arg_min(host_is_superhost, id) AS s FROM listing GROUP BY 1) h "
    "ON h.host_id IS NOT DISTINCT FROM l.host_id WHERE review_scores_rating IS NOT NULL)"
)


@query(
    "H2_superhost_ratings",
    RANK_SUM.replace(PAIRS, SUPER)
    + "SELECT CAST(na AS BIGINT) AS n_a, CAST(nb AS BIGINT) AS n_b, u, round((u - mu - 0.5e0) / sd, 6) AS u_z, round(abs(1 - 2 * u / (na * nb)), 6) AS rank_biserial FROM u",
)
def _(t):
    return _over_star(t, hypotheses.superhost_ratings, "n_a", "n_b", "u", "u_z", "rank_biserial")


@query(
    "H3_busy_listing_prices",
    TWO_GROUPS.format(pairs="SELECT CASE WHEN number_of_reviews > 10 THEN 1 ELSE 0 END AS g, price AS x FROM listing WHERE price IS NOT NULL"),
)
def _(t):
    return _over_star(t, hypotheses.busy_listing_prices, *TWO_GROUP_NAMES)


@query("H4_neighbourhood_prices", complete=SQL["T8_T9_T12_k_groups"])
def _(t):
    return _over_star(t, hypotheses.neighbourhood_prices, "k", "n_total", "f", "eta2", "h", "epsilon2")


@query("H5_weekend_availability", complete=SQL["T13_two_proportions"])
def _(t):
    return _over_star(t, hypotheses.weekend_availability, "n_a", "n_b", "share_a", "share_b", "z", "cohen_h")
