"""Prices, seasons, distances, hosts and demand (A3-A27, W2-W6, G1, G2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from staylens.catalogue.registry import query, rounded
from staylens.config import SUBSCORES
from staylens.operators import geo, market

NEAREST = (
    "(SELECT max(v) FROM (SELECT {v} AS v, row_number() OVER (ORDER BY {v}) - 1 AS i, count(*) OVER () AS n FROM {t} WHERE {v} IS NOT NULL) "
    "WHERE i = CAST(floor((n - 1) * {q}e0 + 0.5e0) AS BIGINT))"
)


def nearest_by(keys: str, v: str, q: float, source: str, name: str) -> str:
    """Closest-rank quantile per group."""
    return (
        f"(SELECT {keys}, max({v}) AS {name} FROM (SELECT {keys}, {v}, row_number() OVER (PARTITION BY {keys} ORDER BY {v}) - 1 AS i, "
        f"count(*) OVER (PARTITION BY {keys}) AS n FROM {source} WHERE {v} IS NOT NULL) "
        f"WHERE i = CAST(floor((n - 1) * {q}e0 + 0.5e0) AS BIGINT) GROUP BY {keys})"
    )


# ---- the seven standing questions ---------------------------------------


@query(
    "A3_price_by_city_room",
    "SELECT city, room_type, CAST(count(*) AS BIGINT) AS listings, round(median(price), 2) AS median_price, round(avg(review_scores_rating), 2) AS avg_rating "
    "FROM listing GROUP BY 1, 2 ORDER BY 1, 3 DESC, 2",
)
def _(t):
    return market.price_by_room(t.listing("city", "room_type", "price", "review_scores_rating"))


@query(
    "A4_top_neighbourhoods",
    """WITH nb AS (SELECT neighbourhood, CAST(count(id) AS BIGINT) AS listings, round_even(median(price), 2) AS median_price FROM listing GROUP BY 1)
    SELECT city, neighbourhood, listings, median_price, round(sum(estimated_revenue_l365d), 2) AS est_total_revenue,
    round(avg(estimated_occupancy_l365d), 1) AS avg_occupied_nights FROM listing JOIN nb USING (neighbourhood)
    WHERE estimated_revenue_l365d IS NOT NULL GROUP BY 1, 2, 3, 4 ORDER BY 5 DESC, 1, 2 LIMIT 10""",
)
def _(t):
    from staylens.operators.enrich import group_profile

    names = ("id", "city", "neighbourhood", "price", "review_scores_rating", "number_of_reviews")
    profile = group_profile(t.listing(*names), ["city", "neighbourhood"]).select(
        "city", "neighbourhood", "nb_listing_count", "nb_median_price"
    )
    facts = t.listing("city", "neighbourhood", "estimated_revenue_l365d", "estimated_occupancy_l365d")
    return market.top_neighbourhoods(facts.join(profile, ["city", "neighbourhood"]))


@query(
    "A5_superhost_premium",
    "SELECT city, host_is_superhost, CAST(count(*) AS BIGINT) AS listings, round(median(price), 2) AS median_price FROM listing GROUP BY 1, 2",
)
def _(t):
    return market.superhost_premium(t.listing("city", "host_is_superhost", "price"))


@query(
    "A6_price_by_family",
    "SELECT property_family, CAST(count(*) AS BIGINT) AS listings, round(quantile_cont(price, 0.25), 2) AS p25, round(median(price), 2) AS p50, "
    "round(quantile_cont(price, 0.75), 2) AS p75 FROM listing GROUP BY 1",
)
def _(t):
    return market.price_by_family(t.listing("property_family", "price"))


@query(
    "A7_tenure_activity",
    "WITH x AS (SELECT *, CASE WHEN round_even(date_diff('day', host_since, DATE '2024-06-15') / 365.25e0, 2) >= 0 THEN round_even(date_diff('day', host_since, DATE '2024-06-15') / 365.25e0, 2) + 0e0 END AS y FROM listing) "
    "SELECT CASE WHEN y < 3 THEN '0-3y' WHEN y < 6 THEN '3-6y' WHEN y < 10 THEN '6-10y' ELSE '10y+' END AS tenure_bucket, CAST(count(*) AS BIGINT) AS listings, "
    "round(avg(number_of_reviews), 1) AS avg_reviews, round(avg(reviews_per_month), 2) AS avg_reviews_pm FROM x WHERE y IS NOT NULL GROUP BY 1",
)
def _(t):
    from staylens.operators.enrich import derived_measures

    return market.tenure_activity(derived_measures(t.listing("host_since", "snapshot_date", "number_of_reviews", "reviews_per_month")))


@query(
    "A8_monthly_availability",
    "SELECT city, year, month, CAST(count(*) AS BIGINT) AS listing_days, round(avg(CASE WHEN available THEN 1e0 ELSE 0e0 END), 3) AS avail_rate FROM cal GROUP BY 1, 2, 3",
)
def _(t):
    return market.monthly_availability(t.calendar("city", "year", "month", "available"))


@query(
    "A9_subscores_by_city",
    "SELECT city, " + ", ".join(f"round(avg(review_scores_{s}), 3) AS {s}" for s in ("cleanliness", "location", "communication", "value")) + " FROM listing GROUP BY 1",
)
def _(t):
    return market.subscores_by_city(t.listing("city", *SUBSCORES))


@query(
    "A9_six_subscores_by_city",
    "SELECT city, " + ", ".join(f"round(avg({s}), 3) AS {s[14:]}" for s in SUBSCORES) + " FROM listing GROUP BY 1",
)
def _(t):
    return market.subscores_by_city(t.listing("city", *SUBSCORES), [s[14:] for s in SUBSCORES])


@query("A9_subscores_overall", " UNION ALL ".join(f"SELECT '{s}' AS variable, round(avg({s}), 4) AS mean FROM listing" for s in SUBSCORES))
def _(t):
    return rounded(market.subscores_overall(t.listing(*SUBSCORES)))


# ---- distributions ------------------------------------------------------

SUMMARY = (
    "price", "bedrooms", "accommodates", "number_of_reviews", "reviews_per_month", "review_scores_rating", *SUBSCORES,
    "availability_365", "minimum_nights", "estimated_occupancy_l365d", "estimated_revenue_l365d", "host_id",
)


def summary_sql(c: str) -> str:
    return (
        f"SELECT '{c}' AS variable, round(avg({c}), 4) AS mean, round(median({c}), 4) AS median, round(stddev_samp({c}), 4) AS std, "
        f"round((SELECT avg(pow({c} - m, 3)) / pow(var_pop({c}), 1.5) FROM listing, (SELECT avg({c}) AS m FROM listing)), 4) AS skew, "
        f"round(CAST({NEAREST.format(v=c, t='listing', q=0.95)} AS DOUBLE), 4) AS p95, CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM listing"
    )


@query("A10_numeric_summary", " UNION ALL ".join(summary_sql(c) for c in SUMMARY))
def _(t):
    return rounded(market.numeric_summary(t.listing(*SUMMARY, "room_type")))


@query(
    "A11_describe",
    "SELECT CAST(count(v) AS BIGINT) AS count, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std, min(v) AS min, max(v) AS max, "
    "round(avg(CASE WHEN v >= 4.5 THEN 1e0 ELSE 0e0 END), 4) AS share_ge_4_5, round(avg(CASE WHEN v >= 4.9 THEN 1e0 ELSE 0e0 END), 4) AS share_ge_4_9, "
    + ", ".join(f"{NEAREST.format(v='review_scores_rating', t='listing', q=q)} AS p{int(q * 100)}" for q in (0.25, 0.5, 0.75))
    + " FROM (SELECT review_scores_rating AS v FROM listing WHERE review_scores_rating IS NOT NULL)",
)
def _(t):
    return rounded(market.describe_column(t.listing("review_scores_rating"), "review_scores_rating"))


@query(
    "A12_availability_by_city",
    "SELECT city, round(avg(availability_365), 4) AS mean_avail, median(availability_365) AS median_avail, round(avg(CASE WHEN availability_365 = 0 THEN 1e0 ELSE 0e0 END), 6) AS pct_zero FROM listing GROUP BY 1",
)
def _(t):
    out = market.availability_by_city(t.listing("city", "availability_365"))
    return rounded(rounded(out.drop("pct_zero")).join(rounded(out.select("city", "pct_zero"), 6), "city"), 6)


SIZES = "(SELECT city, host_id, CAST(count(*) AS BIGINT) AS n FROM listing GROUP BY 1, 2)"
ALL_SIZES = "(SELECT host_id, CAST(count(*) AS BIGINT) AS n FROM listing GROUP BY 1)"


@query("A13_listings_per_host", f"SELECT n AS n_listings, CAST(count(*) AS BIGINT) AS hosts FROM {ALL_SIZES} GROUP BY 1")
def _(t):
    return market.size_frequency(market.host_sizes(t.listing("host_id"), ()))


@query("A13_single_share", f"SELECT round(avg(CASE WHEN n <= 9 THEN 1e0 ELSE 0e0 END), 6) AS single_share FROM {ALL_SIZES}")
def _(t):
    sizes = market.host_sizes(t.listing("host_id"), ()).withColumn("n_listings", F.when(F.col("n_listings") <= 9, 1).otherwise(2))
    return rounded(market.single_share(sizes), 6)


@query("A14_city_centres", "SELECT city, round(median(latitude), 6) AS lat0, round(median(longitude), 6) AS lon0 FROM listing GROUP BY 1")
def _(t):
    return rounded(market.city_centres(t.listing("city", "latitude", "longitude")), 6)


HOSTS = """(SELECT city, host_id, bool_or(host_is_superhost) AS is_superhost, CAST(count(*) AS BIGINT) AS n_listings, median(price) AS median_price,
    sum(estimated_revenue_l365d) AS est_revenue, avg(review_scores_rating) AS avg_rating,
    CASE WHEN count(*) = 1 THEN 'Single (1)' WHEN count(*) <= 3 THEN 'Small (2-3)' WHEN count(*) <= 9 THEN 'Multi (4-9)' ELSE 'Commercial (10+)' END AS segment
    FROM listing GROUP BY 1, 2)"""
HOST_INPUT = ("city", "host_id", "host_is_superhost", "price", "estimated_revenue_l365d", "review_scores_rating")


@query(
    "A15_host_measures",
    f"SELECT city, host_id, is_superhost, n_listings, round(median_price, 4) AS median_price, est_revenue, round(avg_rating, 4) AS avg_rating, segment FROM {HOSTS}",
)
def _(t):
    return rounded(market.host_measures(t.listing(*HOST_INPUT)))


@query(
    "A16_W4_host_segments",
    f"""SELECT city, segment, hosts, listings, revenue, round(median_price, 4) AS median_price, round(hosts / sum(hosts) OVER w * 100, 1) AS host_share,
    round(listings / sum(listings) OVER w * 100, 1) AS listing_share, round(revenue / sum(revenue) OVER w * 100, 1) AS revenue_share
    FROM (SELECT city, segment, CAST(count(*) AS BIGINT) AS hosts, CAST(sum(n_listings) AS BIGINT) AS listings, sum(est_revenue) AS revenue, median(median_price) AS median_price
    FROM {HOSTS} GROUP BY 1, 2) WINDOW w AS (PARTITION BY city)""",
)
def _(t):
    return rounded(market.host_segments(market.host_measures(t.listing(*HOST_INPUT))))


TYPED = """(SELECT l.*, CASE WHEN n = 1 THEN 'Casual' ELSE 'Professional' END AS host_type FROM listing l
    JOIN (SELECT host_id, count(*) AS n FROM listing GROUP BY 1) s ON l.host_id IS NOT DISTINCT FROM s.host_id WHERE price IS NOT NULL)"""


@query("J9_host_size_join", f"SELECT id, n_listings, host_type FROM (SELECT l.id, CAST(n AS BIGINT) AS n_listings, CASE WHEN n = 1 THEN 'Casual' ELSE 'Professional' END AS host_type FROM listing l JOIN (SELECT host_id, count(*) AS n FROM listing GROUP BY 1) s ON l.host_id IS NOT DISTINCT FROM s.host_id WHERE price IS NOT NULL)")
def _(t):
    return market.host_type_frame(t.listing("id", "host_id", "price")).select("id", "n_listings", "host_type")


@query(
    "A17_host_type_prices",
    f"SELECT city, host_type, room_type, CAST(count(*) AS BIGINT) AS listings, round(median(price), 4) AS median_price, round(median(price_per_bedroom), 4) AS median_ppb "
    f"FROM (SELECT *, price / 2 AS price_per_bedroom FROM {TYPED}) GROUP BY 1, 2, 3",
)
def _(t):
    priced = t.listing("city", "host_id", "room_type", "price").withColumn("price_per_bedroom", F.col("price") / 2)
    return rounded(market.host_type_prices(market.host_type_frame(priced)))


@query(
    "A18_dispersion",
    f"""WITH x AS {TYPED}, a AS {nearest_by('city, host_type', 'whole', 0.25, '(SELECT *, floor(price) AS whole FROM x)', 'q1')},
    b AS {nearest_by('city, host_type', 'whole', 0.75, '(SELECT *, floor(price) AS whole FROM x)', 'q3')}
    SELECT city, host_type, round(stddev_samp(floor(price)) / avg(floor(price)), 3) AS cv, max(q3 - q1) AS iqr, round(avg(CASE WHEN floor(price) % 10 = 0 THEN 1e0 ELSE 0e0 END), 3) AS round_pricing
    FROM x JOIN a USING (city, host_type) JOIN b USING (city, host_type) GROUP BY 1, 2""",
)
def _(t):
    whole = F.floor(F.col("price")).cast("double")
    return rounded(market.dispersion(market.host_type_frame(t.listing("city", "host_id", "price").withColumn("price", whole))))


@query(
    "A19_outcomes",
    f"SELECT city, host_type, round(median(price), 4) AS median_price, median(estimated_occupancy_l365d) AS median_occ, median(estimated_revenue_l365d) AS median_rev, median(minimum_nights) AS median_minnights FROM {TYPED} GROUP BY 1, 2",
)
def _(t):
    frame = t.listing("city", "host_id", "price", "estimated_occupancy_l365d", "estimated_revenue_l365d", "minimum_nights")
    return rounded(market.outcomes(market.host_type_frame(frame)))


# ---- seasons ------------------------------------------------------------


@query(
    "A20_J5_seasonal_price",
    "SELECT l.city, c.year, c.month, round(avg(l.price), 4) AS avg_price, concat(CAST(c.year AS STRING), '-', lpad(CAST(c.month AS STRING), 2, '0')) AS period "
    "FROM cal c JOIN listing l ON c.listing_id = l.id GROUP BY l.city, c.year, c.month",
)
def _(t):
    listings = t.listing("id", "city", "price").withColumnRenamed("id", "listing_id")
    return rounded(market.seasonal_price(t.calendar("listing_id", "year", "month"), listings))


@query(
    "A21_W3_review_volume",
    """SELECT city, year, month, reviews, make_date(year, month, 1) AS month_start,
    CASE WHEN count(*) OVER w = 12 THEN round(avg(reviews) OVER w, 4) END AS roll12
    FROM (SELECT city, year, month, CAST(count(*) AS BIGINT) AS reviews FROM cal GROUP BY 1, 2, 3)
    WINDOW w AS (PARTITION BY city ORDER BY year, month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)""",
)
def _(t):
    return rounded(market.review_volume(t.calendar("city", "year", "month")))


@query(
    "A22_minimum_nights_by_month",
    "SELECT city, year, month, make_date(year, month, 1) AS month_start, median(minimum_nights) AS median_min_nights, round(avg(minimum_nights), 4) AS mean_min_nights, "
    "round(avg(CASE WHEN minimum_nights >= 7 THEN 1e0 ELSE 0e0 END), 4) AS share_weekly_plus, CAST(count(*) AS BIGINT) AS listing_days FROM cal GROUP BY 1, 2, 3",
)
def _(t):
    return rounded(market.minimum_nights_by_month(t.calendar("city", "year", "month", "minimum_nights")))


# ---- distance -----------------------------------------------------------


def _geo(t, *names):
    wanted = dict.fromkeys(("city", "latitude", "longitude", *names))
    return market.distance_to_centre(
        t.listing(*wanted), centres=market.city_centres(t.listing("city", "latitude", "longitude"))
    )


@query("G1_J7_distance_to_centre", "SELECT id, round(dist_km, 6) AS dist_km FROM geo")
def _(t):
    return rounded(_geo(t, "id").select("id", "dist_km"), 6)


@query(
    "A23_price_gradient",
    "SELECT city, floor(dist_km) * 1e0 AS band, round(median(price), 4) AS median_price, CAST(count(*) AS BIGINT) AS n FROM geo WHERE price IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 5",
)
def _(t):
    return rounded(market.price_gradient(_geo(t, "price")))


@query(
    "A23_W2_price_index",
    "SELECT city, floor(dist_km / 2) * 2e0 AS band, round(median(price_idx), 4) AS price_idx FROM "
    "(SELECT *, price / median(price) OVER (PARTITION BY city) AS price_idx FROM geo WHERE price IS NOT NULL) WHERE floor(dist_km / 2) * 2 <= 20 GROUP BY 1, 2",
)
def _(t):
    return rounded(market.price_index(_geo(t, "price")))


@query(
    "T1_T3_price_trend",
    "SELECT city, round(corr(dist_km, ln(1 + price)), 6) AS corr_log_price, round(regr_slope(price, dist_km), 6) AS price_per_km FROM geo WHERE price IS NOT NULL GROUP BY 1",
)
def _(t):
    return rounded(market.price_trend(_geo(t, "price")), 6)


@query(
    "A24_neighbourhood_ratings",
    """SELECT city, neighbourhood, round(rating, 4) AS rating, n, round(lat, 4) AS lat, round(lon, 4) AS lon,
    round((rating - min(rating) OVER (PARTITION BY city)) / (max(rating) OVER (PARTITION BY city) - min(rating) OVER (PARTITION BY city) + 1e-9), 4) AS shade
    FROM (SELECT city, neighbourhood, median(latitude) AS lat, median(longitude) AS lon, avg(review_scores_rating) AS rating, CAST(count(*) AS BIGINT) AS n
      FROM geo WHERE review_scores_rating IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 20)""",
)
def _(t):
    return rounded(market.neighbourhood_ratings(_geo(t, "neighbourhood", "review_scores_rating")))


# ---- demand -------------------------------------------------------------


@query(
    "A25_demand_by_room",
    "SELECT city, room_type, CAST(count(*) AS BIGINT) AS n, round(median(reviews_per_month), 4) AS median_rpm, round(median(price), 4) AS median_price FROM listing WHERE reviews_per_month IS NOT NULL GROUP BY 1, 2",
)
def _(t):
    return rounded(market.demand_by_room(t.listing("city", "room_type", "reviews_per_month", "price")))


@query(
    "A25_demand_curve",
    f"SELECT city, floor(price / 5000) * 5000e0 AS price_band, CAST(count(*) AS BIGINT) AS n, round(median(reviews_per_month), 4) AS median_rpm FROM listing "
    f"WHERE reviews_per_month IS NOT NULL AND price < {NEAREST.format(v='price', t='listing', q=0.99)} GROUP BY 1, 2 HAVING count(*) >= 10",
)
def _(t):
    return rounded(market.demand_curve(t.listing("city", "price", "reviews_per_month"), width=5000.0))


FLAGS = {"share_low_demand": "l", "low_but_blocked": "l AND b", "low_but_longstay": "l AND s"}


@query(
    "A26_demand_flags",
    "SELECT city, " + ", ".join(f"round(avg(CASE WHEN {c} THEN 1e0 WHEN NOT ({c}) THEN 0e0 END), 3) AS {n}" for n, c in FLAGS.items())
    + " FROM (SELECT city, reviews_per_month < 0.2e0 AS l, availability_365 < 30 AS b, nullif(minimum_nights, 3) >= 7 AS s FROM listing WHERE reviews_per_month IS NOT NULL) GROUP BY 1",
)
def _(t):
    listing = t.listing("city", "reviews_per_month", "availability_365", "minimum_nights")
    return market.demand_flags(listing.withColumn("minimum_nights", F.nullif("minimum_nights", F.lit(3.0))))


# ---- chart data ---------------------------------------------------------


@query(
    "A27_box_summary",
    """SELECT city, room_type, round(q1, 4) AS q1, round(m, 4) AS median, round(q3, 4) AS q3, CAST(count(*) AS BIGINT) AS n,
    round(min(price) FILTER (price >= q1 - 1.5e0 * (q3 - q1)), 4) AS whisker_low, round(max(price) FILTER (price <= q3 + 1.5e0 * (q3 - q1)), 4) AS whisker_high
    FROM listing JOIN (SELECT city, room_type, quantile_cont(price, 0.25) AS q1, median(price) AS m, quantile_cont(price, 0.75) AS q3 FROM listing GROUP BY 1, 2) USING (city, room_type)
    WHERE price IS NOT NULL GROUP BY 1, 2, 3, 4, 5""",
)
def _(t):
    return rounded(market.box_summary(t.listing("city", "room_type", "price"), ["city", "room_type"], "price"))


@query(
    "A27_histogram",
    """WITH e AS (SELECT min(review_scores_rating) AS lo, max(review_scores_rating) AS hi FROM listing)
    SELECT bin, round(lo + bin * ((hi - lo) / 40), 4) AS bin_start, round(lo + (bin + 1) * ((hi - lo) / 40), 4) AS bin_end, CAST(count(*) AS BIGINT) AS n
    FROM (SELECT lo, hi, CAST(least(floor((review_scores_rating - lo) / ((hi - lo) / 40)), 39) AS BIGINT) AS bin FROM listing, e WHERE review_scores_rating IS NOT NULL)
    GROUP BY bin, lo, hi""",
)
def _(t):
    return rounded(market.histogram(t.listing("review_scores_rating"), "review_scores_rating"))


@query(
    "A27_density_cells",
    "SELECT city, room_type, floor(latitude / 0.05e0) * 0.05e0 AS lat, floor(longitude / 0.05e0) * 0.05e0 AS lon, CAST(count(*) AS BIGINT) AS n FROM listing "
    "WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2, 3, 4",
)
def _(t):
    return market.density_cells(t.listing("city", "room_type", "latitude", "longitude"), 0.05, ("city", "room_type"))


@query(
    "A28_availability_by_daytype",
    "SELECT CASE WHEN isodow(date) IN (6, 7) THEN 'weekend' ELSE 'weekday' END AS daytype, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (available) AS BIGINT) AS free, "
    "round(avg(CASE WHEN available THEN 1e0 ELSE 0e0 END), 6) AS share_free FROM cal WHERE available IS NOT NULL GROUP BY 1",
)
def _(t):
    return rounded(market.availability_by_daytype(t.calendar("date", "available")), 6)


# ---- concentration ------------------------------------------------------

TOP = """SELECT {city} {q}e0 AS top, k, round(sum(n) FILTER (r <= k) / sum(n), 6) AS share
    FROM (SELECT *, {k} AS k FROM (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY n DESC) AS r, count(*) OVER (PARTITION BY {part}) AS h FROM {sizes})) GROUP BY {city} k"""


@query(
    "W5_top_share_overall",
    TOP.format(city="", q=0.01, part="1", k="greatest(1, CAST(floor(h * 0.01e0) AS BIGINT))", sizes=ALL_SIZES),
)
def _(t):
    return rounded(market.top_share(market.host_sizes(t.listing("host_id"), ()), (), [0.01]), 6)


@query(
    "W5_top_share_by_city",
    " UNION ALL ".join(
        TOP.format(city="city,", q=q, part="city", k=f"greatest(1, CAST(floor(h * {q}e0) AS BIGINT))", sizes=SIZES) for q in (0.01, 0.05, 0.1)
    ),
)
def _(t):
    return rounded(market.top_share(market.host_sizes(t.listing("city", "host_id")), ["city"], [0.01, 0.05, 0.1]), 6)


@query(
    "W5_top_share_plus_one",
    TOP.format(city="city,", q=0.01, part="city", k="CAST(h // 100 + 1 AS BIGINT)", sizes=SIZES),
)
def _(t):
    return rounded(market.top_share(market.host_sizes(t.listing("city", "host_id")), ["city"], [0.01], plus_one=True), 6)


@query(
    "W6_hosts_of_half",
    f"""SELECT city, CAST(min(r) FILTER (2 * c >= total) AS BIGINT) AS hosts_needed, CAST(count(*) AS BIGINT) AS n_hosts, round(min(r) FILTER (2 * c >= total) / count(*), 6) AS host_share
    FROM (SELECT city, row_number() OVER w AS r, sum(n) OVER w AS c, sum(n) OVER (PARTITION BY city) AS total FROM {SIZES}
      WINDOW w AS (PARTITION BY city ORDER BY n DESC, host_id ROWS UNBOUNDED PRECEDING)) GROUP BY 1""",
)
def _(t):
    return rounded(market.holders_of(market.host_sizes(t.listing("city", "host_id")), ["city"]), 6)


# ---- clusters -----------------------------------------------------------


def _dense(t):
    """Orders of each customer nation on a city map with a few crowded quarters."""
    key = F.col("o_orderkey")
    quarter = F.when(key % 3 == 0, 0).when(key % 3 == 1, key % 7).otherwise(key % 61)
    return t.table("orders").select(
        key.alias("id"), F.col("o_orderpriority").alias("room_type"),
        (F.lit(-37.8) + quarter * 0.01 + (key * 7919 % 997) / 250000).alias("latitude"),
        (F.lit(144.9) + quarter * 0.013 + (key * 104729 % 991) / 200000).alias("longitude"),
    )


# the plain way: all pairs of places of a group, and the smallest member spread over links
CLUSTERS = """
WITH RECURSIVE placed AS (
    SELECT o_orderpriority AS room_type, -37.8e0 + q * 0.01e0 + (k * 7919 % 997) / 250000e0 AS lat,
           144.9e0 + q * 0.013e0 + (k * 104729 % 991) / 200000e0 AS lon
    FROM (SELECT *, o_orderkey AS k, CASE o_orderkey % 3 WHEN 0 THEN 0 WHEN 1 THEN o_orderkey % 7 ELSE o_orderkey % 61 END AS q FROM orders)
),
points AS MATERIALIZED (
    SELECT *, row_number() OVER (ORDER BY room_type, lat, lon) AS id
    FROM (SELECT room_type, lat, lon, count(*) AS w FROM placed GROUP BY ALL)
),
near AS MATERIALIZED (
    SELECT a.id AS a, b.id AS b, b.w FROM points a JOIN points b
    ON a.room_type = b.room_type AND b.lat BETWEEN a.lat - 0.0028 AND a.lat + 0.0028
    WHERE 12742 * asin(sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2)
          + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))) <= 0.3
),
core AS MATERIALIZED (SELECT a AS id FROM near GROUP BY 1 HAVING sum(w) >= 30),
links AS MATERIALIZED (SELECT a, b FROM near WHERE a IN (FROM core) AND b IN (FROM core) AND a <> b),
labels(id, label) USING KEY (id) AS (
    SELECT id, id FROM core
    UNION
    SELECT l.a, min(n.label) FROM labels n JOIN links l ON n.id = l.b JOIN recurring.labels o ON o.id = l.a
    WHERE n.label < o.label GROUP BY 1
),
"""
# clusters are numbered by their first grid cell
CELLS = """
rows AS (SELECT *, floor(lat / h) AS gy FROM points, (SELECT 0.3e0 / sqrt(2e0) / radians(1e0) / 6371e0 * (1 - 1e-6) AS h)),
cells AS (
    SELECT id, room_type, gy, floor(lon / (h / greatest(cos(radians(least((CASE WHEN gy >= 0 THEN gy ELSE -gy - 1 END) * h, 89.9e0))), 1e-3))) AS gx
    FROM rows
),
numbers AS (
    SELECT label, CAST(row_number() OVER (ORDER BY first) - 1 AS BIGINT) AS cluster
    FROM (SELECT label, min((room_type, gy, gx)) AS first FROM labels JOIN cells USING (id) GROUP BY 1)
),
touched AS (SELECT a AS id, min(cluster) AS cluster FROM near JOIN labels ON b = labels.id JOIN numbers USING (label) GROUP BY 1),
own AS (SELECT id, cluster FROM labels JOIN numbers USING (label))
"""


@query(
    "G2_density_clusters",
    f"""{CLUSTERS}{CELLS}
    SELECT room_type, round(lat, 6) AS lat, round(lon, 6) AS lon, w, own.id IS NOT NULL AS core,
           coalesce(own.cluster, touched.cluster, -1) AS cluster
    FROM points LEFT JOIN own USING (id) LEFT JOIN touched USING (id)
    """,
)
def _(t):
    return rounded(geo.dbscan(_dense(t), by=["room_type"]), 6)


@query(
    "G2_cluster_count",
    f"""{CLUSTERS}
    held AS (SELECT a AS id, bool_or(b IN (FROM core)) AS inside FROM near GROUP BY 1),
    counted AS (SELECT room_type, count(DISTINCT label) AS clusters FROM labels JOIN points USING (id) GROUP BY 1)
    SELECT room_type, coalesce(any_value(clusters), 0) AS clusters, CAST(coalesce(sum(w) FILTER (inside), 0) AS BIGINT) AS clustered,
           CAST(coalesce(sum(w) FILTER (NOT inside), 0) AS BIGINT) AS noise
    FROM points JOIN held USING (id) LEFT JOIN counted USING (room_type) GROUP BY room_type
    """,
)
def _(t):
    return geo.cluster_count(geo.dbscan(_dense(t), by=["room_type"]), ["room_type"])
