"""Joins, unions, first rows, enrichment and the star schema (J, U, W1, L, A1-A2, K, S)."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import cache

from pyspark.sql import functions as F

from staylens.catalogue.registry import query, rounded
from staylens.config import SUBSCORES, City
from staylens.operators import enrich, features, market, order, quality, warehouse
from staylens.plans import answers
from staylens.session import checkpoint
from staylens.sources import files, tables


@query(
    "A1_review_summary",
    "SELECT listing_id, CAST(count(date) AS BIGINT) AS rev_count, min(date) AS rev_first, max(date) AS rev_last, "
    "CAST(max(date) - min(date) AS INTEGER) AS rev_span_days FROM review WHERE listing_id IS NOT NULL GROUP BY 1",
)
def _(t):
    return enrich.review_summary(t.reviews("listing_id", "date"))


PROFILE = """SELECT city_key, neighbourhood_std, CAST(count(id) AS BIGINT) AS nb_listing_count, round_even(median(price), 2) AS nb_median_price,
    round_even(avg(review_scores_rating), 3) AS nb_avg_rating, round(avg(number_of_reviews), 4) AS nb_avg_reviews,
    round_even(count(id) / sum(count(id)) OVER (PARTITION BY city_key) * 100, 2) AS nb_density_pct FROM listing GROUP BY 1, 2"""
PROFILE_INPUT = ("id", "city_key", "neighbourhood_std", "price", "review_scores_rating", "number_of_reviews")


@query("A2_neighbourhood_profile", PROFILE)
def _(t):
    return rounded(enrich.group_profile(t.listing(*PROFILE_INPUT)))


@query(
    "J1_review_summary_join",
    "WITH s AS (SELECT listing_id, CAST(count(date) AS BIGINT) AS rev_count, CAST(max(date) - min(date) AS INTEGER) AS rev_span_days FROM review WHERE listing_id IS NOT NULL GROUP BY 1) "
    "SELECT id, price, rev_count, rev_span_days FROM listing LEFT JOIN s ON id = listing_id",
)
def _(t):
    return enrich.with_reviews(t.listing("id", "price"), t.reviews("listing_id", "date")).drop("rev_first", "rev_last")


@query(
    "J2_neighbourhood_join",
    f"WITH nb AS ({PROFILE}) SELECT id, nb_listing_count, nb_median_price, nb_density_pct FROM listing LEFT JOIN nb USING (city_key, neighbourhood_std)",
)
def _(t):
    joined = enrich.with_neighbourhoods(t.listing(*PROFILE_INPUT))
    return joined.select("id", "nb_listing_count", "nb_median_price", "nb_density_pct")


@query(
    "J3_null_matching_lookup",
    "WITH d AS (SELECT room_type, row_number() OVER (ORDER BY room_type NULLS FIRST) AS room_type_sk FROM (SELECT DISTINCT room_type FROM raw)) "
    "SELECT id, raw.room_type, room_type_sk FROM raw LEFT JOIN d ON raw.room_type IS NOT DISTINCT FROM d.room_type",
)
def _(t):
    raw = t.raw("id", "room_type")
    dim = warehouse.value_table(raw, ["room_type"], "room_type_sk")
    return warehouse.lookup(raw, dim, "room_type_sk", {"room_type": "room_type"})


@query("J4_star_join", "SELECT city, neighbourhood, CAST(count(*) AS BIGINT) AS listings, round(avg(price), 4) AS avg_price FROM listing GROUP BY 1, 2")
def _(t):
    found = t.listing("city", "neighbourhood", "price").groupBy("city", "neighbourhood")
    return rounded(found.agg(market.rows("listings"), F.avg("price").alias("avg_price")))


@query(
    "J8_missing_parents",
    "SELECT DISTINCT l_orderkey AS value FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')",
)
def _(t):
    return quality.missing_parents(t.table("lineitem"), "l_orderkey", t.table("orders").where("o_orderstatus <> 'P'"), "o_orderkey")


@query(
    "U4_value_subset",
    "SELECT CAST(count(DISTINCT c_nationkey) FILTER (c_nationkey NOT IN (SELECT s_nationkey FROM supplier)) AS BIGINT) AS outside FROM customer",
)
def _(t):
    outside = quality.missing_parents(t.table("customer"), "c_nationkey", t.table("supplier"), "s_nationkey")
    return outside.agg(F.count(F.lit(1)).alias("outside"))


@query("W1_first_per_key", "SELECT host_id, id, price FROM (SELECT *, row_number() OVER (PARTITION BY host_id ORDER BY id) AS nth FROM listing) WHERE nth = 1")
def _(t):
    return order.keep_first(t.listing("host_id", "id", "price"), ["host_id"], ["id"])


@query("L3_first_rows", "SELECT room_type, id, nth FROM (SELECT room_type, id, CAST(row_number() OVER (PARTITION BY room_type ORDER BY id) AS INTEGER) AS nth FROM listing) WHERE nth <= 5")
def _(t):
    return order.first_k(t.listing("room_type", "id"), ["room_type"], "id", 5).withColumnRenamed("_nth", "nth")


@query("L1_mixed_sort", "SELECT city, room_type, CAST(count(*) AS BIGINT) AS n FROM listing GROUP BY 1, 2 ORDER BY city, n DESC, room_type")
def _(t):
    found = t.listing("city", "room_type").groupBy("city", "room_type").agg(market.rows("n"))
    return found.orderBy("city", F.desc("n"), "room_type")


@query("L2_top_k", "SELECT id, price FROM listing ORDER BY price DESC NULLS LAST, id LIMIT 25")
def _(t):
    return t.listing("id", "price").orderBy(F.desc_nulls_last("price"), "id").limit(25)


@query(
    "L4_sort_by_size_and_category",
    "SELECT segment, n FROM (SELECT CASE WHEN accommodates = 1 THEN 'Single (1)' WHEN accommodates <= 3 THEN 'Small (2-3)' ELSE 'Multi (4-9)' END AS segment, "
    "CAST(count(*) AS BIGINT) AS n FROM listing GROUP BY 1) ORDER BY CASE segment WHEN 'Single (1)' THEN 1 WHEN 'Small (2-3)' THEN 2 ELSE 3 END",
)
def _(t):
    from staylens.functions.numbers import host_segment

    found = t.listing("accommodates").groupBy(host_segment(F.col("accommodates")).alias("segment")).agg(market.rows("n"))
    place = F.array_position(F.array(*[F.lit(s) for s in ("Single (1)", "Small (2-3)", "Multi (4-9)")]), F.col("segment"))
    return found.orderBy(place)


@query("U1_union", "SELECT n_name AS name FROM nation UNION ALL SELECT r_name FROM region")
def _(t):
    return quality.stack([t.table("nation").select(F.col("n_name").alias("name")), t.table("region").select(F.col("r_name").alias("name"))])


@query(
    "U2_union_missing_columns",
    "SELECT c_acctbal AS balance, c_custkey AS key, c_mktsegment AS segment FROM customer UNION ALL SELECT s_acctbal, s_suppkey, NULL FROM supplier",
)
def _(t):
    customers = t.table("customer").select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    suppliers = t.table("supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key"))
    return enrich.unify([customers, suppliers])


DATES = """SELECT DISTINCT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, d AS date, CAST(year(d) AS INTEGER) AS year,
    CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day
    FROM (SELECT date AS d FROM cal UNION SELECT date FROM review UNION SELECT CAST(snapshot_date AS DATE) FROM listing) WHERE d IS NOT NULL"""


@query("U3_K5_date_dimension", DATES)
def _(t):
    return warehouse.date_table([(t.listing("snapshot_date"), "snapshot_date"), (t.calendar("date"), "date"), (t.reviews("date"), "date")])


@query(
    "U5_wide_long_wide",
    "SELECT room_type, round(avg(price), 4) AS price, round(avg(minimum_nights), 4) AS minimum_nights FROM listing GROUP BY 1",
)
def _(t):
    long = order.unpivot(t.listing("room_type", "price", "minimum_nights"), ["room_type"], ["price", "minimum_nights"])
    return rounded(long.groupBy("room_type").pivot("variable", ["price", "minimum_nights"]).agg(F.avg("value")))


# ---- star ---------------------------------------------------------------


def _cities():
    names = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "ATLANTIS")
    return [City(n.lower(), n, f"land-of-{n.lower().replace(' ', '-')}/old-{n.lower().replace(' ', '-')}/{n.lower()}", "2024-06-15") for n in names]


MASTER = (
    "_row_id", "id", "city_key", "snapshot_date", "host_id", "host_name", "host_since", "host_is_superhost",
    "host_identity_verified", "neighbourhood_std", "property_type_clean", "property_family", "room_type", "price",
    "accommodates", "minimum_nights", "number_of_reviews", "reviews_per_month", "review_scores_rating",
    "availability_365", "estimated_occupancy_l365d", "estimated_revenue_l365d",
)
TITLE = "array_to_string(list_transform(string_split({c}, ' '), lambda w : concat(upper(w[1]), w[2:])), ' ')"


@query(
    "K1_city_dimension",
    f"SELECT DISTINCT city_key, city AS display_name, {TITLE.format(c='concat(' + repr('land of ') + ', city_key)')} AS country, "
    f"{TITLE.format(c='concat(' + repr('old ') + ', city_key)')} AS region FROM listing",
)
def _(t):
    return warehouse.city_table(t.listing("city_key"), _cities())


@query(
    "K1_K2_host_dimension",
    """SELECT row_number() OVER (ORDER BY host_id NULLS FIRST) AS host_sk, host_id, host_name, host_since, host_is_superhost, host_identity_verified,
    CAST(NULL AS INTEGER) AS host_listings_count, CAST(NULL AS DOUBLE) AS host_tenure_years
    FROM (SELECT *, row_number() OVER (PARTITION BY host_id ORDER BY id) AS nth FROM listing) WHERE nth = 1""",
)
def _(t):
    hosts = t.listing("_row_id", "city_key", "host_id", "host_name", "host_since", "host_is_superhost", "host_identity_verified")
    return warehouse.in_schema(warehouse.host_table(hosts), "dim_host")


@query(
    "K1_K2_neighbourhood_dimension",
    f"SELECT row_number() OVER (ORDER BY city_key, neighbourhood_std) AS neighbourhood_sk, city_key, neighbourhood_std AS neighbourhood, "
    f"CAST(nb_listing_count AS INTEGER) AS nb_listing_count, nb_median_price, nb_avg_rating, nb_density_pct FROM ({PROFILE})",
)
def _(t):
    joined = enrich.with_neighbourhoods(t.listing("_row_id", *PROFILE_INPUT))
    return warehouse.in_schema(warehouse.neighbourhood_table(joined), "dim_neighbourhood")


@query(
    "K1_K2_property_dimension",
    "SELECT row_number() OVER (ORDER BY property_type_clean, property_family) AS property_sk, property_type_clean, property_family "
    "FROM (SELECT DISTINCT property_type_clean, property_family FROM listing)",
)
def _(t):
    return warehouse.value_table(t.listing("property_type_clean", "property_family"), ["property_type_clean", "property_family"], "property_sk")


@query(
    "K3_primary_key_check",
    "SELECT 'calendar' AS \"table\", 'listing_id+date' AS key, CAST(count(*) FILTER (l_linenumber = 7) AS BIGINT) AS null_keys, "
    "CAST(count(*) FILTER (l_linenumber <> 7) - count(DISTINCT (l_orderkey, l_shipdate)) FILTER (l_linenumber <> 7) AS BIGINT) AS repeated_keys FROM lineitem",
)
def _(t):
    key = F.when(F.col("l_linenumber") != 7, F.col("l_orderkey"))
    days = t.table("lineitem").select(key.alias("listing_id"), F.col("l_shipdate").alias("date"))
    return warehouse.primary_key_violations(days, "calendar", ["listing_id", "date"])


@query(
    "K4_foreign_key_check",
    "SELECT 'events' AS \"table\", 'user_id' AS \"column\", 'customer' AS references_table, CAST(count(DISTINCT user_id) AS BIGINT) AS orphans "
    "FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')",
)
def _(t):
    parents = t.table("customer").where("c_mktsegment <> 'BUILDING'")
    return warehouse.foreign_key_violations(t.table("events"), "events", "user_id", parents, "customer", "c_custkey")


FACT = """WITH h AS (SELECT host_id, row_number() OVER (ORDER BY host_id NULLS FIRST) AS host_sk FROM (SELECT DISTINCT host_id FROM listing)),
    nb AS (SELECT city_key, neighbourhood_std, row_number() OVER (ORDER BY city_key, neighbourhood_std) AS neighbourhood_sk FROM (SELECT DISTINCT city_key, neighbourhood_std FROM listing)),
    p AS (SELECT *, row_number() OVER (ORDER BY property_type_clean, property_family) AS property_sk FROM (SELECT DISTINCT property_type_clean, property_family FROM listing)),
    r AS (SELECT room_type, row_number() OVER (ORDER BY room_type) AS room_type_sk FROM (SELECT DISTINCT room_type FROM listing))
    SELECT id AS listing_id, 20240615 AS snapshot_date_key, listing.city_key, host_sk, neighbourhood_sk, property_sk, room_type_sk, price,
    CAST(NULL AS DOUBLE) AS price_per_bedroom, CAST(accommodates AS INTEGER) AS accommodates, CAST(minimum_nights AS INTEGER) AS minimum_nights,
    CAST(number_of_reviews AS INTEGER) AS number_of_reviews, reviews_per_month, review_scores_rating, CAST(availability_365 AS INTEGER) AS availability_365,
    CAST(estimated_occupancy_l365d AS INTEGER) AS estimated_occupancy_l365d, estimated_revenue_l365d, CAST(NULL AS DOUBLE) AS review_frequency_pm,
    CAST(NULL AS DOUBLE) AS review_scores_accuracy, CAST(NULL AS DOUBLE) AS review_scores_cleanliness, CAST(NULL AS DOUBLE) AS review_scores_checkin,
    CAST(NULL AS DOUBLE) AS review_scores_communication, CAST(NULL AS DOUBLE) AS review_scores_location, CAST(NULL AS DOUBLE) AS review_scores_value
    FROM listing JOIN h ON h.host_id IS NOT DISTINCT FROM listing.host_id JOIN nb ON nb.city_key = listing.city_key AND nb.neighbourhood_std = listing.neighbourhood_std
    JOIN p ON p.property_type_clean = listing.property_type_clean AND p.property_family = listing.property_family JOIN r USING (room_type)"""


def _dims(master):
    nothing = [F.lit(None).cast("double").alias(c) for c in ("nb_listing_count", "nb_median_price", "nb_avg_rating", "nb_density_pct")]
    placed = master.select("*", *nothing)
    return {
        "dim_host": warehouse.in_schema(warehouse.host_table(master), "dim_host"),
        "dim_neighbourhood": warehouse.in_schema(warehouse.neighbourhood_table(placed), "dim_neighbourhood"),
        "dim_property": warehouse.value_table(master, ["property_type_clean", "property_family"], "property_sk"),
        "dim_room_type": warehouse.value_table(master, ["room_type"], "room_type_sk"),
    }


@query("K6_listing_facts", FACT)
def _(t):
    master = t.listing(*MASTER)
    return warehouse.listing_facts(master, _dims(master))


class Stored(Mapping):
    """Tables that are built and stored, as the answers read tables, when one is first asked for;
    those in `plans`, which an answer reads once and in few columns, stay plans."""

    def __init__(self, makers, plans=()):
        self._makers, self._plans, self._tables = makers, plans, {}

    def __getitem__(self, name):
        if name not in self._tables:
            made = self._makers[name]()
            self._tables[name] = made if name in self._plans else checkpoint(made)
        return self._tables[name]

    def __iter__(self):
        return iter(self._makers)

    def __len__(self):
        return len(self._makers)


def _star(t):
    """Facts and dimensions as the warehouse holds them; an answer waits for its own only."""
    from staylens.operators.enrich import derived_measures

    @cache
    def master():
        return enrich.with_neighbourhoods(derived_measures(t.listing(*MASTER, *SUBSCORES)))

    @cache
    def dims():
        return _dims(master().drop(*[c for c in master().columns if c.startswith("nb_")]))

    calendar = t.calendar("listing_id", "date", "city_key", "available", "minimum_nights")
    star = Stored({
        **{name: lambda name=name: dims()[name] for name in ("dim_host", "dim_property", "dim_room_type")},
        "dim_city": lambda: warehouse.city_table(t.listing("city_key"), _cities()),
        "dim_neighbourhood": lambda: warehouse.in_schema(warehouse.neighbourhood_table(master()), "dim_neighbourhood"),
        "dim_date": lambda: warehouse.date_table([(calendar, "date")]),
        "fact_listing": lambda: warehouse.listing_facts(master(), star),
        "fact_calendar": lambda: warehouse.calendar_facts(calendar),
    }, plans=("dim_date", "fact_calendar"))
    return star


@query(
    "K12_price_by_city_room_over_star",
    "SELECT city, room_type, CAST(count(*) AS BIGINT) AS listings, round(median(price), 2) AS median_price, round(avg(review_scores_rating), 2) AS avg_rating FROM listing GROUP BY 1, 2",
)
def _(t):
    return answers.QUESTIONS["price_by_city_and_room"](_star(t))


@query(
    "K12_superhost_premium_over_star",
    "WITH h AS (SELECT host_id, arg_min(host_is_superhost, id) AS host_is_superhost FROM listing GROUP BY 1) "
    "SELECT city, h.host_is_superhost, CAST(count(*) AS BIGINT) AS listings, round(median(price), 2) AS median_price "
    "FROM listing l JOIN h ON h.host_id IS NOT DISTINCT FROM l.host_id GROUP BY 1, 2",
)
def _(t):
    return answers.QUESTIONS["superhost_premium"](_star(t))


TENURE = "round_even(date_diff('day', host_since, DATE '2024-06-15') / 365.25e0, 2)"
PER_HOST = "(SELECT host_id, arg_min(host_since, id) AS host_since FROM listing GROUP BY 1)"


@query(
    "K12_top_neighbourhoods_over_star",
    """WITH nb AS (SELECT city, neighbourhood, CAST(count(id) AS INTEGER) AS listings, round_even(median(price), 2) AS median_price FROM listing GROUP BY 1, 2)
    SELECT city, neighbourhood, listings, median_price, round(sum(estimated_revenue_l365d), 2) AS est_total_revenue,
    round(avg(CAST(estimated_occupancy_l365d AS INTEGER)), 1) AS avg_occupied_nights FROM listing JOIN nb USING (city, neighbourhood)
    WHERE estimated_revenue_l365d IS NOT NULL GROUP BY 1, 2, 3, 4 ORDER BY 5 DESC, 1, 2 LIMIT 10""",
)
def _(t):
    return answers.QUESTIONS["top_neighbourhoods_by_revenue"](_star(t))


@query(
    "K12_price_by_family_over_star",
    "SELECT property_family, CAST(count(*) AS BIGINT) AS listings, round(quantile_cont(price, 0.25), 2) AS p25, round(median(price), 2) AS p50, "
    "round(quantile_cont(price, 0.75), 2) AS p75 FROM listing GROUP BY 1",
)
def _(t):
    return answers.QUESTIONS["price_by_property_family"](_star(t))


@query(
    "K12_tenure_and_reviews_over_star",
    f"WITH h AS (SELECT host_id, CASE WHEN {TENURE} >= 0 THEN {TENURE} + 0e0 END AS y FROM {PER_HOST}), "
    "x AS (SELECT y, number_of_reviews, reviews_per_month FROM listing l JOIN h ON h.host_id IS NOT DISTINCT FROM l.host_id) "
    "SELECT CASE WHEN y < 3 THEN '0-3y' WHEN y < 6 THEN '3-6y' WHEN y < 10 THEN '6-10y' ELSE '10y+' END AS tenure_bucket, CAST(count(*) AS BIGINT) AS listings, "
    "round(avg(number_of_reviews), 1) AS avg_reviews, round(avg(reviews_per_month), 2) AS avg_reviews_pm FROM x WHERE y IS NOT NULL GROUP BY 1",
)
def _(t):
    return answers.QUESTIONS["tenure_and_reviews"](_star(t))


@query(
    "K12_monthly_availability_over_star",
    "SELECT city, year, month, CAST(count(*) AS BIGINT) AS listing_days, round(avg(CASE WHEN available THEN 1e0 ELSE 0e0 END), 3) AS avail_rate FROM cal GROUP BY 1, 2, 3",
)
def _(t):
    return answers.QUESTIONS["monthly_availability"](_star(t))


@query(
    "K12_subscores_over_star",
    "SELECT city, " + ", ".join(f"round(avg(review_scores_{s}), 3) AS {s}" for s in ("cleanliness", "location", "communication", "value")) + " FROM listing GROUP BY 1",
)
def _(t):
    return answers.QUESTIONS["subscores_by_city"](_star(t))


@query(
    "K7_calendar_facts",
    "SELECT listing_id, CAST(year(date) * 10000 + month(date) * 100 + day(date) AS INTEGER) AS date_key, city_key, available, CAST(minimum_nights AS INTEGER) AS minimum_nights FROM cal",
)
def _(t):
    return warehouse.calendar_facts(t.calendar("listing_id", "date", "city_key", "available", "minimum_nights"))


@query(
    "K8_review_facts",
    "SELECT review_sk, listing_id, city_key, CAST(year(date) * 10000 + month(date) * 100 + day(date) AS INTEGER) AS date_key "
    "FROM (SELECT *, row_number() OVER (ORDER BY id) AS review_sk FROM review) WHERE listing_id IS NOT NULL AND date IS NOT NULL",
)
def _(t):
    return warehouse.review_facts(t.reviews("_row_id", "listing_id", "city_key", "date"))


@query(
    "K9_master",
    f"""WITH s AS (SELECT listing_id, count(date) AS c, max(date) - min(date) AS span FROM review WHERE listing_id IS NOT NULL GROUP BY 1), nb AS ({PROFILE})
    SELECT id, CASE WHEN round_even(date_diff('day', host_since, DATE '2024-06-15') / 365.25e0, 2) >= 0 THEN round_even(date_diff('day', host_since, DATE '2024-06-15') / 365.25e0, 2) + 0e0 END AS host_tenure_years,
    round_even(c / nullif(span / 30.44e0, 0), 3) AS review_frequency_pm, round_even(price / nullif(bedrooms, 0), 2) AS price_per_bedroom, nb_median_price, nb_density_pct
    FROM listing LEFT JOIN s ON id = listing_id LEFT JOIN nb USING (city_key, neighbourhood_std)""",
)
def _(t):
    listings = t.listing(*PROFILE_INPUT, "snapshot_date", "host_since", "bedrooms").withColumnRenamed("bedrooms", "bedrooms_filled")
    master = enrich.build_master(listings, t.reviews("listing_id", "date"))
    return master.select("id", "host_tenure_years", "review_frequency_pm", "price_per_bedroom", "nb_median_price", "nb_density_pct")


@query(
    "S5_inventory",
    "SELECT concat(city_key, '.listings') AS dataset, CAST(count(*) AS BIGINT) AS rows, 2 AS cols FROM listing GROUP BY city_key "
    "UNION ALL SELECT concat(city_key, '.reviews'), CAST(count(*) AS BIGINT), 2 FROM review GROUP BY city_key",
)
def _(t):
    return files.inventory({"listings": t.listing("city_key", "id"), "reviews": t.reviews("city_key", "listing_id")})


@query("S10_spark_sql", "SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1")
def _(t):
    tables.register_views({"staylens_orders": t.table("orders")})
    return t.spark.sql("SELECT o_orderstatus, count(*) AS n FROM staylens_orders GROUP BY o_orderstatus")


@query(
    "S12_report_section",
    "SELECT '2 largest' AS section, CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank, "
    "concat('{\"o_orderkey\":', CAST(o_orderkey AS STRING), ',\"o_orderstatus\":\"', o_orderstatus, '\"}') AS payload "
    "FROM (SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15)",
)
def _(t):
    ranked = t.table("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    out = tables.report_section(ranked, "2 largest", [F.desc("o_totalprice"), "o_orderkey"], 15)
    kept = F.from_json("payload", "o_orderkey bigint, o_orderstatus string")
    return out.withColumn("payload", F.to_json(kept))


@query(
    "S13_table_counts",
    " UNION ALL ".join(f"SELECT '{n}' AS \"table\", CAST(count(*) AS BIGINT) AS rows FROM {n}" for n in ("customer", "orders", "lineitem", "events")),
)
def _(t):
    return warehouse.table_counts({n: t.table(n) for n in ("customer", "orders", "lineitem", "events")})


@query("M4_median_fill_in_place", "SELECT id, coalesce(bedrooms, (SELECT median(bedrooms) FROM listing)) AS bedrooms, bedrooms IS NULL AS bedrooms_imputed FROM listing")
def _(t):
    return features.fill_medians(t.listing("id", "bedrooms"), ["bedrooms"])


def scratch(t, name: str) -> str:
    """A new folder beside the session's checkpoints, which all executors share."""
    root = t.spark.conf.get("spark.checkpoint.dir", None) or t.spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "-checkpoints"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query(
    "S3_S4_new_files",
    " UNION ALL ".join(
        f"SELECT {run} AS run, concat('city_key=', city_key) AS city_key, CAST(count(*) AS BIGINT) AS rows FROM listing WHERE {which} GROUP BY city_key"
        for run, which in ((1, "id % 2 = 0"), (2, "id % 2 = 1"), (4, "true"))
    ),
)
def _(t):
    """Two batches of files arrive one after the other; a run reads those that no earlier
    one has read. The third run finds nothing new, the fourth is forced to read all."""
    root, known, found = scratch(t, "arrivals"), None, []
    listing = t.listing("city_key", "id", "room_type", "price").withColumn("snapshot_date", F.when(F.col("id") % 2 == 0, "2024-06-15").otherwise("2024-07-15"))
    for run, batch in ((1, "2024-06-15"), (2, "2024-07-15"), (3, None), (4, None)):
        if batch:
            own = listing.where(F.col("snapshot_date") == batch)
            own.write.mode("append").option("header", "true").partitionBy("city_key", "snapshot_date").csv(root)
        manifest = checkpoint(files.file_manifest(t.spark, root, known))
        # one row per file
        fresh = sorted((r["url"], r["header"]) for r in files.new_files(manifest, known, force=run == 4).collect())
        if fresh:
            rows = files.bronze(t.spark, fresh).groupBy("city_key").agg(F.count("id").alias("rows"))
            found.append(rows.select(F.lit(run).alias("run"), "city_key", "rows"))
        known = manifest
    return quality.stack(found)


PUBLISHED_ROWS = {
    "dim_city": "count(DISTINCT city_key)", "dim_date": "count(DISTINCT snapshot_date)",
    "dim_host": "count(DISTINCT coalesce(host_id, -1))", "dim_neighbourhood": "count(DISTINCT (city_key, neighbourhood_std))",
    "dim_property": "count(DISTINCT (property_type_clean, property_family))", "dim_room_type": "count(DISTINCT room_type)",
    "fact_listing": "count(*)",
}


@query(
    "S9_S6_published_load",
    " UNION ALL ".join(
        f"SELECT '{n}' AS \"table\", CAST({c} AS BIGINT) AS rows, CAST({2 if n == 'dim_room_type' else 1} AS BIGINT) AS loads, TRUE AS refused FROM listing"
        for n, c in PUBLISHED_ROWS.items()
    ),
)
def _(t):
    """A load, one that is refused for its keys, and one of a single table: what readers see."""
    root, master = scratch(t, "warehouse"), t.listing(*MASTER)
    dims = {
        **_dims(master), "dim_city": warehouse.city_table(master, _cities()),
        "dim_date": warehouse.date_table([(master, "snapshot_date")]),
    }
    load = tables.Load(t.spark, root)
    stored = load.stage(dims)
    load.stage({"fact_listing": warehouse.listing_facts(master, stored)})
    load.publish()
    rooms = stored["dim_room_type"]
    try:
        tables.write_tables({"dim_room_type": rooms.where("room_type_sk > 1")}, root)
        refused = False
    except ValueError:
        refused = True
    tables.write_tables({"dim_room_type": rooms}, root)
    loads = tables.published(t.spark, root).groupBy("table").agg(F.count(F.lit(1)).alias("loads"))
    counts = warehouse.table_counts(tables.current_tables(t.spark, root))
    return counts.join(loads, "table").select("table", "rows", "loads", F.lit(refused).alias("refused"))
