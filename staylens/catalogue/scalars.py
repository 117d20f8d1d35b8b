"""Parsers, predicates, projections and arithmetic (P), and the scans they ride on."""

from __future__ import annotations

from pyspark.sql import functions as F

from staylens.catalogue.registry import query, rounded
from staylens.config import NA_TOKENS, ROOM_TYPES
from staylens.functions import numbers as n, parsing as p, text as x
from staylens.operators import clean, market, order

NUMBER = r"regexp_matches(trim({c}), '^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$')"


def sql_number(c: str) -> str:
    return f"CASE WHEN {NUMBER.format(c=c)} THEN TRY_CAST(trim({c}) AS DOUBLE) END"


def sql_date(c: str) -> str:
    return f"TRY_CAST(try_strptime(replace({c}, '/', '-'), '%Y-%m-%d') AS DATE)"


PRICE = sql_number("regexp_replace(price, '[$,]', '', 'g')")


@query("S7_lazy_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 20000")
def _(t):
    return t.table("orders").where("o_totalprice < 20000").select("o_orderkey", "o_totalprice")


@query("S8_table_read", "SELECT CAST(count(*) AS BIGINT) AS n, min(c_custkey) AS low, max(c_custkey) AS high FROM customer")
def _(t):
    return t.table("customer").agg(F.count(F.lit(1)).alias("n"), F.min("c_custkey").alias("low"), F.max("c_custkey").alias("high"))


@query("P1_money", f"SELECT id, {PRICE} AS price FROM raw")
def _(t):
    return t.raw("id", "price").select("id", p.money(F.col("price")).alias("price"))


@query("P2_numbers", f"SELECT id, {sql_number('amount')} AS amount, {sql_number('latitude')} AS latitude FROM raw")
def _(t):
    raw = t.raw("id", "amount", "latitude")
    return raw.select("id", *[p.num(F.col(c)).alias(c) for c in ("amount", "latitude")])


@query("P3_dates", f"SELECT id, {sql_date('day')} AS day FROM raw")
def _(t):
    return t.raw("id", "day").select("id", p.parse_date(F.col("day")).alias("day"))


@query("P4_percent", "SELECT id, " + sql_number("rtrim(rate, '%')") + " / 100e0 AS rate FROM raw")
def _(t):
    return t.raw("id", "rate").select("id", p.percent(F.col("rate")).alias("rate"))


@query(
    "P5_boolean",
    "SELECT id, CASE WHEN lower(trim(flag)) IN ('t','true') THEN true WHEN lower(trim(flag)) IN ('f','false') THEN false END AS flag FROM raw",
)
def _(t):
    return t.raw("id", "flag").select("id", p.boolean(F.col("flag")).alias("flag"))


@query(
    "P6_canonical_room_type",
    "SELECT id, CASE lower(trim(room_type)) WHEN 'entire home/apt' THEN 'Entire home/apt' WHEN 'private room' THEN 'Private room' "
    "WHEN 'shared room' THEN 'Shared room' WHEN 'hotel room' THEN 'Hotel room' ELSE trim(room_type) END AS room_type FROM raw",
)
def _(t):
    return t.raw("id", "room_type").select("id", p.canonical(F.col("room_type"), ROOM_TYPES).alias("room_type"))


@query(
    "P7_property_words",
    r"""WITH s AS (SELECT id, regexp_replace(regexp_replace(trim(property_type), '\s+', ' ', 'g'), 'condominium', 'condo', 'gi') AS v FROM raw)
    SELECT id, array_to_string(list_transform(string_split(v, ' '), lambda w : concat(upper(w[1]), w[2:])), ' ') AS property_type FROM s""",
)
def _(t):
    return t.raw("id", "property_type").select("id", x.tidy_words(F.col("property_type")).alias("property_type"))


@query(
    "P8_property_family",
    "SELECT id, CASE WHEN lower(property_type) LIKE 'entire%' THEN 'Entire place' WHEN lower(property_type) LIKE 'private room%' THEN 'Private room' "
    "WHEN lower(property_type) LIKE 'shared room%' THEN 'Shared room' WHEN lower(property_type) LIKE '%hotel%' OR lower(property_type) LIKE '%hostel%' "
    "THEN 'Hotel/Hostel' ELSE 'Other' END AS family FROM raw",
)
def _(t):
    return t.raw("id", "property_type").select("id", x.family(x.tidy_words(F.col("property_type"))).alias("family"))


@query(
    "P9_coordinates",
    "SELECT id, round_even(latitude / 3, 6) AS latitude, round_even(longitude / 7, 6) AS longitude FROM listing",
)
def _(t):
    listing = t.listing("id", "latitude", "longitude")
    return listing.select(
        "id", n.round_even(F.col("latitude") / 3, 6).alias("latitude"), n.round_even(F.col("longitude") / 7, 6).alias("longitude")
    )


@query("P10_neighbourhood", r"SELECT id, regexp_replace(trim(split_part(place, ',', 1)), '\s+', ' ', 'g') AS place FROM raw")
def _(t):
    return t.raw("id", "place").select("id", x.before_comma(F.col("place")).alias("place"))


@query("P11_null_to_zero", "SELECT id, coalesce(reviews_per_month, 0e0) AS reviews_per_month FROM listing")
def _(t):
    return t.listing("id", "reviews_per_month").select("id", F.coalesce("reviews_per_month", F.lit(0.0)).alias("reviews_per_month"))


@query(
    "P12_missing_flag",
    "SELECT id, flag IS NULL AS flag_missing, coalesce(lower(trim(flag)) IN ('t','true'), false) AS flag FROM raw",
)
def _(t):
    flag = F.col("flag")
    return t.raw("id", "flag").select(
        "id", flag.isNull().alias("flag_missing"), F.coalesce(p.boolean(flag), F.lit(False)).alias("flag")
    )


@query(
    "P13_median_fill",
    "SELECT id, bedrooms, bedrooms IS NULL AS bedrooms_imputed, coalesce(bedrooms, median(bedrooms) OVER (PARTITION BY city_key)) AS bedrooms_filled FROM listing",
)
def _(t):
    return clean.median_fill(t.listing("id", "city_key", "bedrooms"), ["city_key"], ["bedrooms"]).drop("city_key")


GATE = f"""WITH typed AS (SELECT id, {PRICE} AS price, round({sql_number('latitude')}, 6) AS lat, round({sql_number('longitude')}, 6) AS lon FROM raw),
    gated AS (SELECT id, concat(CASE WHEN price <= 0 THEN 'bad_price;' ELSE '' END, CASE WHEN price > 50000 THEN 'price_over_max;' ELSE '' END,
      CASE WHEN lat IS NULL OR lat < -90 OR lat > 90 THEN 'bad_latitude;' ELSE '' END,
      CASE WHEN lon IS NULL OR lon < -180 OR lon > 180 THEN 'bad_longitude;' ELSE '' END) AS reject_reason FROM typed) """


def _gated(t):
    typed = clean.standard_columns(t.raw("id", "price", "latitude", "longitude"))
    return (typed.select(F.col("id").cast("string").alias("id"), clean.reject_reason().alias("reject_reason")))


@query("P14_rejects", GATE + "SELECT id, reject_reason FROM gated WHERE reject_reason <> ''")
def _(t):
    return clean.rejected(_gated(t))


@query("P14_gate_totals", GATE + "SELECT reject_reason, CAST(count(*) AS BIGINT) AS n FROM gated GROUP BY 1")
def _(t):
    return _gated(t).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    "P15_calendar",
    f"SELECT CAST(id AS BIGINT) AS listing_id, {sql_date('day')} AS date, CASE WHEN lower(trim(flag)) IN ('t','true') THEN true "
    f"WHEN lower(trim(flag)) IN ('f','false') THEN false END AS available, {PRICE} AS price, {sql_number('minimum_nights')} AS minimum_nights "
    f"FROM raw WHERE {sql_date('day')} IS NOT NULL",
)
def _(t):
    raw = t.raw("id", "day", "flag", "price", "minimum_nights").select(
        F.col("id").alias("listing_id"), F.col("day").alias("date"), F.col("flag").alias("available"), "price", "minimum_nights"
    )
    return clean.clean_calendar(raw)


@query("P16_date_key", "SELECT id, CAST(year(host_since) * 10000 + month(host_since) * 100 + day(host_since) AS INTEGER) AS date_key FROM listing")
def _(t):
    return t.listing("id", "host_since").select("id", n.date_key(F.col("host_since")).alias("date_key"))


@query(
    "P17_tenure",
    "SELECT id, CASE WHEN round_even(date_diff('day', host_since, DATE '2024-06-15') / 365.25e0, 2) >= 0 THEN round_even(date_diff('day', host_since, DATE '2024-06-15') / 365.25e0, 2) + 0e0 END AS tenure, "
    "round(date_diff('day', host_since, DATE '2024-06-15') / CASE WHEN date_diff('day', host_since, DATE '2024-06-15') > 1460 THEN 365.25e0 ELSE 365e0 END, 2) AS tenure_calendar FROM listing",
)
def _(t):
    day = F.lit("2024-06-15").cast("date")
    since = F.col("host_since")
    return t.listing("id", "host_since").select(
        "id", n.tenure_years(since, day).alias("tenure"), n.tenure_years_calendar(since, day).alias("tenure_calendar")
    )


@query(
    "P18_reviews_per_month",
    "SELECT id, round_even(number_of_reviews / nullif((minimum_nights - 1) / 30.44e0, 0), 3) AS per_month FROM listing",
)
def _(t):
    return t.listing("id", "number_of_reviews", "minimum_nights").select(
        "id", n.per_month(F.col("number_of_reviews"), F.col("minimum_nights") - 1).alias("per_month")
    )


@query("P19_price_per_bedroom", "SELECT id, round_even(price / nullif(bedrooms, 0), 2) AS per_bedroom FROM listing")
def _(t):
    return t.listing("id", "price", "bedrooms").select("id", n.per_unit(F.col("price"), F.col("bedrooms")).alias("per_bedroom"))


@query(
    "P20_bands",
    "SELECT id, floor(longitude / 2) * 2e0 AS band2, floor(price / 50) * 50e0 AS price_band FROM listing",
)
def _(t):
    return t.listing("id", "longitude", "price").select(
        "id", n.band(F.col("longitude"), 2).alias("band2"), n.band(F.col("price"), 50).alias("price_band")
    )


@query(
    "P21_great_circle",
    "SELECT id, round(12742e0 * asin(sqrt(pow(sin(radians(latitude - 10) / 2), 2) + cos(radians(latitude)) * cos(radians(10)) * pow(sin(radians(longitude - 110) / 2), 2))), 4) AS km FROM listing",
)
def _(t):
    km = n.distance_km(F.col("latitude"), F.col("longitude"), F.lit(10.0), F.lit(110.0))
    return rounded(t.listing("id", "latitude", "longitude").select("id", km.alias("km")))


@query(
    "P22_buckets",
    "SELECT id, CASE WHEN number_of_reviews < 3 THEN '0-3y' WHEN number_of_reviews < 6 THEN '3-6y' WHEN number_of_reviews < 10 THEN '6-10y' ELSE '10y+' END AS tenure, "
    "CASE WHEN accommodates = 1 THEN 'Single (1)' WHEN accommodates <= 3 THEN 'Small (2-3)' WHEN accommodates <= 9 THEN 'Multi (4-9)' ELSE 'Commercial (10+)' END AS segment, "
    "CASE WHEN accommodates = 1 THEN 'Casual' ELSE 'Professional' END AS host_type, "
    "CASE WHEN isodow(host_since) IN (6, 7) THEN 'weekend' ELSE 'weekday' END AS day_type FROM listing",
)
def _(t):
    size = F.col("accommodates")
    return t.listing("id", "number_of_reviews", "accommodates", "host_since").select(
        "id", n.tenure_bucket(F.col("number_of_reviews")).alias("tenure"), n.host_segment(size).alias("segment"),
        n.host_type(size).alias("host_type"), n.day_type(F.col("host_since")).alias("day_type"),
    )


@query(
    "P23_period",
    "SELECT DISTINCT concat(CAST(year AS STRING), '-', lpad(CAST(month AS STRING), 2, '0')) AS period, make_date(year, month, 1) AS month_start FROM cal",
)
def _(t):
    y, m = F.col("year"), F.col("month")
    return t.calendar("year", "month").select(n.period(y, m).alias("period"), n.month_start(y, m).alias("month_start")).distinct()


@query(
    "P24_transforms",
    "SELECT id, round(ln(price), 6) AS log, round(ln(1 + price), 6) AS log1p, round(asin(sqrt(availability_365 / 366)), 6) AS arc FROM listing",
)
def _(t):
    return rounded(
        t.listing("id", "price", "availability_365").select(
            "id", F.ln("price").alias("log"), F.log1p("price").alias("log1p"), F.asin(F.sqrt(F.col("availability_365") / 366)).alias("arc")
        ),
        6,
    )


@query("P25_licence_words", r"SELECT id, regexp_matches(coalesce(license, ''), '(?i)\b(ESFC|ETV)\b') AS license FROM raw")
def _(t):
    return t.raw("id", "license").select("id", x.has_word(F.col("license"), ("ESFC", "ETV")).alias("license"))


@query(
    "P26_list_flags",
    """SELECT event_id, coalesce(len(list_filter(list_value(event_type, 'Fast Wifi', lower(event_type)), lambda v : contains(lower(v), 'click'))) > 0, false) AS has_click,
    len(list_filter(list_value(event_type, 'Fast Wifi'), lambda v : contains(lower(v), 'wifi'))) > 0 AS has_wifi FROM events""",
)
def _(t):
    names = F.to_json(F.array("event_type", F.lit("Fast Wifi"), F.lower("event_type")))
    return t.table("events").select("event_id", *x.list_flags(names, ("Click", "Wifi")))


@query(
    "P27_title_segments",
    "SELECT n_nationkey, array_to_string(list_transform(string_split(concat('north ', lower(r_name)), ' '), lambda w : concat(upper(w[1]), w[2:])), ' ') AS country "
    "FROM nation JOIN region ON n_regionkey = r_regionkey",
)
def _(t):
    joined = t.table("nation").join(t.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    slug = F.concat(F.lit("north-"), F.lower("r_name"), F.lit("/x/y"))
    return joined.select("n_nationkey", x.title_segment(slug, 1).alias("country"))


@query("P28_round_price", "SELECT id, floor(price / 1000) % 10 = 0 AS round_price FROM listing")
def _(t):
    return t.listing("id", "price").select("id", (F.floor(F.col("price") / 1000) % 10 == 0).alias("round_price"))


@query(
    "P29_price_to_group_median",
    "SELECT id, round(price / nullif(median(price) OVER (PARTITION BY city), 0), 6) AS price_idx FROM listing",
)
def _(t):
    out = market.ratio_to_median(t.listing("id", "city", "price"), ["city"], "price", "price_idx")
    return rounded(out.select("id", "price_idx"), 6)


@query(
    "P30_implied_bookings",
    "SELECT id, reviews_per_month / 0.5e0 AS implied_bookings_pm FROM listing WHERE reviews_per_month IS NOT NULL AND estimated_occupancy_l365d IS NOT NULL",
)
def _(t):
    out = market.implied_bookings(t.listing("id", "reviews_per_month", "estimated_occupancy_l365d"))
    return out.select("id", "implied_bookings_pm")


@query("P31_reshape_columns", "SELECT o_totalprice AS price, o_orderkey AS id FROM orders")
def _(t):
    renamed = t.table("orders").drop("o_custkey", "o_orderdate").withColumnsRenamed({"o_totalprice": "price", "o_orderkey": "id"})
    return renamed.select(*[c for c in ("price", "id") if c in market.numeric_columns(renamed)])


@query(
    "P32_filters",
    "SELECT id, price FROM listing WHERE price IS NOT NULL AND review_scores_rating IS NOT NULL AND room_type = '5-LOW' AND price BETWEEN 50000 AND 100000",
)
def _(t):
    listing = t.listing("id", "price", "review_scores_rating", "room_type").dropna(subset=["price", "review_scores_rating"])
    return listing.where((F.col("room_type") == "5-LOW") & F.col("price").between(50000, 100000)).select("id", "price")


@query(
    "P33_below_quantile",
    """WITH r AS (SELECT price, row_number() OVER (ORDER BY price) - 1 AS i, count(*) OVER () AS n FROM listing WHERE price IS NOT NULL),
    q AS (SELECT price AS limit_price FROM r WHERE i = CAST(floor((n - 1) * 0.99e0 + 0.5e0) AS BIGINT))
    SELECT id, price FROM listing, q WHERE price < limit_price""",
)
def _(t):
    return market.below_quantile(t.listing("id", "price"), "price", 0.99)


@query(
    "P34_minimum_group_size",
    "SELECT neighbourhood, property_family, CAST(count(*) AS BIGINT) AS n FROM listing GROUP BY 1, 2 HAVING count(*) >= 200",
)
def _(t):
    return t.listing("neighbourhood", "property_family").groupBy("neighbourhood", "property_family").agg(
        F.count(F.lit(1)).alias("n")
    ).where("n >= 200")


@query("P35_split_text", "SELECT DISTINCT split_part(c_name, '#', 1) AS kind, CAST(split_part(c_name, '#', 2) AS BIGINT) AS number FROM customer")
def _(t):
    name = F.col("c_name")
    part = [F.split_part(name, F.lit("#"), F.lit(i)) for i in (1, 2)]
    return t.table("customer").select(part[0].alias("kind"), part[1].cast("bigint").alias("number")).distinct()


@query("P36_replace_whole_value", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderstatus END AS status FROM orders")
def _(t):
    return t.table("orders").select("o_orderkey", F.col("o_orderstatus").alias("status")).replace("F", "", ["status"])


@query("S1_missing_tokens", "SELECT id, CASE WHEN price IN ('n/a', 'NaN') THEN NULL ELSE price END AS price FROM raw")
def _(t):
    return t.raw("id", "price").select("id", p.blank_to_null(F.col("price"), NA_TOKENS).alias("price"))


@query(
    "S2_tagged_rows",
    "SELECT 'north' AS city_key, '2024-06-15' AS snapshot_date, n_nationkey FROM nation",
)
def _(t):
    from staylens.sources.files import place

    path = F.lit("/raw/north/2024-06-15/listings.csv")
    return t.table("nation").select(place(path, 3).alias("city_key"), place(path, 2).alias("snapshot_date"), "n_nationkey")


@query(
    "P33_quantiles_linear_and_nearest",
    """WITH r AS (SELECT room_type, price, row_number() OVER (PARTITION BY room_type ORDER BY price) - 1 AS i, count(*) OVER (PARTITION BY room_type) AS n FROM listing WHERE price IS NOT NULL),
    a AS (SELECT room_type, max(price) AS p90_nearest FROM r WHERE i = CAST(floor((n - 1) * 0.9e0 + 0.5e0) AS BIGINT) GROUP BY 1),
    b AS (SELECT room_type, round(quantile_cont(price, 0.9), 4) AS p90 FROM listing GROUP BY 1)
    SELECT room_type, p90, p90_nearest FROM a JOIN b USING (room_type)""",
)
def _(t):
    return rounded(order.quantiles(t.listing("room_type", "price"), ["room_type"], "price", {"p90": 0.9, "p90_nearest": (0.9, "nearest")}))
