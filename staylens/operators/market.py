"""Market answers: price, season, distance, hosts, demand and review scores.

Frames carry the column names of the star (`city`, `room_type`, `price`, ...);
`listing_star` and `calendar_star` build them from warehouse tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from staylens.config import SUBSCORES
from staylens.functions.numbers import (
    band, correlation, day_type, distance_km, host_segment, host_type, month_start, period, ratio, round_away, tenure_bucket,
)
from staylens.operators.order import (
    NEAREST, attach, counted, grouped, medians, quantiles, quantiles_of, unpivot,
)


def rows(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def share_true(condition: Column) -> Column:
    return F.avg(condition.cast("double"))


# ---- star ---------------------------------------------------------------


def listing_star(tables: Mapping[str, DataFrame], *dims: str) -> DataFrame:
    """Listing facts inner joined to the city and the named dimensions."""
    keys = {
        "dim_host": "host_sk", "dim_neighbourhood": "neighbourhood_sk",
        "dim_property": "property_sk", "dim_room_type": "room_type_sk",
    }
    cities = tables["dim_city"].select("city_key", F.col("display_name").alias("city"))
    star = tables["fact_listing"].join(cities, "city_key")
    for name in dims:
        star = star.join(tables[name].drop("city_key"), keys[name])
    return star


def dated_star(tables: Mapping[str, DataFrame], fact: str) -> DataFrame:
    """Calendar or review facts with the parts of the date and the city name; days and
    configured cities are few, so the facts are not shuffled for them."""
    cities = tables["dim_city"].select("city_key", F.col("display_name").alias("city"))
    dates = tables["dim_date"].select("date_key", "date", "year", "month")
    return tables[fact].join(F.broadcast(dates), "date_key").join(F.broadcast(cities), "city_key")


# ---- the seven standing questions ---------------------------------------


def price_by_room(df: DataFrame) -> DataFrame:
    found = grouped(
        df, ["city", "room_type"],
        [rows("listings"), F.avg("review_scores_rating").alias("_rating")],
        {"_price": "price"},
    )
    return found.select(
        "city", "room_type", "listings",
        round_away(F.col("_price"), 2).alias("median_price"),
        round_away(F.col("_rating"), 2).alias("avg_rating"),
    ).orderBy("city", F.desc("listings"), "room_type")


def top_neighbourhoods(df: DataFrame, k: int = 10) -> DataFrame:
    found = (
        df.where(F.col("estimated_revenue_l365d").isNotNull())
        .groupBy("city", "neighbourhood", "nb_listing_count", "nb_median_price")
        .agg(
            F.sum("estimated_revenue_l365d").alias("_revenue"),
            F.avg("estimated_occupancy_l365d").alias("_nights"),
        )
    )
    return (
        found.select(
            "city", "neighbourhood",
            F.col("nb_listing_count").alias("listings"),
            round_away(F.col("nb_median_price"), 2).alias("median_price"),
            round_away(F.col("_revenue"), 2).alias("est_total_revenue"),
            round_away(F.col("_nights"), 1).alias("avg_occupied_nights"),
        )
        .orderBy(F.desc("est_total_revenue"), "city", "neighbourhood")
        .limit(k)
    )


def superhost_premium(df: DataFrame) -> DataFrame:
    found = grouped(df, ["city", "host_is_superhost"], [rows("listings")], {"_price": "price"})
    return found.select(
        "city", "host_is_superhost", "listings", round_away(F.col("_price"), 2).alias("median_price")
    ).orderBy("city", "host_is_superhost")


def price_by_family(df: DataFrame) -> DataFrame:
    by = ["property_family"]
    found = attach(
        df.groupBy(*by).agg(rows("listings")),
        quantiles(df, by, "price", {"p25": 0.25, "p50": 0.5, "p75": 0.75}),
        by,
    )
    return found.select(
        *by, "listings", *[round_away(F.col(p), 2).alias(p) for p in ("p25", "p50", "p75")]
    ).orderBy(F.desc("listings"), *by)


def tenure_activity(df: DataFrame) -> DataFrame:
    years = F.col("host_tenure_years")
    return (
        df.where(years.isNotNull())
        .groupBy(tenure_bucket(years).alias("tenure_bucket"))
        .agg(
            rows("listings"),
            round_away(F.avg("number_of_reviews"), 1).alias("avg_reviews"),
            round_away(F.avg("reviews_per_month"), 2).alias("avg_reviews_pm"),
        )
        .orderBy("tenure_bucket")
    )


def monthly_availability(df: DataFrame) -> DataFrame:
    free = F.when(F.col("available"), 1.0).otherwise(0.0)
    return (
        df.groupBy("city", "year", "month")
        .agg(rows("listing_days"), round_away(F.avg(free), 3).alias("avail_rate"))
        .orderBy("city", "year", "month")
    )


def subscores_by_city(
    df: DataFrame, scores: Sequence[str] = ("cleanliness", "location", "communication", "value")
) -> DataFrame:
    return (
        df.groupBy("city")
        .agg(*[round_away(F.avg(f"review_scores_{s}"), 3).alias(s) for s in scores])
        .orderBy("city")
    )


def subscores_overall(df: DataFrame, scores: Sequence[str] = SUBSCORES) -> DataFrame:
    """Mean of each sub-score over all listings, lowest first."""
    return (
        unpivot(df, [], scores)
        .groupBy("variable")
        .agg(F.avg("value").alias("mean"))
        .orderBy("mean", "variable")
    )


# ---- distributions ------------------------------------------------------


def numeric_columns(df: DataFrame) -> list[str]:
    kinds = ("tinyint", "smallint", "int", "bigint", "float", "double")
    return [c for c, kind in df.dtypes if kind in kinds]


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Mean, median, deviation, skewness, p95 (closest rank) and nulls per column."""
    columns = list(columns or numeric_columns(df))
    long = unpivot(df, [], columns)
    moments = long.groupBy("variable").agg(
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.skewness("value").alias("skew"),
        F.count_if(F.col("value").isNull()).alias("nulls"),
    )
    places = quantiles(long, ["variable"], "value", {"median": 0.5, "p95": (0.95, NEAREST)})
    return moments.join(places, "variable", "left").select(
        "variable", "mean", "median", "std", "skew", "p95", "nulls"
    )


def below_quantile(df: DataFrame, value: str, probability: float, of: DataFrame | None = None) -> DataFrame:
    """Rows strictly below the closest-rank quantile of the whole column."""
    limit = quantiles(df if of is None else of, [], value, {"_limit": (probability, NEAREST)})
    return attach(df, limit, [], "inner").where(F.col(value) < F.col("_limit")).drop("_limit")


def box_summary(df: DataFrame, by: Sequence[str], value: str, reach: float = 1.5) -> DataFrame:
    """Quartiles and whiskers (outermost values within `reach` IQRs) per group,
    groups in the order of their medians."""
    by = list(by)
    counts = counted(df, by, value)
    found = quantiles_of(counts, by, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    spread = (F.col("q3") - F.col("q1")) * reach
    low, high = F.col("q1") - spread, F.col("q3") + spread
    v = F.col("_v")
    return (
        attach(counts, found, by, "inner")
        .groupBy(*by, "q1", "median", "q3")
        .agg(
            F.sum("_n").alias("n"),
            F.min(F.when(v >= low, v)).alias("whisker_low"),
            F.max(F.when(v <= high, v)).alias("whisker_high"),
        )
        .orderBy("median", *by)
    )


def histogram(df: DataFrame, value: str, bins: int = 40) -> DataFrame:
    """Counts in equal bins from the smallest to the largest value."""
    known = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("_v"))
    ends = known.agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    place = F.floor(F.coalesce(ratio(F.col("_v") - F.col("_lo"), width), F.lit(0.0)))
    return (
        attach(known, ends, [], "inner")
        .groupBy(F.least(place, F.lit(bins - 1)).alias("bin"), F.col("_lo"), F.col("_hi"))
        .agg(rows("n"))
        .select(
            "bin",
            (F.col("_lo") + width * F.col("bin")).alias("bin_start"),
            (F.col("_lo") + width * (F.col("bin") + 1)).alias("bin_end"),
            "n",
        )
    )


def describe_column(df: DataFrame, value: str, at_least: Sequence[float] = (4.5, 4.9)) -> DataFrame:
    """Count, moments, closest-rank quartiles and the shares at or above some levels."""
    v = F.col(value)
    known = df.where(v.isNotNull())
    base = known.agg(
        rows("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"),
        *[share_true(v >= level).alias(f"share_ge_{str(level).replace('.', '_')}") for level in at_least],
    )
    places = quantiles(known, [], value, {"p25": (0.25, NEAREST), "p50": (0.5, NEAREST), "p75": (0.75, NEAREST)})
    return attach(base, places, [], "inner")


def availability_by_city(df: DataFrame, column: str = "availability_365") -> DataFrame:
    c = F.col(column)
    return grouped(
        df, ["city"], [F.avg(c).alias("mean_avail"), share_true(c == 0).alias("pct_zero")], {"median_avail": column}
    ).select("city", "mean_avail", "median_avail", "pct_zero")


def density_cells(df: DataFrame, cell: float = 0.005, by: Sequence[str] = ("city",)) -> DataFrame:
    """Listings per coordinate cell, the data of a heat map; `by` may add the
    room type for the data of a point map."""
    return (
        df.dropna(subset=["latitude", "longitude"])
        .groupBy(*by, band(F.col("latitude"), cell).alias("lat"), band(F.col("longitude"), cell).alias("lon"))
        .agg(rows("n"))
    )


# ---- distance -----------------------------------------------------------


def city_centres(df: DataFrame, key: str = "city") -> DataFrame:
    """Median latitude and longitude per city."""
    return medians(df, [key], {"lat0": "latitude", "lon0": "longitude"})


def distance_to_centre(df: DataFrame, key: str = "city", centres: DataFrame | None = None) -> DataFrame:
    """Adds the distance in km to the median point of the row's city."""
    centres = city_centres(df, key) if centres is None else centres
    located = df.dropna(subset=["latitude", "longitude"])
    km = distance_km(F.col("latitude"), F.col("longitude"), F.col("lat0"), F.col("lon0"))
    return located.join(centres, key).withColumn("dist_km", km)


def price_gradient(geo: DataFrame, width: float = 1.0, min_n: int = 5) -> DataFrame:
    priced = geo.where(F.col("price").isNotNull()).withColumn("band", band(F.col("dist_km"), width))
    return (
        grouped(priced, ["city", "band"], [rows("n")], {"median_price": "price"})
        .where(F.col("n") >= min_n)
        .select("city", "band", "median_price", "n")
        .orderBy("city", "band")
    )


def price_trend(geo: DataFrame) -> DataFrame:
    """Correlation of distance with log price and the price slope per km."""
    priced = geo.where(F.col("price").isNotNull())
    return priced.groupBy("city").agg(
        correlation(F.col("dist_km"), F.log1p("price")).alias("corr_log_price"),
        F.regr_slope("price", "dist_km").alias("price_per_km"),
    )


def ratio_to_median(df: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    """Adds value / median of its group."""
    by = list(by)
    middle = medians(df, by, {"_median": value})
    return attach(df, middle, by).withColumn(name, ratio(F.col(value), F.col("_median"))).drop("_median")


def price_index(geo: DataFrame, width: float = 2.0, max_km: float = 20.0) -> DataFrame:
    """Median price relative to the city's median, per distance band."""
    priced = geo.where(F.col("price").isNotNull())
    indexed = ratio_to_median(priced, ["city"], "price", "price_idx").withColumn("band", band(F.col("dist_km"), width))
    near = indexed.where(F.col("band") <= max_km)
    return medians(near, ["city", "band"], {"price_idx": "price_idx"}).orderBy("city", "band")


def neighbourhood_ratings(geo: DataFrame, min_n: int = 20) -> DataFrame:
    """Centre, mean rating and size of neighbourhoods, with the rating scaled to
    0..1 inside the city."""
    rated = geo.where(F.col("review_scores_rating").isNotNull())
    found = grouped(
        rated, ["city", "neighbourhood"],
        [F.avg("review_scores_rating").alias("rating"), rows("n")],
        {"lat": "latitude", "lon": "longitude"},
    ).where(F.col("n") >= min_n)
    city = Window.partitionBy("city")
    low, high = F.min("rating").over(city), F.max("rating").over(city)
    return found.withColumn("shade", (F.col("rating") - low) / (high - low + F.lit(1e-9)))


# ---- season -------------------------------------------------------------


def seasonal_price(calendar: DataFrame, listings: DataFrame, keys: Sequence[str] = ("listing_id",)) -> DataFrame:
    """Mean listing price per city and month, weighted by calendar days.

    Days are counted per listing and month before the join. With several
    snapshots, `keys` must also name the city and the snapshot.
    """
    days = calendar.groupBy(*keys, "year", "month").agg(F.count(F.lit(1)).alias("_days"))
    weight = F.when(F.col("price").isNotNull(), F.col("_days"))
    return (
        days.join(listings.select(*keys, "city", "price"), list(keys))
        .groupBy("city", "year", "month")
        .agg(ratio(F.sum(F.col("price") * F.col("_days")), F.sum(weight)).alias("avg_price"))
        .withColumn("period", period(F.col("year"), F.col("month")))
        .orderBy("city", "year", "month")
    )


def review_volume(reviews: DataFrame, window: int = 12) -> DataFrame:
    """Reviews per city and month with the mean of the last `window` rows, null
    until there are that many; months without reviews have no row."""
    monthly = reviews.groupBy("city", "year", "month").agg(rows("reviews"))
    last = Window.partitionBy("city").orderBy("month_start").rowsBetween(1 - window, 0)
    full = F.count(F.lit(1)).over(last) == window
    return (
        monthly.withColumn("month_start", month_start(F.col("year"), F.col("month")))
        .withColumn(f"roll{window}", F.when(full, F.avg("reviews").over(last)))
        .orderBy("city", "month_start")
    )


def minimum_nights_by_month(calendar: DataFrame, weekly: int = 7) -> DataFrame:
    nights = F.col("minimum_nights")
    return (
        grouped(
            calendar, ["city", "year", "month"],
            [
                F.avg(nights.cast("double")).alias("mean_min_nights"),
                F.avg(F.when(nights >= weekly, 1.0).otherwise(0.0)).alias("share_weekly_plus"),
                rows("listing_days"),
            ],
            {"median_min_nights": "minimum_nights"},
        )
        .withColumn("month_start", month_start(F.col("year"), F.col("month")))
        .orderBy("city", "month_start")
    )


def availability_by_daytype(calendar: DataFrame, date: str = "date") -> DataFrame:
    """Days with a known state, how many are free and their share, by part of the week."""
    known = calendar.where(F.col("available").isNotNull())
    return known.groupBy(day_type(F.col(date)).alias("daytype")).agg(
        rows("n"), F.count_if(F.col("available")).alias("free"), share_true(F.col("available")).alias("share_free")
    )


# ---- hosts --------------------------------------------------------------


def host_sizes(df: DataFrame, by: Sequence[str] = ("city",), host: str = "host_id") -> DataFrame:
    return df.groupBy(*by, host).agg(rows("n_listings"))


def size_frequency(sizes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """How many hosts hold each number of listings."""
    return sizes.groupBy(*by, "n_listings").agg(rows("hosts"))


def single_share(sizes: DataFrame) -> DataFrame:
    return sizes.agg(share_true(F.col("n_listings") == 1).alias("single_share"))


def _ranked_sizes(sizes: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sizes from large to small with the hosts and listings above each. There
    are at most about sqrt(2 · listings) different sizes."""
    freq = size_frequency(sizes, by)
    group = Window.partitionBy(*by)
    above = group.orderBy(F.desc("n_listings")).rowsBetween(Window.unboundedPreceding, -1)
    held = F.col("n_listings") * F.col("hosts")
    return freq.select(
        *by, "n_listings", "hosts",
        F.coalesce(F.sum("hosts").over(above), F.lit(0)).alias("_hosts_above"),
        F.coalesce(F.sum(held).over(above), F.lit(0)).alias("_listings_above"),
        F.sum("hosts").over(group).alias("n_hosts"),
        F.sum(held).over(group).alias("n_total"),
    )


def top_share(sizes: DataFrame, by: Sequence[str], shares: Sequence[float], plus_one: bool = False) -> DataFrame:
    """Share of listings held by the largest hosts: k = max(1, floor(hosts · q)),
    or floor(hosts · q) + 1."""
    by = list(by)
    levels = F.explode(F.array(*[F.lit(float(q)) for q in shares]))
    ranked = _ranked_sizes(sizes, by).withColumn("top", levels)
    part = F.floor(F.col("n_hosts") * F.col("top"))
    k = part + 1 if plus_one else F.greatest(F.lit(1), part)
    taken = F.least(F.greatest(k - F.col("_hosts_above"), F.lit(0)), F.col("hosts"))
    return (
        ranked.groupBy(*by, "top", "n_total")
        .agg(F.sum(taken * F.col("n_listings")).alias("_held"), F.max(k).alias("k"))
        .select(*by, "top", "k", ratio(F.col("_held"), F.col("n_total")).alias("share"))
    )


def holders_of(sizes: DataFrame, by: Sequence[str], share: float = 0.5) -> DataFrame:
    """Fewest hosts, largest first, that together hold at least this share."""
    by = list(by)
    goal = F.col("n_total") * F.lit(float(share))
    short = goal - F.col("_listings_above")
    rank = F.col("_hosts_above") + F.ceil(short / F.col("n_listings"))
    reached = (short > 0) & (short <= F.col("n_listings") * F.col("hosts"))
    return (
        _ranked_sizes(sizes, by)
        .where(reached)
        .groupBy(*by)
        .agg(F.min(rank).alias("hosts_needed"), F.max("n_hosts").alias("n_hosts"))
        .withColumn("host_share", ratio(F.col("hosts_needed"), F.col("n_hosts")))
    )


def host_measures(df: DataFrame) -> DataFrame:
    by = ["city", "host_id"]
    found = grouped(
        df, by,
        [
            F.bool_or("host_is_superhost").alias("is_superhost"),
            rows("n_listings"),
            F.sum("estimated_revenue_l365d").alias("est_revenue"),
            F.avg("review_scores_rating").alias("avg_rating"),
        ],
        {"median_price": "price"},
    )
    return found.withColumn("segment", host_segment(F.col("n_listings")))


def host_segments(hosts: DataFrame) -> DataFrame:
    """Roll-up of `host_measures` with each segment's shares of its city in percent."""
    found = grouped(
        hosts, ["city", "segment"],
        [rows("hosts"), F.sum("n_listings").alias("listings"), F.sum("est_revenue").alias("revenue")],
        {"median_price": "median_price"},
    )
    city = Window.partitionBy("city")
    shares = [
        round_away(ratio(F.col(c), F.sum(c).over(city)) * 100, 1).alias(n)
        for c, n in (("hosts", "host_share"), ("listings", "listing_share"), ("revenue", "revenue_share"))
    ]
    # fixed values: segments from small to large
    names = ["Single (1)", "Small (2-3)", "Multi (4-9)", "Commercial (10+)"]
    place = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("segment"))
    return found.select("*", *shares).orderBy("city", place)


def host_type_frame(df: DataFrame, host: str = "host_id") -> DataFrame:
    """Priced listings marked by whether their host holds one or more listings; the
    missing host is one host."""
    sizes = df.groupBy(host).agg(rows("n_listings"))
    priced = df.where(F.col("price").isNotNull())
    return attach(priced, sizes, [host]).withColumn("host_type", host_type(F.col("n_listings")))


def host_type_prices(df: DataFrame) -> DataFrame:
    return grouped(
        df, ["city", "host_type", "room_type"], [rows("listings")],
        {"median_price": "price", "median_ppb": "price_per_bedroom"},
    ).orderBy("city", "room_type", "host_type")


def dispersion(df: DataFrame, by: Sequence[str] = ("city", "host_type")) -> DataFrame:
    """Coefficient of variation, interquartile range and share of round tens."""
    by, price = list(by), F.col("price")
    base = df.groupBy(*by).agg(
        round_away(ratio(F.stddev_samp(price), F.avg(price)), 3).alias("cv"),
        round_away(share_true(price % 10 == 0), 3).alias("round_pricing"),
    )
    places = quantiles(df, by, "price", {"_q1": (0.25, NEAREST), "_q3": (0.75, NEAREST)})
    return attach(base, places, by).select(*by, "cv", (F.col("_q3") - F.col("_q1")).alias("iqr"), "round_pricing").orderBy(*by)


def outcomes(df: DataFrame, by: Sequence[str] = ("city", "host_type")) -> DataFrame:
    return medians(
        df, by,
        {
            "median_price": "price", "median_occ": "estimated_occupancy_l365d",
            "median_rev": "estimated_revenue_l365d", "median_minnights": "minimum_nights",
        },
    ).orderBy(*by)


# ---- demand -------------------------------------------------------------


def implied_bookings(df: DataFrame, review_rate: float = 0.5) -> DataFrame:
    """Bookings per month if this share of stays leaves a review."""
    known = df.dropna(subset=["reviews_per_month", "estimated_occupancy_l365d"])
    return known.withColumn("implied_bookings_pm", F.col("reviews_per_month") / F.lit(review_rate))


def demand_by_room(df: DataFrame) -> DataFrame:
    known = df.where(F.col("reviews_per_month").isNotNull())
    return grouped(
        known, ["city", "room_type"], [rows("n")], {"median_rpm": "reviews_per_month", "median_price": "price"}
    ).orderBy("city", F.desc("median_rpm"), "room_type")


def demand_curve(df: DataFrame, width: float = 50.0, min_n: int = 10, probability: float = 0.99) -> DataFrame:
    """Median reviews per month by price band below the top prices."""
    known = below_quantile(df, "price", probability).where(F.col("reviews_per_month").isNotNull())
    banded = known.withColumn("price_band", band(F.col("price"), width))
    return (
        grouped(banded, ["city", "price_band"], [rows("n")], {"median_rpm": "reviews_per_month"})
        .where(F.col("n") >= min_n)
        .orderBy("city", "price_band")
    )


def demand_flags(df: DataFrame) -> DataFrame:
    """Shares of listings in low demand, also with little availability or long stays."""
    low = F.col("reviews_per_month") < 0.2
    blocked = F.col("availability_365") < 30
    long_stay = F.col("minimum_nights") >= 7
    return (
        df.where(F.col("reviews_per_month").isNotNull())
        .groupBy("city")
        .agg(
            round_away(share_true(low), 3).alias("share_low_demand"),
            round_away(share_true(low & blocked), 3).alias("low_but_blocked"),
            round_away(share_true(low & long_stay), 3).alias("low_but_longstay"),
        )
    )
