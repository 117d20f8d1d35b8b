"""Review, neighbourhood and host measures joined onto clean listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from staylens.functions.numbers import per_month, per_unit, ratio, round_even, tenure_years
from staylens.functions.parsing import money, num, parse_date
from staylens.operators.order import grouped
from staylens.operators.quality import as_number, union_all

NEIGHBOURHOOD = ("city_key", "neighbourhood_std")


def review_summary(reviews: DataFrame, key: str = "listing_id", date: str = "date", by: Sequence[str] = ()) -> DataFrame:
    """Dated reviews per listing with the first, the last and the days between."""
    day = F.col(date).cast("date")
    return (
        reviews.where(F.col(key).isNotNull())
        .groupBy(*by, key)
        .agg(F.count(day).alias("rev_count"), F.min(day).alias("rev_first"), F.max(day).alias("rev_last"))
        .withColumn("rev_span_days", F.datediff("rev_last", "rev_first"))
    )


def group_profile(listings: DataFrame, keys: Sequence[str] = NEIGHBOURHOOD, id: str = "id") -> DataFrame:
    """Count, median price, mean rating and reviews per neighbourhood, and its
    share of the listings of its city (the first key)."""
    known = listings.dropna(subset=list(keys))
    profile = grouped(
        known,
        keys,
        [
            F.count(id).alias("nb_listing_count"),
            F.avg("review_scores_rating").alias("_rating"),
            F.avg("number_of_reviews").alias("nb_avg_reviews"),
        ],
        {"_price": "price"},
    )
    city = Window.partitionBy(keys[0])
    share = ratio(F.col("nb_listing_count"), F.sum("nb_listing_count").over(city)) * 100
    return profile.select(
        *keys,
        "nb_listing_count",
        round_even(F.col("_price"), 2).alias("nb_median_price"),
        round_even(F.col("_rating"), 3).alias("nb_avg_rating"),
        "nb_avg_reviews",
        round_even(share, 2).alias("nb_density_pct"),
    )


def official_estimates(df: DataFrame) -> DataFrame:
    """Published occupancy and revenue estimates as numbers, money text allowed."""
    kinds = {"estimated_occupancy_l365d": num, "estimated_revenue_l365d": money}
    for name, kind in kinds.items():
        if name in df.columns:
            df = df.withColumn(name, as_number(df, name, kind))
    return df


def derived_measures(df: DataFrame) -> DataFrame:
    have = set(df.columns)
    if {"host_since", "snapshot_date"} <= have:
        since, anchor = F.col("host_since"), F.col("snapshot_date")
        if dict(df.dtypes)["snapshot_date"] == "string":
            anchor = parse_date(anchor)
        df = df.withColumn("host_tenure_years", tenure_years(since, anchor))
    if {"rev_count", "rev_span_days"} <= have:
        df = df.withColumn("review_frequency_pm", per_month(F.col("rev_count"), F.col("rev_span_days")))
    if {"price", "bedrooms_filled"} <= have:
        df = df.withColumn("price_per_bedroom", per_unit(F.col("price"), F.col("bedrooms_filled")))
    return df


def with_reviews(listings: DataFrame, reviews: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Left join of the review summary; listings without reviews keep nulls.

    Reviews are combined per listing before the shuffle, so the join sees one
    row per listing on both sides.
    """
    summary = review_summary(reviews, by=by).withColumnRenamed("listing_id", "id")
    return listings.join(summary, [*by, "id"], "left")


def with_neighbourhoods(listings: DataFrame, keys: Sequence[str] = NEIGHBOURHOOD) -> DataFrame:
    return listings.join(group_profile(listings, keys), list(keys), "left")


def build_master(listings: DataFrame, reviews: DataFrame) -> DataFrame:
    """One plan for all cities: reviews, estimates, derived measures, neighbourhoods.

    The snapshot columns are part of both keys when the inputs carry them, so
    several snapshots never mix.
    """
    shared = [c for c in ("city_key", "snapshot_date") if c in listings.columns and c in reviews.columns]
    base = derived_measures(official_estimates(with_reviews(listings, reviews, shared)))
    if "snapshot_date" not in base.columns:
        return with_neighbourhoods(base)
    profile = snapshot_profile(base)
    return base.join(profile, ["city_key", "snapshot_date", "neighbourhood_std"], "left")


def snapshot_profile(base: DataFrame) -> DataFrame:
    """Neighbourhood measures of each city snapshot."""
    marked = base.withColumn("_city", F.struct("city_key", "snapshot_date"))
    profile = group_profile(marked, ["_city", "neighbourhood_std"])
    return profile.select("_city.city_key", "_city.snapshot_date", *profile.columns[1:])


def unify(frames: Sequence[DataFrame]) -> DataFrame:
    """Masters of several cities under the sorted union of their columns."""
    return union_all(frames)
