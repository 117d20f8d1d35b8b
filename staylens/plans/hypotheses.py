"""The five standing hypotheses H1-H5 over the warehouse tables, as result tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, functions as F

from staylens.functions.numbers import day_type
from staylens.operators import market, stats

Tables = Mapping[str, DataFrame]


def dearer_rooms(t: Tables, one: str = "Entire home/apt", other: str = "Private room") -> DataFrame:
    """H1: listings of one room type cost more than those of another."""
    rows = market.listing_star(t, "dim_room_type").select("room_type", "price")
    return stats.two_group_test(rows, "price", "room_type", one, other, "greater", log=True)


def superhost_ratings(t: Tables) -> DataFrame:
    """H2: superhosts are rated higher."""
    rows = market.listing_star(t, "dim_host").select("host_is_superhost", "review_scores_rating")
    return stats.two_group_test(rows, "review_scores_rating", "host_is_superhost", True, False, "greater")


def busy_listing_prices(t: Tables, reviews: int = 10) -> DataFrame:
    """H3: listings with more reviews than this are priced differently."""
    rows = t["fact_listing"].select("price", (F.col("number_of_reviews") > reviews).alias("busy"))
    return stats.two_group_test(rows, "price", "busy", True, False, log=True)


def neighbourhood_prices(t: Tables) -> DataFrame:
    """H4: prices differ between neighbourhoods of at least 30 priced listings."""
    rows = market.listing_star(t, "dim_neighbourhood").select("neighbourhood", "price")
    return stats.k_group_test(rows, "price", "neighbourhood")


def weekend_availability(t: Tables) -> DataFrame:
    """H5: availability differs between weekend and weekdays."""
    days = t["fact_calendar"].join(F.broadcast(t["dim_date"].select("date_key", "date")), "date_key")
    typed = days.select("available", day_type(F.col("date")).alias("daytype"))
    return stats.two_proportion_test(typed, "available", "daytype", "weekend", "weekday")


HYPOTHESES: dict[str, Callable[[Tables], DataFrame]] = {
    "h1_dearer_rooms": dearer_rooms,
    "h2_superhost_ratings": superhost_ratings,
    "h3_busy_listing_prices": busy_listing_prices,
    "h4_neighbourhood_prices": neighbourhood_prices,
    "h5_weekend_availability": weekend_availability,
}
