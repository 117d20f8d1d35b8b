"""Raw text snapshots to typed, standardised rows; rejected rows keep their reason."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from staylens.config import ROOM_TYPES, SUBSCORES
from staylens.functions.numbers import round_even
from staylens.functions.parsing import boolean, canonical, money, num, parse_date, percent, strip, whole
from staylens.functions.text import before_comma, family, tidy_words
from staylens.operators.order import attach, medians
from staylens.operators.quality import ROW_ID

SNAPSHOT = ("city_key", "snapshot_date")

# Columns coerced to numbers.
NUMERIC_COLUMNS = (
    "accommodates", "bedrooms", "beds", "minimum_nights", "maximum_nights",
    "number_of_reviews", "number_of_reviews_l30d", "number_of_reviews_ltm",
    "number_of_reviews_ly", *SUBSCORES, "review_scores_rating",
    "availability_30", "availability_60", "availability_90",
    "availability_365", "availability_eoy", "host_listings_count",
    "host_total_listings_count", "calculated_host_listings_count",
    "calculated_host_listings_count_entire_homes",
    "calculated_host_listings_count_private_rooms",
    "calculated_host_listings_count_shared_rooms",
    "estimated_occupancy_l365d", "estimated_revenue_l365d",
    "maximum_maximum_nights", "maximum_nights_avg_ntm",
    "minimum_maximum_nights", "minimum_minimum_nights",
    "minimum_nights_avg_ntm", "price_quote_price_per_night",
    "price_quote_total_price",
)
# Date, flag and median-filled columns.
DATE_COLUMNS = ("host_since", "first_review", "last_review", "last_scraped")
FLAG_COLUMNS = ("host_is_superhost", "host_identity_verified")
FILLED_COLUMNS = ("bedrooms", "beds")


def standard_columns(df: DataFrame, places: int = 6) -> DataFrame:
    """Every parser in one projection; columns that are absent are skipped.
    Coordinates are rounded to `places`."""
    have = set(df.columns)
    parsed: dict[str, Column] = {}
    for name in ("id", "host_id"):
        parsed[name] = whole(F.col(name))
    parsed["price"] = money(F.col("price"))
    for name in NUMERIC_COLUMNS:
        parsed[name] = num(F.col(name))
    parsed["reviews_per_month"] = F.coalesce(num(F.col("reviews_per_month")), F.lit(0.0))
    parsed["host_response_rate"] = percent(F.col("host_response_rate"))
    for name in DATE_COLUMNS:
        parsed[name] = parse_date(F.col(name))
    for name in FLAG_COLUMNS:
        parsed[name] = F.coalesce(boolean(F.col(name)), F.lit(False))
    parsed["room_type"] = canonical(F.col("room_type"), ROOM_TYPES)
    for name in ("latitude", "longitude"):
        parsed[name] = round_even(num(F.col(name)), places)
    added: dict[str, Column] = {
        f"{name}_missing": F.col(name).isNull() for name in FLAG_COLUMNS if name in have
    }
    if "property_type" in have:
        added["property_type_clean"] = tidy_words(F.col("property_type"))
        added["property_family"] = family(tidy_words(F.col("property_type")))
    if "neighbourhood_cleansed" in have:
        added["neighbourhood_std"] = before_comma(F.col("neighbourhood_cleansed"))
    return df.select(
        *[parsed[c].alias(c) if c in parsed else F.col(c) for c in df.columns],
        *[c.alias(n) for n, c in added.items()],
    )


def median_fill(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """`<c>_imputed` and `<c>_filled` with the group's exact median; the source stays."""
    middle = medians(df, by, {f"_median_{c}": c for c in columns})
    filled = attach(df, middle, list(by)).select(
        *df.columns,
        *[F.col(c).isNull().alias(f"{c}_imputed") for c in columns],
        *[F.coalesce(F.col(c), F.col(f"_median_{c}")).alias(f"{c}_filled") for c in columns],
    )
    return filled


def reject_reason(
    prices: tuple[float, float] = (0.0, 50_000.0), latitudes: tuple[float, float] = (-90.0, 90.0),
    longitudes: tuple[float, float] = (-180.0, 180.0),
) -> Column:
    """Reasons in a fixed order; a null price passes, null coordinates do not."""
    price, lat, lon = F.col("price"), F.col("latitude"), F.col("longitude")
    rules = (
        ("bad_price;", price <= prices[0]),
        ("price_over_max;", price > prices[1]),
        ("bad_latitude;", lat.isNull() | ~lat.between(*latitudes)),
        ("bad_longitude;", lon.isNull() | ~lon.between(*longitudes)),
    )
    return F.concat(*[F.when(rule, name).otherwise("") for name, rule in rules])


def gated_listings(df: DataFrame, by: Sequence[str] = SNAPSHOT) -> DataFrame:
    """All rows, typed, with `reject_reason` ("" for good rows). The fill medians
    are those of the whole city snapshot, rejected rows included."""
    typed = standard_columns(df)
    fill = [c for c in FILLED_COLUMNS if c in df.columns]
    filled = median_fill(typed, by, fill) if fill else typed
    return filled.withColumn("reject_reason", reject_reason())


def accepted(gated: DataFrame, by: Sequence[str] = SNAPSHOT, order: str = ROW_ID) -> DataFrame:
    """Good rows, the first of each listing id per snapshot."""
    good = gated.where(F.col("reject_reason") == "").drop("reject_reason")
    # only keys and row numbers are shuffled to find the rows that repeat an id
    first = good.groupBy(*by, "id").agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_n"))
    later = attach(good.select(*by, "id", order), first.where("_n > 1"), [*by, "id"], "inner").where(
        F.col(order) > F.col("_first")
    )
    return good.join(later.select(F.col(order).alias("_later")), F.col(order) == F.col("_later"), "left_anti")


def rejected(gated: DataFrame) -> DataFrame:
    return gated.where(F.col("reject_reason") != "")


def repeats_removed(gated: DataFrame, by: Sequence[str] = SNAPSHOT) -> DataFrame:
    """How many good rows repeat an earlier id of their snapshot."""
    good = gated.where(F.col("reject_reason") == "")
    groups = good.groupBy(*by, "id").agg((F.count(F.lit(1)) - 1).alias("_extra"))
    return groups.groupBy(*by).agg(F.sum("_extra").alias("pk_duplicates_removed"))


def clean_calendar(df: DataFrame) -> DataFrame:
    """Typed calendar days; rows without a listing or a date are dropped."""
    parsed = {
        "date": parse_date(F.col("date")),
        "available": boolean(F.col("available")),
        "price": money(F.col("price")),
        "adjusted_price": money(F.col("adjusted_price")),
        "minimum_nights": num(F.col("minimum_nights")),
        "maximum_nights": num(F.col("maximum_nights")),
        "listing_id": whole(F.col("listing_id")),
    }
    return df.select(
        *[parsed[c].alias(c) if c in parsed else F.col(c) for c in df.columns]
    ).dropna(subset=["listing_id", "date"])


def typed_reviews(df: DataFrame) -> DataFrame:
    """Review rows with a typed listing and date; bad ones become null, none is dropped."""
    return df.withColumn("listing_id", whole(F.col("listing_id"))).withColumn("date", parse_date(F.col("date")))
