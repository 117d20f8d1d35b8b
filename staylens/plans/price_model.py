"""The price model over the clean listings: model table, validation, final fit."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from staylens.functions.parsing import num
from staylens.operators import features, models
from staylens.operators.quality import ROW_ID

# Columns that describe a listing and are no features.
DESCRIPTIVE = (
    "city_key", "snapshot_date", "listing_url", "scrape_id", "last_scraped", "source", "name", "description",
    "picture_url", "host_url", "host_profile_id", "host_id", "host_name",
)
# Columns that repeat others or say what the price is.
REDUNDANT = (
    "hosts_time_as_user_years", "hosts_time_as_user_months", "hosts_time_as_host_months", "host_is_superhost_missing",
    "bathrooms_text", "has_availability", "host_location", "host_has_profile_pic", "maximum_minimum_nights",
    "calendar_last_scraped", "beds_filled", "bedrooms_filled", "price_quote_checkin_date", "price_quote_checkout_date",
    "first_review", "last_review", "price_quote_raw", "host_picture_url", "host_about", "price_quote_total_price",
    "price_quote_price_per_night",
)
# Text columns that hold numbers, and the columns filled with a median.
NUMERIC_TEXT = ("bathrooms", "hosts_time_as_host_years")
FILLED = ("bedrooms", "beds", "bathrooms")


@dataclass(frozen=True)
class ModelTable:
    """Rows with the key, the price and the features, and the features' names."""

    rows: DataFrame
    names: tuple[str, ...]
    values: Mapping[str, list[str]]


def model_table(listings: DataFrame, key: str = "id") -> ModelTable:
    """Columns that are mostly missing or say little about the price are dropped, the
    rest become numbers, filled columns with their flags, sparse indicators and amenity
    flags. Rows without a price are left out."""
    order = [c for c in (ROW_ID,) if c in listings.columns]
    kept = features.prune_nulls(listings.drop(*order))
    weak = set(features.weak_columns(kept, "price")) - {key, *FILLED}
    kept = kept.drop(*weak, *DESCRIPTIVE, *REDUNDANT).where(F.col("price").isNotNull())
    for c in NUMERIC_TEXT:
        if dict(kept.dtypes).get(c) == "string":
            kept = kept.withColumn(c, num(F.col(c)))
    if "license" in kept.columns:
        kept = features.licence_flag(kept)
    kept = features.fill_medians(kept, [c for c in FILLED if c in kept.columns])
    if "amenities" in kept.columns:
        kept = features.amenity_flags(kept)
    encoded, values = features.encode(kept)
    usable = {"double", "float", "int", "bigint", "smallint", "boolean", "vector"}
    names = tuple(c for c, kind in encoded.dtypes if kind in usable and c not in (key, "price"))
    # a gap that is left in a numeric column would drop the row: it is 0
    plain = [c for c in names if dict(encoded.dtypes)[c] != "vector"]
    whole = encoded.select(
        key, "price", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in plain],
        *[c for c in names if c not in plain],
    )
    return ModelTable(whole, names, values)


def price_model(
    listings: DataFrame, key: str = "id", candidates: Mapping[str, models.Model] | None = None,
    final: models.Model = models.boosted, folds: int = 5,
) -> dict[str, DataFrame]:
    """Cross-validated errors on the training part, and the final model's errors on the
    held-out part."""
    table = model_table(listings, key)
    rows = models.assemble(table.rows, table.names, "price", key).persist()
    train, test = models.split(rows, key)
    scores = models.cross_validate(train, key, candidates or models.standard_models(), folds)
    fitted = final().fit(train)
    held_out = models.errors(fitted.transform(test))
    rows.unpersist()
    return {"model_scores": scores, "model_held_out": held_out}
