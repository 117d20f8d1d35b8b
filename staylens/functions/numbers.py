"""Rounding, bands, buckets, dates as numbers and distances."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EARTH_KM = 6371.0


def round_even(c: Column, places: int) -> Column:
    """Half to even on the binary value, as array libraries round."""
    scale = float(10**places)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def round_away(c: Column, places: int) -> Column:
    """Half away from zero on the binary value, as SQL engines round doubles."""
    scale = float(10**places)
    return F.signum(c) * F.floor(F.abs(c) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def to_int(c: Column) -> Column:
    """Measure stored as INTEGER: half to even, never truncated."""
    return F.rint(c).try_cast("int")


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is zero."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both are known; null, not an error,
    when one of them does not vary."""
    x, y = x.cast("double"), y.cast("double")
    both = x.isNotNull() & y.isNotNull()
    spread = F.var_pop(F.when(both, x)) * F.var_pop(F.when(both, y))
    covariance = F.covar_pop(x, y)
    return covariance / F.nullif(F.sqrt(spread), F.lit(0.0))


def band(c: Column, width: float) -> Column:
    """Lower edge of the band of this width that holds the value."""
    return F.floor(c / F.lit(float(width))).cast("double") * F.lit(float(width))


def date_key(d: Column) -> Column:
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def tenure_years(since: Column, anchor: Column) -> Column:
    """Years up to the row's own snapshot, 2 places; what is below zero after
    rounding gives null, so a start one day later still counts as zero."""
    years = round_even(F.datediff(anchor, since) / F.lit(365.25), 2) + F.lit(0.0)
    return F.when(years >= 0, years)


def tenure_years_calendar(since: Column, anchor: Column) -> Column:
    """Years by 365-day years up to four of them, 365.25 beyond; signs kept."""
    days = F.datediff(anchor, since)
    return round_away(days / F.when(days > 1460, F.lit(365.25)).otherwise(F.lit(365.0)), 2)


def per_month(count: Column, span_days: Column) -> Column:
    return round_even(ratio(count, span_days / F.lit(30.44)), 3)


def per_unit(amount: Column, units: Column) -> Column:
    return round_even(ratio(amount, units), 2)


def tenure_bucket(years: Column) -> Column:
    return (
        F.when(years < 3, "0-3y").when(years < 6, "3-6y").when(years < 10, "6-10y").otherwise("10y+")
    )


def host_segment(n: Column) -> Column:
    return (
        F.when(n == 1, "Single (1)")
        .when(n <= 3, "Small (2-3)")
        .when(n <= 9, "Multi (4-9)")
        .otherwise("Commercial (10+)")
    )


def host_type(n: Column) -> Column:
    return F.when(n == 1, "Casual").otherwise("Professional")


def day_type(d: Column) -> Column:
    return F.when(F.weekday(d) + 1 >= 6, "weekend").otherwise("weekday")


def period(year: Column, month: Column) -> Column:
    return F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"))


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance by the haversine formula."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    square = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.when(square > 1.0, 1.0).otherwise(square)))


def bucket_of(c: Column, per_e: int = 16_384) -> Column:
    """A whole number that never falls as the value rises.

    Each bucket spans a constant ratio of about 1.00006 at every magnitude, shares and
    prices alike, so values within a factor of a million lie in at most 230,000 of
    them however many there are. Order statistics use it as a first cut of one group's
    values into slices that different tasks can handle.
    """
    x = c.cast("double")
    # the logarithm of the smallest double is -744.5, that of the largest 709.8
    size = F.floor((F.least(F.ln(F.abs(x)), F.lit(710.0)) + F.lit(750.0)) * F.lit(float(per_e))) + 1
    return F.when(x == 0, 0).when(x < 0, -size).otherwise(size).cast("long")
