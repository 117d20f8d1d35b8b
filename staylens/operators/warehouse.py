"""Star schema: dimensions with dense keys, facts, key checks and row counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from staylens.config import SUBSCORES, City
from staylens.functions.numbers import date_key, to_int
from staylens.functions.parsing import parse_date
from staylens.functions.text import title_segment
from staylens.operators.order import attach, dense_keys, keep_first
from staylens.operators.quality import ROW_ID, missing_parents, stack

# Columns and types of the nine tables, in load order.
TABLES: dict[str, str] = {
    "dim_city": "city_key string, display_name string, country string, region string",
    "dim_date": "date_key int, date date, year int, quarter int, month int, day int",
    "dim_host": (
        "host_sk bigint, host_id bigint, host_name string, host_since date, host_is_superhost boolean, "
        "host_identity_verified boolean, host_listings_count int, host_tenure_years double"
    ),
    "dim_neighbourhood": (
        "neighbourhood_sk bigint, city_key string, neighbourhood string, nb_listing_count int, "
        "nb_median_price double, nb_avg_rating double, nb_density_pct double"
    ),
    "dim_property": "property_sk bigint, property_type_clean string, property_family string",
    "dim_room_type": "room_type_sk bigint, room_type string",
    "fact_listing": (
        "listing_id bigint, snapshot_date_key int, city_key string, host_sk bigint, neighbourhood_sk bigint, "
        "property_sk bigint, room_type_sk bigint, price double, price_per_bedroom double, accommodates int, "
        "minimum_nights int, number_of_reviews int, reviews_per_month double, review_scores_rating double, "
        "availability_365 int, estimated_occupancy_l365d int, estimated_revenue_l365d double, "
        "review_frequency_pm double, " + ", ".join(f"{c} double" for c in SUBSCORES)
    ),
    "fact_calendar": "listing_id bigint, date_key int, city_key string, available boolean, minimum_nights int",
    "fact_review": "review_sk bigint, listing_id bigint, city_key string, date_key int",
}
# Primary keys and references.
PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "dim_city": ("city_key",),
    "dim_date": ("date_key",),
    "dim_host": ("host_sk",),
    "dim_neighbourhood": ("neighbourhood_sk",),
    "dim_property": ("property_sk",),
    "dim_room_type": ("room_type_sk",),
    "fact_listing": ("listing_id", "snapshot_date_key"),
    "fact_review": ("review_sk",),
}
FOREIGN_KEYS: tuple[tuple[str, str, str, str], ...] = (
    ("dim_neighbourhood", "city_key", "dim_city", "city_key"),
    ("fact_listing", "snapshot_date_key", "dim_date", "date_key"),
    ("fact_listing", "city_key", "dim_city", "city_key"),
    ("fact_listing", "host_sk", "dim_host", "host_sk"),
    ("fact_listing", "neighbourhood_sk", "dim_neighbourhood", "neighbourhood_sk"),
    ("fact_listing", "property_sk", "dim_property", "property_sk"),
    ("fact_listing", "room_type_sk", "dim_room_type", "room_type_sk"),
    ("fact_calendar", "date_key", "dim_date", "date_key"),
    ("fact_calendar", "city_key", "dim_city", "city_key"),
    ("fact_review", "city_key", "dim_city", "city_key"),
    ("fact_review", "date_key", "dim_date", "date_key"),
)


def fields_of(table: str) -> list[tuple[str, str]]:
    return [tuple(f.strip().split(" ")) for f in TABLES[table].split(",")]


def in_schema(df: DataFrame, table: str) -> DataFrame:
    """Columns in table order and type; absent ones null, whole numbers half to even."""
    def column(name: str, kind: str) -> Column:
        if name not in df.columns:
            return F.lit(None).cast(kind)
        fractional = dict(df.dtypes)[name] in ("double", "float")
        return to_int(F.col(name)) if kind == "int" and fractional else F.col(name).cast(kind)

    return df.select(*[column(n, k).alias(n) for n, k in fields_of(table)])


# ---- dimensions ---------------------------------------------------------


def city_table(master: DataFrame, cities: Sequence[City]) -> DataFrame:
    """Configured cities that occur in the data."""
    rows = [(c.key, c.display, c.slug) for c in cities]
    lookup = master.sparkSession.createDataFrame(rows, "city_key string, display_name string, slug string")
    present = master.select("city_key").distinct()
    return lookup.join(present, "city_key", "left_semi").select(
        "city_key",
        "display_name",
        title_segment(F.col("slug"), 1).alias("country"),
        title_segment(F.col("slug"), 2).alias("region"),
    )


def host_table(master: DataFrame, order: Sequence[str] = (ROW_ID, "city_key")) -> DataFrame:
    """One row per host, null included: the attributes of its first listing."""
    columns = [n for n, _ in fields_of("dim_host") if n in master.columns]
    firsts = keep_first(master.select(*dict.fromkeys([*columns, *order])), ["host_id"], order)
    return dense_keys(firsts.select(*columns), ["host_id"], "host_sk")


def neighbourhood_table(master: DataFrame, order: str = ROW_ID) -> DataFrame:
    measures = ["nb_listing_count", "nb_median_price", "nb_avg_rating", "nb_density_pct"]
    keys = ["city_key", "neighbourhood_std"]
    firsts = keep_first(master.select(*keys, *measures, order), keys, [order])
    return dense_keys(
        firsts.select("city_key", F.col("neighbourhood_std").alias("neighbourhood"), *measures),
        ["city_key", "neighbourhood"],
        "neighbourhood_sk",
    )


def value_table(master: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Distinct combinations of columns under a dense key."""
    return dense_keys(master.select(*columns).distinct(), list(columns), key)


def date_table(columns: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Distinct valid dates of all the (frame, column) pairs with their parts."""
    def days(df: DataFrame, name: str) -> DataFrame:
        text = dict(df.dtypes)[name] == "string"
        value = parse_date(F.col(name)) if text else F.col(name).cast("date")
        return df.select(value.alias("date")).distinct()

    every = reduce(lambda a, b: a.union(b), [days(df, name) for df, name in columns])
    day = F.col("date")
    return every.where(day.isNotNull()).distinct().select(
        date_key(day).alias("date_key"), day, F.year(day).alias("year"), F.quarter(day).alias("quarter"),
        F.month(day).alias("month"), F.dayofmonth(day).alias("day"),
    )


def build_dims(master: DataFrame, calendar: DataFrame, reviews: DataFrame, cities: Sequence[City]) -> dict[str, DataFrame]:
    dims = {
        "dim_city": city_table(master, cities),
        "dim_date": date_table([(master, "snapshot_date"), (calendar, "date"), (reviews, "date")]),
        "dim_host": host_table(master),
        "dim_neighbourhood": neighbourhood_table(master),
        "dim_property": value_table(master, ["property_type_clean", "property_family"], "property_sk"),
        "dim_room_type": value_table(master, ["room_type"], "room_type_sk"),
    }
    return {name: in_schema(df, name) for name, df in dims.items()}


# ---- facts --------------------------------------------------------------


def lookup(df: DataFrame, dim: DataFrame, key: str, on: Mapping[str, str]) -> DataFrame:
    """Attach a surrogate key; `on` maps fact to dimension columns, null matches null."""
    slim = dim.select(key, *[F.col(d).alias(f) for f, d in on.items()])
    return attach(df, slim, list(on))


def listing_facts(master: DataFrame, dims: Mapping[str, DataFrame], order: str = ROW_ID) -> DataFrame:
    facts = master.withColumn("snapshot_date_key", date_key(parse_date(F.col("snapshot_date"))))
    facts = lookup(facts, dims["dim_host"], "host_sk", {"host_id": "host_id"})
    facts = lookup(
        facts, dims["dim_neighbourhood"], "neighbourhood_sk",
        {"city_key": "city_key", "neighbourhood_std": "neighbourhood"},
    )
    facts = lookup(
        facts, dims["dim_property"], "property_sk",
        {"property_type_clean": "property_type_clean", "property_family": "property_family"},
    )
    facts = lookup(facts, dims["dim_room_type"], "room_type_sk", {"room_type": "room_type"})
    facts = facts.withColumnRenamed("id", "listing_id")
    wanted = [n for n, _ in fields_of("fact_listing") if n in facts.columns]
    firsts = keep_first(facts.select(*wanted, order), ["listing_id", "snapshot_date_key"], [order, "city_key"])
    return in_schema(firsts, "fact_listing")


def calendar_facts(calendar: DataFrame) -> DataFrame:
    """One row per calendar row; repeated days stay."""
    keyed = calendar.withColumn("date_key", date_key(F.col("date").cast("date")))
    return in_schema(keyed, "fact_calendar").dropna(subset=["listing_id", "date_key"])


def review_facts(reviews: DataFrame, order: Sequence[str] = (ROW_ID, "city_key")) -> DataFrame:
    """Keys are given to all reviews in stored order before bad rows are dropped."""
    numbered = dense_keys(
        reviews.select(*dict.fromkeys(["listing_id", "city_key", "date", *order])), list(order), "review_sk"
    )
    keyed = numbered.withColumn("date_key", date_key(F.col("date").cast("date")))
    return in_schema(keyed, "fact_review").dropna(subset=["listing_id", "date_key"])


def build_facts(
    master: DataFrame, calendar: DataFrame, reviews: DataFrame, dims: Mapping[str, DataFrame]
) -> dict[str, DataFrame]:
    return {
        "fact_listing": listing_facts(master, dims),
        "fact_calendar": calendar_facts(calendar),
        "fact_review": review_facts(reviews),
    }


# ---- checks -------------------------------------------------------------


def primary_key_violations(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Rows with a null key and rows that repeat a key, as one row."""
    key_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum(F.when(key_null, F.col("_n"))), F.lit(0)).alias("null_keys"),
        F.coalesce(F.sum(F.when(~key_null, F.col("_n") - 1)), F.lit(0)).alias("repeated_keys"),
    ).select(F.lit(table).alias("table"), F.lit("+".join(keys)).alias("key"), "null_keys", "repeated_keys")


def foreign_key_violations(child: DataFrame, table: str, column: str, parent: DataFrame, parent_table: str, key: str) -> DataFrame:
    """Distinct child values without a parent, as one row; null is allowed."""
    return missing_parents(child, column, parent, key).agg(F.count(F.lit(1)).alias("orphans")).select(
        F.lit(table).alias("table"), F.lit(column).alias("column"),
        F.lit(parent_table).alias("references_table"), "orphans",
    )


def key_checks(tables: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    primary = [primary_key_violations(tables[t], t, k) for t, k in PRIMARY_KEYS.items() if t in tables]
    foreign = [
        foreign_key_violations(tables[t], t, c, tables[p], p, k)
        for t, c, p, k in FOREIGN_KEYS
        if t in tables and p in tables
    ]
    return stack(primary), stack(foreign)


def require_keys(tables: Mapping[str, DataFrame]) -> None:
    """Raise with the offending keys unless all primary and foreign keys hold."""
    primary, foreign = key_checks(tables)
    bad = [r.asDict() for r in primary.where("null_keys > 0 or repeated_keys > 0").collect()]
    bad += [r.asDict() for r in foreign.where("orphans > 0").collect()]
    for entry in bad:
        table = tables[entry["table"]]
        if "orphans" in entry:
            _, column, parent, key = next(
                f for f in FOREIGN_KEYS if f[0] == entry["table"] and f[1] == entry["column"]
            )
            rows = missing_parents(table, column, tables[parent], key)
        else:
            keys = PRIMARY_KEYS[entry["table"]]
            rows = table.groupBy(*keys).count().where(
                (F.col("count") > 1) | reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
            )
        entry["sample"] = [r.asDict() for r in rows.limit(3).collect()]
    if bad:
        raise ValueError(f"key constraints do not hold: {bad}")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return stack(
        [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows") for n, df in tables.items()]
    )
