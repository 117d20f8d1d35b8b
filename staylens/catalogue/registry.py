"""Registration, and the views that give driver tables rental-market columns.

A view is a list of SQL expressions that both engines accept; only the operator
under test differs between a query and its SQL form.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from staylens.functions.numbers import round_away

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

LISTING = {
    "id": "o_orderkey",
    "_row_id": "o_orderkey",
    "host_id": "CASE WHEN o_custkey % 41 = 7 THEN NULL ELSE o_custkey END",
    "host_name": "c_name",
    "city_key": "lower(r_name)",
    "city": "r_name",
    "snapshot_date": "'2024-06-15'",
    "neighbourhood": "n_name",
    "neighbourhood_std": "n_name",
    "room_type": "o_orderpriority",
    "property_type_clean": "concat(o_orderstatus, ' ', c_mktsegment)",
    "property_family": "o_orderstatus",
    "price": "CASE WHEN o_orderkey % 17 = 3 THEN NULL ELSE o_totalprice END",
    "bedrooms": "CASE WHEN o_orderkey % 6 = 5 THEN NULL ELSE CAST(o_orderkey % 6 AS DOUBLE) END",
    "accommodates": "CAST(o_orderkey % 9 + 1 AS DOUBLE)",
    "number_of_reviews": "CAST((o_orderkey * 31) % 53 AS DOUBLE)",
    "reviews_per_month": "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE ((o_orderkey * 29) % 47) / 10e0 END",
    "review_scores_rating": "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 3e0 + ((o_orderkey * 37) % 41) / 20e0 END",
    "review_scores_accuracy": "CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE 3e0 + ((o_orderkey * 3) % 21) / 10e0 END",
    "review_scores_cleanliness": "3e0 + ((o_orderkey * 5) % 19) / 10e0",
    "review_scores_checkin": "3e0 + ((o_orderkey * 7) % 17) / 10e0",
    "review_scores_communication": "3e0 + ((o_orderkey * 11) % 20) / 10e0",
    "review_scores_location": "3e0 + ((o_orderkey * 13) % 18) / 10e0",
    "review_scores_value": "3e0 + ((o_orderkey * 17) % 16) / 10e0",
    "availability_365": "CAST((o_orderkey * 41) % 366 AS DOUBLE)",
    "minimum_nights": "CAST((o_orderkey * 23) % 14 + 1 AS DOUBLE)",
    "estimated_occupancy_l365d": "CAST((o_orderkey * 43) % 256 AS DOUBLE)",
    "estimated_revenue_l365d": "CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE CAST((o_orderkey * 7919) % 100000 AS DOUBLE) END",
    "host_since": "DATE '2006-01-01' + CAST((o_custkey * 37) % 7000 AS INTEGER)",
    "host_is_superhost": "o_custkey % 5 = 0",
    "host_identity_verified": "o_custkey % 3 <> 0",
    "latitude": "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE n_regionkey * 15e0 - 30e0 + ((o_orderkey * 7919) % 3001) / 10000e0 END",
    "longitude": "n_regionkey * 5e0 + 100e0 + ((o_orderkey * 104729) % 4001) / 10000e0",
}
LISTING_FROM = (
    "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey "
    "JOIN region ON n_regionkey = r_regionkey"
)

CALENDAR = {
    "listing_id": "l_orderkey",
    "city": "r_name",
    "city_key": "lower(r_name)",
    "date": "CAST(l_shipdate AS DATE)",
    "year": "CAST(year(l_shipdate) AS INTEGER)",
    "month": "CAST(month(l_shipdate) AS INTEGER)",
    "available": "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_returnflag <> 'R' END",
    "minimum_nights": "CASE WHEN l_linenumber = 6 THEN NULL ELSE CAST((l_orderkey * 5 + l_linenumber) % 15 AS DOUBLE) END",
}
CALENDAR_FROM = (
    "lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey "
    "JOIN region ON n_regionkey = r_regionkey"
)

REVIEW = {
    "id": "event_id",
    "_row_id": "event_id",
    "listing_id": "CASE WHEN event_id % 50 = 7 THEN NULL ELSE user_id END",
    "city_key": "event_type",
    "date": "CASE WHEN event_id % 40 = 3 THEN NULL ELSE CAST(ts AS DATE) END",
}

RAW = {
    "_row_id": "o_orderkey",
    "id": "CAST(o_orderkey AS STRING)",
    "price": (
        "CASE o_orderkey % 12 WHEN 0 THEN NULL WHEN 1 THEN 'n/a' WHEN 2 THEN '1d' WHEN 3 THEN '$-5' "
        "WHEN 4 THEN '$0.00' WHEN 5 THEN concat(' $1,', CAST(100 + o_orderkey % 900 AS STRING), '.50 ') "
        "WHEN 6 THEN 'NaN' ELSE concat('$', CAST(CAST(floor(o_totalprice / 7) AS BIGINT) AS STRING), '.25') END"
    ),
    "amount": (
        "CASE o_orderkey % 8 WHEN 0 THEN '1,000' WHEN 1 THEN ' 12 ' WHEN 2 THEN '3f' WHEN 3 THEN '.5' "
        "WHEN 4 THEN '1e3' WHEN 5 THEN '' ELSE CAST(o_orderkey % 1000 AS STRING) END"
    ),
    "day": (
        "CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '2021-02-30' WHEN 2 THEN 'soon' "
        "WHEN 3 THEN concat(CAST(year(o_orderdate) AS STRING), '/', CAST(month(o_orderdate) AS STRING), '/', CAST(day(o_orderdate) AS STRING)) "
        "ELSE concat(CAST(year(o_orderdate) AS STRING), '-', CAST(month(o_orderdate) AS STRING), '-', CAST(day(o_orderdate) AS STRING)) END"
    ),
    "rate": "CASE o_orderkey % 5 WHEN 0 THEN 'N/A' WHEN 1 THEN NULL ELSE concat(CAST(o_orderkey % 101 AS STRING), '%') END",
    "flag": (
        "CASE o_orderkey % 7 WHEN 0 THEN 't' WHEN 1 THEN ' TRUE ' WHEN 2 THEN 'f' WHEN 3 THEN 'False' "
        "WHEN 4 THEN 'maybe' WHEN 5 THEN NULL ELSE 'T' END"
    ),
    "room_type": (
        "CASE o_orderkey % 6 WHEN 0 THEN 'ENTIRE HOME/APT' WHEN 1 THEN ' Private room ' WHEN 2 THEN ' Tent ' "
        "WHEN 3 THEN NULL WHEN 4 THEN 'hotel Room' ELSE 'Shared room' END"
    ),
    "property_type": (
        "CASE o_orderkey % 7 WHEN 0 THEN 'Entire  Condominium' WHEN 1 THEN 'private room in home' "
        "WHEN 2 THEN 'Shared Room in hostel' WHEN 3 THEN 'Room in boutique HOTEL' WHEN 4 THEN NULL "
        "WHEN 5 THEN 'casa particular' ELSE 'entire villa' END"
    ),
    "place": (
        "CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN concat('  Old   Town ', CAST(o_orderkey % 30 AS STRING), ', City') "
        "ELSE concat('Ward ', CAST(o_orderkey % 40 AS STRING)) END"
    ),
    "license": (
        "CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'etv/1234' WHEN 2 THEN 'No ESFC 9' WHEN 3 THEN 'ETVX1' ELSE 'none' END"
    ),
    "latitude": "CASE o_orderkey % 23 WHEN 0 THEN NULL WHEN 1 THEN '91' WHEN 2 THEN 'x' ELSE CAST(o_orderkey % 80 AS STRING) END",
    "longitude": "CASE o_orderkey % 29 WHEN 0 THEN '-181.5' WHEN 1 THEN NULL ELSE CAST(o_orderkey % 170 AS STRING) END",
    "minimum_nights": "CASE o_orderkey % 31 WHEN 0 THEN '0' WHEN 1 THEN '1126' ELSE CAST(o_orderkey % 30 + 1 AS STRING) END",
    "status": "o_orderstatus",
    "constant": "'same'",
    "nothing": "CAST(NULL AS STRING)",
}


def view_sql(columns: dict[str, str], source: str) -> str:
    listed = ", ".join(f"{e} AS {n}" for n, e in columns.items())
    return f"SELECT {listed} FROM {source}"


VIEWS = {
    "listing": view_sql(LISTING, LISTING_FROM),
    "cal": view_sql(CALENDAR, CALENDAR_FROM),
    "review": view_sql(REVIEW, "events"),
    "raw": view_sql(RAW, "orders"),
    "geo": (
        "SELECT l.*, lat0, lon0, 12742e0 * asin(sqrt(least(1e0, "
        "pow(sin(radians(lat0 - latitude) / 2), 2) + cos(radians(latitude)) * cos(radians(lat0)) "
        "* pow(sin(radians(lon0 - longitude) / 2), 2)))) AS dist_km "
        "FROM listing l JOIN (SELECT city, median(latitude) AS lat0, median(longitude) AS lon0 FROM listing GROUP BY city) m "
        "USING (city) WHERE latitude IS NOT NULL AND longitude IS NOT NULL"
    ),
}
NEEDS = {"geo": ("listing",)}


def with_views(sql: str) -> str:
    """Put the views that a statement names in front of it."""
    used = [v for v in VIEWS if re.search(rf"\b{v}\b", sql)]
    for v in list(used):
        used = [n for n in NEEDS.get(v, ()) if n not in used] + used
    ordered = [v for v in VIEWS if v in used]
    if not ordered:
        return sql.strip()
    heads = ", ".join(f"{v} AS ({VIEWS[v]})" for v in ordered)
    body = sql.strip()
    return f"WITH {heads}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {heads} {body}"


class Inputs:
    """The driver tables of one folder and the views over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def _view(self, source: DataFrame, columns: dict[str, str], names) -> DataFrame:
        return source.selectExpr(*[f"{columns[n]} AS {n}" for n in (names or columns)])

    def _placed(self, df: DataFrame, key: str) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return df.join(nation, F.col(key) == F.col("n_nationkey")).join(
            region, F.col("n_regionkey") == F.col("r_regionkey")
        )

    def listing(self, *names: str) -> DataFrame:
        joined = self.table("orders").join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        return self._view(self._placed(joined, "c_nationkey"), LISTING, names)

    def calendar(self, *names: str) -> DataFrame:
        joined = self.table("lineitem").join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        return self._view(self._placed(joined, "s_nationkey"), CALENDAR, names)

    def reviews(self, *names: str) -> DataFrame:
        return self._view(self.table("events"), REVIEW, names)

    def raw(self, *names: str) -> DataFrame:
        return self._view(self.table("orders"), RAW, names)


def rounded(df: DataFrame, places: int = 4) -> DataFrame:
    """All doubles rounded, so that the order of summation cannot show. A small
    shift keeps means of round numbers off the rounding boundary."""
    shift = F.lit(10.0 ** -(places + 3))
    return df.select(
        *[
            round_away(F.col(c) + shift, places).alias(c) if kind == "double" else F.col(c)
            for c, kind in df.dtypes
        ]
    )


def settled(sql: str) -> str:
    """The same shift in each `round(x, 4)` and `round(x, 6)` of a statement."""
    out, at = "", 0
    for found in re.finditer(r"\bround\(", sql):
        if found.start() < at:
            continue
        depth, end, comma = 1, found.end(), None
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            comma = end if depth == 1 and sql[end] == "," else comma
            end += 1
        places = sql[comma + 1 : end - 1].strip()
        inner = sql[found.end() : comma]
        out += sql[at : found.start()]
        out += f"round(({inner}) + 1e-{int(places) + 3}, {places})" if places in "46" else sql[found.start() : end]
        at = end
    return out + sql[at:]


def query(name: str, sql: str | None = None, complete: str | None = None):
    """Register a function of `Inputs` as a query, with its SQL form if it has one;
    `complete` is the finished SQL of another query that says the same."""

    def add(build: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Inputs(spark, folder))
        if sql is not None:
            SQL[name] = with_views(settled(sql))
        elif complete is not None:
            SQL[name] = complete
        return build

    return add
