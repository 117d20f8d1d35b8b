"""The star of the catalogue: an answer waits for its own tables only."""

import datetime

from staylens.catalogue.keys_and_tables import _star
from staylens.plans import answers
from staylens.plans.hypotheses import weekend_availability


class OnlyCalendar:
    def __init__(self, rows):
        self.rows = rows

    def calendar(self, *names):
        return self.rows.select(*names)

    def listing(self, *names):
        if names != ("city_key",):
            raise AssertionError("no more than the cities is asked for")
        return self.rows.select(*names)


def calendar_star(spark):
    days = [datetime.date(2024, 6, 3) + datetime.timedelta(i) for i in range(14)]
    rows = [(i % 3, d, "asia", i % 2 == 0, 1.0) for i, d in enumerate(days)]
    calendar = spark.createDataFrame(rows, "listing_id long, date date, city_key string, available boolean, minimum_nights double")
    return _star(OnlyCalendar(calendar))


def test_weekends_need_no_listings(spark):
    star = calendar_star(spark)
    found = weekend_availability(star).first()
    assert (found.n_a, found.n_b) == (4, 10)
    assert star["fact_calendar"] is star["fact_calendar"] and len(star) == 8


def test_months_need_only_the_cities_of_listings(spark):
    found = answers.QUESTIONS["monthly_availability"](calendar_star(spark)).collect()
    assert [(r.city, r.year, r.month, r.listing_days, r.avail_rate) for r in found] == [("ASIA", 2024, 6, 14, 0.5)]


def test_calendar_days_are_neither_stored_nor_shuffled(spark):
    days = spark.range(40).selectExpr(
        "id % 3 AS listing_id", "date_add(DATE '2024-06-03', CAST(id % 14 AS INT)) AS date", "'asia' AS city_key",
        "id % 2 = 0 AS available", "1D AS minimum_nights",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        asked = (answers.QUESTIONS["monthly_availability"], weekend_availability)
        plans = [ask(_star(OnlyCalendar(days)))._jdf.queryExecution().executedPlan().toString() for ask in asked]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for plan in plans:
        # a stored table would be a scan of rows, a join by shuffle a sort
        assert "SortMergeJoin" not in plan.split("Final Plan")[0] and "date_key" in plan
    assert "ExistingRDD" not in plans[1]
