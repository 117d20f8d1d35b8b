"""Hand-made rows for the parsers; each case is named after what it pins."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from staylens.config import AMENITIES, NA_TOKENS, ROOM_TYPES
from staylens.functions import numbers as n, parsing as p, text as x


def column(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


CASES = {
    "money": (p.money, ["$1,234.00", "1200", "$0.00", "$-5", "n/a", "1d", "1f", "NaN", None, " $7 ", "1e3", "inf"],
              [1234.0, 1200.0, 0.0, -5.0, None, None, None, None, None, 7.0, 1000.0, float("inf")]),
    "number keeps commas out": (p.num, ["1,234", ".5", "5.", "+3", "-2.5e-1", "", "0x1F", "١"],
                                [None, 0.5, 5.0, 3.0, -0.25, None, None, None]),
    "long ids stay exact": (p.whole, ["9007199254740993", "12.0", "12.5", "x", " 7 "], [9007199254740993, 12, None, None, 7]),
    "percent": (p.percent, ["98%", "100 %", "N/A", None, "5"], [0.98, 1.0, None, None, 0.05]),
    "date": (p.parse_date, ["2021-07-01", "2012/08/09", "2021-7-1", "2021-02-30", None, "2020-01-02T03:04:05", "07/04/2021", "Jul 4, 2021", "soon"],
             [dt.date(2021, 7, 1), dt.date(2012, 8, 9), dt.date(2021, 7, 1), None, None, dt.date(2020, 1, 2), dt.date(2021, 7, 4), dt.date(2021, 7, 4), None]),
    "boolean": (p.boolean, ["t", "TRUE", " f ", "maybe", None, "False"], [True, True, False, None, None, False]),
    "room type": (lambda c: p.canonical(c, ROOM_TYPES), ["ENTIRE HOME/APT", " Tent ", None, "hotel room"],
                  ["Entire home/apt", "Tent", None, "Hotel room"]),
    "property words": (x.tidy_words, ["Entire  Condominium (condo)", "private room in children's-home", " casa\tparticular ", "Room in boutique HOTEL", None],
                       ["Entire Condo (Condo)", "Private Room In Children'S-Home", "Casa Particular", "Room In Boutique HOTEL", None]),
    "family": (lambda c: x.family(x.tidy_words(c)), ["entire condominium", "Private room in hotel", "shared room", "Room in boutique HOTEL", "Hostel bed", None, "tent"],
               ["Entire place", "Private room", "Shared room", "Hotel/Hostel", "Hotel/Hostel", "Other", "Other"]),
    "neighbourhood": (x.before_comma, [" Old   Town , City", None, "Ward 3"], ["Old Town", None, "Ward 3"]),
    "licence words": (lambda c: x.has_word(c, ("ESFC", "ETV")), ["etv/1", "ETVX", None, "a ESFC b"], [True, False, False, True]),
    "missing tokens": (lambda c: p.blank_to_null(c, NA_TOKENS), ["", "N/A", "NA", "null", "None", "NaN", "nan", "ok", None], [None] * 7 + ["ok", None]),
    "sorted tokens": (x.sorted_tokens, ["b  a C", " z ", ""], ["C a b", "z", ""]),
}


@pytest.mark.parametrize("name", CASES)
def test_text(spark, name):
    expression, values, expected = CASES[name]
    assert column(spark, values, expression) == expected


NUMERIC = {
    "half to even": (lambda c: n.round_even(c, 2), [2.125, 0.285, 0.375, -2.125, None], [2.12, 0.28, 0.38, -2.12, None]),
    "half away": (lambda c: n.round_away(c, 2), [2.125, 0.285, -2.125, None], [2.13, 0.28, -2.13, None]),
    "integer column": (n.to_int, [2.5, 3.5, 2.7, None], [2, 4, 3, None]),
    "zero units": (lambda c: n.per_unit(F.lit(10.0), c), [0.0, 3.0, None], [None, 3.33, None]),
    "zero span": (lambda c: n.per_month(F.lit(3), c), [0.0, 30.44], [None, 3.0]),
    "band": (lambda c: n.band(c, 50), [0.0, 49.9, 50.0, 149.0], [0.0, 0.0, 50.0, 100.0]),
    "buckets never fall": (n.bucket_of, sorted([-1e12, -5.0, -1.0, -1e-9, 0.0, 1e-9, 0.4, 1.0, 7.0, 7.1, 1e300]), None),
}


@pytest.mark.parametrize("name", NUMERIC)
def test_numbers(spark, name):
    expression, values, expected = NUMERIC[name]
    found = column(spark, values, expression, "double")
    assert found == (sorted(found) if expected is None else expected)


def test_tenure(spark):
    rows = spark.sql("select date'2014-06-15' a, date'2024-06-15' b union all select date'2025-01-01', date'2024-06-15' union all select date'2022-06-15', date'2024-06-15'")
    found = rows.select(n.tenure_years(F.col("a"), F.col("b")), n.tenure_years_calendar(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in found] == [(10.0, 10.0), (None, -0.55), (2.0, 2.0)]


def test_amenity_flags(spark):
    texts = ['["Fast Wifi","TV"]', "[]", None, "not json", '["Private pool"]']
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    flags = rows.orderBy("i").select(*x.list_flags(F.col("v"), AMENITIES)).collect()
    assert len(flags[0]) == 40
    assert [(f.has_wifi, f.has_tv, f.has_pool, f.has_free_parking_on_premises) for f in flags] == [
        (True, True, False, False), (False,) * 4, (False,) * 4, (False,) * 4, (False, False, True, False),
    ]
