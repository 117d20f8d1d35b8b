"""The whole run on hand-made files of two cities, twice."""

import datetime as dt
import gzip

import pytest
from pyspark.sql import functions as F

from staylens.config import City
from staylens.operators import quality, warehouse
from staylens.plans import answers
from staylens.plans.run import load_bronze, run
from staylens.sources import files, tables
from staylens.streaming.arrivals import load_arrivals

CITIES = [
    City("north", "North Town", "land-of-north/upper-north/north-town", "2024-06-15"),
    City("south", "South Town", "land-of-south/lower-south/south-town", "2024-06-16"),
]

HEAD = "id,host_id,name,host_name,host_since,host_is_superhost,neighbourhood_cleansed,latitude,longitude,property_type,room_type,bedrooms,price,number_of_reviews,reviews_per_month,review_scores_rating,availability_365,minimum_nights,license"
NORTH = [
    '1,10,"Sea view, loft",Ana,2014-06-15,t,"Old  Town , North",10.00001,20.0,Entire  Condominium (condo),ENTIRE HOME/APT,2,"$1,234.00",5,1.5,4.8,100,2,N/A',
    '2,10,"loft Sea view,",Ana,2014/06/15,f,Old Town,10.00002,20.0,entire home,ENTIRE HOME/APT,,$100.00,0,,NaN,0,3,',
    '3,11,"a ""quoted""\nname",Bob,2021-02-30, f ,Ward 3,10.2,20.2,private room in children\'s-home,Private room,4,1200,1,null,4.0,365,2000,x',
    '3,11,later copy,Bob,2020-01-01,t,Ward 3,10.2,20.2,tent, Tent ,1,$5.00,1,0.5,4.0,365,1,x',
    '4,,free,None,,maybe,,11.0,21.0,,,0,,0,0,,10,1,x',
    '5,12,bad price,Cy,2020-01-01,t,Ward 3,10.2,20.2,Room in boutique HOTEL,Hotel room,0,$0.00,1,1,4.0,10,1,x',
    '6,12,bad place,Cy,2020-01-01,t,Ward 3,91,,Room in boutique HOTEL,Hotel room,1,"$60,000.00",1,1,4.0,10,1,x',
]
SOUTH_HEAD = HEAD.replace(",license", ",review_scores_value")
SOUTH = [
    "7,10,other,Ana Maria,2015-01-01,t,Old Town,-5.0,30.0,shared room,Shared room,1,$50.00,2,0.4,4.5,20,7,4.9",
    "8,13,other two,Di,2025-01-01,f,Harbour,-5.1,30.1,casa  particular,Private room,3,$80.50,0,0,,30,1,",
]
CALENDAR = {
    "north": ["1,2024-07-01,t,,2,30", "1,2024-07-02,f,,2,30", "1,2024-07-02,f,,2,30", "3,2024/7/6,maybe,,x,30", "3,,t,,1,30", "n/a,2024-07-01,t,,1,30"],
    "south": ["7,2024-07-07,t,$5.00,2.5,30"],
}
REVIEWS = {"north": ["100,1,2024-01-01", "101,1,2024-03-02", "102,1,bad", "103,2,2024-02-02", "104,x,2024-02-03"], "south": ["200,7,2024-05-05"]}


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    top = tmp_path_factory.mktemp("raw")
    for city, head, rows in ((CITIES[0], HEAD, NORTH), (CITIES[1], SOUTH_HEAD, SOUTH)):
        folder = top / city.key / city.snapshot
        folder.mkdir(parents=True)
        packed = {
            "listings.csv.gz": [head, *rows],
            "calendar.csv.gz": ["listing_id,date,available,price,minimum_nights,maximum_nights", *CALENDAR[city.key]],
            "reviews.csv.gz": ["id,listing_id,date", *REVIEWS[city.key]],
        }
        for name, lines in packed.items():
            with gzip.open(folder / name, "wt") as out:
                out.write("\n".join(lines) + "\n")
        (folder / "neighbourhoods.csv").write_text("neighbourhood_group,neighbourhood\n,Old Town\n,Ward 3\n")
    return str(top)


@pytest.fixture(scope="module")
def result(spark, root, tmp_path_factory):
    return run(spark, root, str(tmp_path_factory.mktemp("out")), CITIES)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_clean_and_rejects_hold_every_row(result):
    assert rows(result["rejects"], "id", "reject_reason") == [
        (5, "bad_price;"), (6, "price_over_max;bad_latitude;bad_longitude;"),
    ]
    assert rows(result["listings"], "id") == [(i,) for i in (1, 2, 3, 4, 7, 8)]


def test_cleaned_values(result):
    by_id = {r.id: r for r in result["listings"].collect()}
    one, two, three, four = (by_id[i] for i in (1, 2, 3, 4))
    assert (one.price, one.neighbourhood_std, one.property_type_clean, one.property_family) == (
        1234.0, "Old Town", "Entire Condo (Condo)", "Entire place",
    )
    assert (one.host_since, two.host_since, three.host_since) == (dt.date(2014, 6, 15), dt.date(2014, 6, 15), None)
    assert three.name == 'a "quoted"\nname' and three.property_type_clean == "Private Room In Children'S-Home"
    # the median of 2, 4, 1, 0, 0, 1 over the whole snapshot, rejects and copies included
    assert (two.bedrooms, two.bedrooms_imputed, two.bedrooms_filled) == (None, True, 1.0)
    assert (two.reviews_per_month, two.review_scores_rating) == (0.0, None)
    assert (four.price, four.host_id, four.property_family, four.room_type) == (None, None, "Other", None)
    assert (four.host_is_superhost, four.host_is_superhost_missing) == (False, False)


def test_master(result):
    by_id = {r.id: r for r in result["master"].collect()}
    assert (by_id[1].rev_count, by_id[1].rev_span_days, by_id[1].review_frequency_pm) == (2, 61, 0.998)
    assert (by_id[3].rev_count, by_id[2].review_frequency_pm) == (None, None)
    assert (by_id[1].host_tenure_years, by_id[8].host_tenure_years) == (10.0, None)
    assert (by_id[1].price_per_bedroom, by_id[4].price_per_bedroom) == (617.0, None)
    assert (by_id[1].nb_listing_count, by_id[1].nb_median_price, by_id[1].nb_density_pct) == (2, 667.0, 66.67)
    assert by_id[7].nb_density_pct == 50.0 and by_id[4].nb_listing_count is None


def test_star(result):
    assert rows(result["dim_city"], "city_key", "country", "region") == [
        ("north", "Land Of North", "Upper North"), ("south", "Land Of South", "Lower South"),
    ]
    # host 10 takes the attributes of its first city; the missing host is one row
    assert rows(result["dim_host"], "host_sk", "host_id", "host_name") == [
        (1, None, None), (2, 10, "Ana"), (3, 11, "Bob"), (4, 13, "Di"),
    ]
    assert rows(result["fact_calendar"], "listing_id", "date_key", "available", "minimum_nights") == sorted(
        [(1, 20240701, True, 2), (1, 20240702, False, 2), (1, 20240702, False, 2), (3, 20240706, None, None), (7, 20240707, True, 2)], key=repr
    )
    assert rows(result["fact_review"], "review_sk", "listing_id", "date_key") == [
        (1, 1, 20240101), (2, 1, 20240302), (4, 2, 20240202), (6, 7, 20240505),
    ]
    facts = result["fact_listing"].join(result["dim_host"], "host_sk")
    assert rows(facts, "listing_id", "host_id") == [(1, 10), (2, 10), (3, 11), (4, None), (7, 10), (8, 13)]
    primary, foreign = warehouse.key_checks(result)
    assert primary.where("null_keys + repeated_keys > 0").isEmpty() and foreign.where("orphans > 0").isEmpty()


def test_reports(result):
    assert rows(result["dq_duplicates"].where("method = 'primary_key' and duplicate_rows > 0"), "dataset", "duplicate_rows") == [
        ("north.calendar", 1), ("north.listings", 1),
    ]
    assert rows(result["near_copy_names"], "_set", "score", "rows_a", "rows_b") == [("north.listings", 100, 2, 2)]
    assert rows(result["near_copy_pairs"], "pairs") == [(1,)]
    assert rows(result["repeats_removed"], "city_key", "pk_duplicates_removed") == [("north", 1), ("south", 0)]
    broken = rows(result["dq_validation"].where("violations > 0"), "dataset", "rule", "violations", "sample_ids")
    assert ("north.listings", "minimum_nights_sane", 1, "3") in broken
    assert ("north.listings", "price_present", 1, "4") in broken
    kinds = {(r.dataset, r.column): (r.inferred_type, r.flags) for r in result["profile_columns"].collect()}
    assert kinds[("north.listings", "price")][0] == "money"
    assert kinds[("south.neighbourhoods", "neighbourhood_group")] == ("empty", "high_null")
    assert kinds[("south.listings", "city_key")][1] == "constant"
    sections = {r.section for r in result["quality_report"].collect()}
    assert {s[0] for s in sections} == set("1234567")
    assert result["manifest"].count() == 8
    assert rows(result["answers"], "ok") == [(True,)] * 7
    assert rows(result["hypotheses"], "ok") == [(True,)] * 5


def test_second_run_gives_the_same(spark, root, result, tmp_path_factory):
    again = run(spark, root, str(tmp_path_factory.mktemp("again")), CITIES)
    for name in (*warehouse.TABLES, "near_copy_pairs", "dq_validation", "profile_columns"):
        assert rows(again[name], *again[name].columns) == rows(result[name], *result[name].columns), name


def test_failed_answer_is_recorded(spark, result, tmp_path):
    questions = {"bad": lambda t: t["dim_city"].select("nothing"), "good": answers.QUESTIONS["subscores_by_city"]}
    status = answers.answer_all(result, str(tmp_path), questions).collect()
    assert [(r.question, r.ok) for r in status] == [("bad", False), ("good", True)]


def test_broken_keys_stop_the_load(spark, result, tmp_path):
    good = {n: result[n] for n in warehouse.TABLES}
    root = str(tmp_path)
    tables.write_tables(good, root)
    before = {n: rows(df, *df.columns) for n, df in tables.current_tables(spark, root).items()}
    assert set(before) == set(warehouse.TABLES) and before["dim_city"] == rows(good["dim_city"], *good["dim_city"].columns)
    with pytest.raises(ValueError, match="orphans"):
        tables.write_tables({**good, "dim_city": good["dim_city"].where("city_key = 'north'")}, root)
    # a part of the tables is checked against those that stay
    with pytest.raises(ValueError, match="orphans"):
        tables.write_tables({"dim_room_type": good["dim_room_type"].limit(1)}, root)
    # interrupted between staging and publishing
    tables.Load(spark, root).stage({"dim_city": good["dim_city"].limit(0)})
    assert {n: rows(df, *df.columns) for n, df in tables.current_tables(spark, root).items()} == before
    more = good["dim_city"].unionByName(good["dim_city"].where("city_key = 'north'").withColumn("city_key", F.lit("west")))
    tables.write_tables({"dim_city": more}, root)
    now = tables.current_tables(spark, root)
    assert now["dim_city"].count() == len(before["dim_city"]) + 1
    assert {n: rows(df, *df.columns) for n, df in now.items() if n != "dim_city"} == {
        n: r for n, r in before.items() if n != "dim_city"
    }
    assert len(tables.drop_old_loads(spark, root)) == 3
    assert tables.current_tables(spark, root)["fact_listing"].count() == len(before["fact_listing"])


def test_documentation(result):
    docs = {(r.dataset, r.column_name): r for r in result["schema"].collect()}
    one = docs[("listings", "price")]
    assert (one.data_type, one.min_value, one.max_value, one.sample_value) == ("double", "50.0", "1234.0", "1234.0")
    assert docs[("listings", "name")].min_value == "N/A"
    drift = {r.column: (r.in_before, r.in_after, r.added) for r in result["layer_drift"].collect()}
    assert drift["price"] == (True, True, False) and drift["nb_density_pct"] == (False, True, True)


def test_listings_alone_are_enough(spark, root, tmp_path):
    import shutil

    alone = tmp_path / "raw"
    shutil.copytree(f"{root}/north/2024-06-15", alone / "north" / "2024-06-15", ignore=shutil.ignore_patterns("cal*", "rev*", "nei*"))
    found = run(spark, str(alone), str(tmp_path / "out"), CITIES[:1])
    assert found["fact_calendar"].isEmpty() and found["fact_review"].isEmpty()
    assert rows(found["fact_listing"], "listing_id") == [(i,) for i in (1, 2, 3, 4)]
    assert rows(found["dim_date"], "date_key") == [(20240615,)]


def test_manifest_tells_new_files(spark, root):
    manifest = files.file_manifest(spark, root)
    known = manifest.where("key like 'north/%'")
    assert files.new_files(manifest, known).count() == 4
    assert files.new_files(manifest, known, force=True).count() == 8
    assert files.file_manifest(spark, root, known).where("reused").count() == 4
    gaps = files.missing_files(manifest, [*CITIES, City("west", "West", "a/b/c", "2024-01-01")])
    assert rows(gaps, "error") == [("not found",)] * 4
    one = {r.key: r for r in manifest.collect()}["south/2024-06-16/listings.csv.gz"]
    assert one.header == SOUTH_HEAD and one.bytes > 0 and one.digest.startswith("3-")


def test_only_new_files_are_read(spark, root, tmp_path):
    import shutil

    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")

    def load(known, force=False):
        seen = tables.write_report(files.file_manifest(spark, raw, known), f"{tmp_path}/seen{len(list(tmp_path.iterdir()))}", "m")
        datasets, loaded = load_bronze(spark, out, CITIES, seen, known, force)
        return seen, datasets, loaded

    shutil.copytree(root, raw, ignore=shutil.ignore_patterns("south"))
    first, datasets, loaded = load(None)
    assert loaded == 4 and set(datasets) == {"listings", "calendar", "reviews", "neighbourhoods"}
    assert files.missing_files(first, CITIES).count() == 4
    assert load(first)[2] == 0
    shutil.copytree(f"{root}/south/2024-06-16", f"{raw}/south/2024-06-16", ignore=shutil.ignore_patterns("cal*", "rev*", "nei*"))
    third, datasets, loaded = load(first)
    assert loaded == 1
    assert rows(datasets["listings"], "id") == [(str(i),) for i in (1, 2, 3, 3, 4, 5, 6, 7, 8)]
    assert datasets["listings"].select("_row_id").distinct().count() == 9
    assert load(third, force=True)[2] == 5


def test_columns_are_found_by_name(spark, tmp_path):
    """Reordered, added and missing columns, in the batch read and in the stream."""
    texts = {"a/2024-01-01": "id,price,beds\n1,10,2\n", "b/2024-01-01": "id,beds,price\n2,3,20\n", "c/2024-01-02": "more,id\nx,3\n"}
    for folder, text in texts.items():
        (tmp_path / "raw" / folder).mkdir(parents=True)
        (tmp_path / "raw" / folder / "listings.csv").write_text(text)
    schema = files.text_schema(["id", "price", "beds"])
    want = [("1", "10", "2"), ("2", "20", "3"), ("3", None, None)]
    paths = [str(tmp_path / "raw" / f / "listings.csv") for f in texts]
    assert rows(files.read_raw(spark, paths, schema), "id", "price", "beds") == want
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    load_arrivals(spark, str(tmp_path / "raw"), "listings.csv", schema, out, state)
    (tmp_path / "raw" / "a" / "2024-02-01").mkdir()
    (tmp_path / "raw" / "a" / "2024-02-01" / "listings.csv").write_text("price,id\n7,4\n")
    load_arrivals(spark, str(tmp_path / "raw"), "listings.csv", schema, out, state)
    stored = spark.read.parquet(out)
    assert rows(stored, "id", "price", "beds") == [*want, ("4", "7", None)]
    assert stored.select("_row_id").distinct().count() == 4


def test_many_equal_names_are_counted(spark):
    """A crowded cell gives one row per name, and the exact number of pairs."""
    from staylens.operators import similar

    listed = [(i, str(i % 40), "sunny flat", 1.0, 2.0, "x") for i in range(2000)] + [(9000, None, "sunny flat", 1.0, 2.0, "x")]
    df = spark.createDataFrame(listed, "_row_id long, id string, name string, latitude double, longitude double, room_type string")
    members = similar.cell_names(df, "set")
    names = similar.similar_names(members)
    assert rows(names, "rows_a", "score") == [(2001, 100)]
    assert rows(similar.pair_count(members, names), "pairs") == [(2001 * 2000 // 2 - 40 * (50 * 49 // 2),)]


def test_price_model(spark):
    from pyspark.ml.regression import GBTRegressor

    from staylens.operators import models
    from staylens.plans.price_model import model_table, price_model

    kinds = ["Entire home/apt", "Private room", None, "Shared room"]
    data = [
        (i, 100.0 + 60 * (i % 4) + 30 * (i % 7) if i % 11 else None, "Ward %d" % (i % 6), kinds[i % 4], float(i % 7) if i % 5 else None,
         '["Fast Wifi", "TV"]' if i % 2 else "[]", "ETV/1" if i % 3 else None, "text", float(i * 7919 % 13))
        for i in range(400)
    ]
    df = spark.createDataFrame(
        data, "id long, price double, neighbourhood_std string, room_type string, beds double, amenities string, license string, name string, noise double"
    )
    table = model_table(df)
    assert table.rows.count() == len([r for r in data if r[1] is not None])
    assert table.values["room_type"] == ["Private room", "Shared room"]
    assert {"beds", "beds_imputed", "has_wifi", "license", "room_type_flags"} <= set(table.names)
    assert not {"noise", "name", "id", "price"} & set(table.names)
    small = {"Linear Regression": models.linear, "Boosted Trees": lambda: GBTRegressor(maxIter=5, seed=1)}
    found = price_model(df, candidates=small, final=models.linear, folds=3)
    scores = {r.model: r.rmse for r in found["model_scores"].collect()}
    assert set(scores) == set(small) and max(scores.values()) < 0.4
    assert found["model_held_out"].first()["rmse"] < 0.4


def test_catalogue_tables(spark, result, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS staylens_saved LOCATION '{tmp_path}/saved'")
    tables.save_as_tables({n: result[n] for n in warehouse.TABLES}, "staylens_saved")
    assert spark.table("staylens_saved.dim_city").count() == 2


def test_inferred_read(spark, root):
    df = files.read_inferred(spark, f"{root}/north/2024-06-15/listings.csv.gz")
    assert dict(df.dtypes)["host_id"] == "int" and dict(df.dtypes)["price"] == "string"
    docs = quality.describe_schema(df.withColumn("_row_id", F.monotonically_increasing_id()), "listings")
    assert [tuple(r)[1:] for r in docs.where("column_name = 'id'").collect()] == [("id", "int", "1", "6", "1")]


def test_arrivals_load_each_file_once(spark, root, tmp_path):
    schema = files.text_schema(["id", "listing_id", "date"])
    for _ in range(2):
        load_arrivals(spark, root, "reviews.csv.gz", schema, str(tmp_path / "out"), str(tmp_path / "state"))
    loaded = spark.read.parquet(str(tmp_path / "out"))
    assert loaded.count() == 6
    assert rows(loaded.where("city_key = 'south'"), "id", "listing_id", "date") == [("200", "7", "2024-05-05")]
    assert [r.id for r in loaded.where("city_key = 'north'").orderBy("_row_id").collect()] == ["100", "101", "102", "103", "104"]


def test_key_candidates(spark):
    tables_ = {
        "listing": spark.createDataFrame([(1, "a"), (2, "a")], "id long, kind string"),
        "review": spark.createDataFrame([(9, 1), (8, 1)], "id long, listing_id long"),
        "stray": spark.createDataFrame([(5,), (5,)], "listing_id long"),
    }
    assert rows(quality.primary_key_candidates(tables_), "table", "column") == [("listing", "id"), ("review", "id")]
    assert rows(quality.foreign_key_candidates(tables_), "table", "column", "references_table") == [("review", "listing_id", "listing")]
