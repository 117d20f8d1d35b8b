"""The whole run: raw files to bronze, quality reports, clean and master layers,
warehouse, report and answers. One plan per layer for all cities."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from staylens.config import DATASET_FILES, NATURAL_KEYS, City
from staylens.operators import clean, enrich, quality, similar, warehouse
from staylens.operators.quality import stack
from staylens.plans.answers import answer_all
from staylens.plans.hypotheses import HYPOTHESES
from staylens.plans.price_model import price_model
from staylens.sources import files, tables


def tenants(cities: Sequence[City]) -> tuple[str, ...]:
    """The columns that tell tenants apart: the city, and the snapshot where some
    city has several."""
    return ("city_key",) if len({c.key for c in cities}) == len(cities) else clean.SNAPSHOT


def quality_reports(datasets: Mapping[str, DataFrame], by: Sequence[str]) -> dict[str, DataFrame]:
    """The profile and quality tables, one block of rows per tenant and dataset."""
    listings = datasets["listings"]
    every = datasets.items()
    return {
        "profile_columns": stack([quality.profile(df, name, by) for name, df in every]),
        "dq_duplicates": stack([quality.duplicates(df, name, NATURAL_KEYS.get(name, ()), by) for name, df in every]),
        "dq_completeness": stack([quality.completeness(df, name, by=by) for name, df in every]),
        "dq_outliers": quality.tukey_outliers(listings, "listings", by=by),
        "dq_validation": quality.validate(listings, quality.listing_rules(listings), "listings", by=by),
    }


def write_near_copies(listings: DataFrame, by: Sequence[str], out: str) -> dict[str, DataFrame]:
    """Members, matching names and the number of row pairs of every cell. The names
    with their row counts stand for all row pairs, whose list could be as long as the
    square of a cell; `similar.expand_pairs` writes it out for a part of them."""
    rows = similar.cell_names(listings, "listings", by).select(*similar.BLOCK, "_text", "id", "name", quality.ROW_ID)
    members = tables.write_layer(rows, f"{out}/near_copy_members", (quality.SET,))
    names = tables.write_layer(similar.similar_names(members), f"{out}/near_copy_names", (quality.SET,))
    count = tables.write_report(similar.pair_count(members, names), out, "near_copy_pairs")
    return {"near_copy_members": members, "near_copy_names": names, "near_copy_pairs": count}


def quality_summary(inventory: DataFrame, reports: Mapping[str, DataFrame], rejects: DataFrame, counts: DataFrame) -> DataFrame:
    """The consolidated report: seven sections of (section, rank, payload)."""
    sections = [
        tables.report_section(inventory, "1 datasets", ["dataset"], 20),
        tables.report_section(reports["profile_type_distribution"], "2 column types", ["dataset", F.desc("n_columns"), "inferred_type"], 40),
        tables.report_section(reports["dq_duplicates"], "3 duplicates", ["dataset", "method"], 20),
        tables.report_section(reports["near_copy_pairs"], "3 fuzzy pairs", ["pairs"], 1),
        tables.report_section(
            reports["near_copy_names"].select(
                F.col(quality.SET).alias("dataset"), F.col("_one").alias("name_a"), F.col("_two").alias("name_b"),
                "score", "rows_a", "rows_b",
            ),
            "3 fuzzy duplicates", ["dataset", "name_a", "name_b"], 10,
        ),
        tables.report_section(reports["dq_completeness"], "4 completeness", [F.desc("missing_pct"), "dataset", "field"], 15),
        tables.report_section(reports["dq_outliers"], "5 outliers", ["dataset", "field"], 20),
        tables.report_section(reports["dq_validation"], "6 validation", ["dataset", "rule"], 20),
        tables.report_section(rejects.agg(F.count(F.lit(1)).alias("rejected")), "6 rejected records", ["rejected"], 1),
        tables.report_section(reports["repeats_removed"], "6 repeated ids removed", list(clean.SNAPSHOT), 20),
        tables.report_section(counts, "7 warehouse", ["table"], 20),
    ]
    return stack(sections).orderBy("section", "rank")


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """A table that an earlier run left, if there is one."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException:
        return None


def load_bronze(
    spark: SparkSession, out: str, cities: Sequence[City], manifest: DataFrame, known: DataFrame | None, force: bool
) -> tuple[dict[str, DataFrame], int]:
    """Read the files that no earlier run has read, snapshot by snapshot, and return the
    bronze tables and the number of files read. A snapshot of a dataset is one file, so
    a changed file replaces its own partition."""
    wanted = [f"{c.key}/{c.snapshot}/" for c in cities]
    there = files.new_files(manifest, None if force else known).where(
        F.array_contains(F.array(*[F.lit(w) for w in wanted]), F.regexp_extract("key", "^(.*/)", 1))
    )
    # one row per file
    new = [(r["key"], r["url"], r["header"]) for r in there.select("key", "url", "header").collect()]
    new.sort(key=lambda f: (wanted.index(f[0].rpartition("/")[0] + "/"), f[0]))
    datasets, loaded = {}, 0
    for dataset, name in DATASET_FILES.items():
        own = [(url, header) for key, url, header in new if key.endswith(f"/{name}")]
        path = f"{out}/bronze/{dataset}"
        before = None if force else stored(spark, path)
        last = -1 if before is None else before.agg(F.max(quality.ROW_ID)).first()[0]
        rows = files.bronze(spark, own, -1 if last is None else last) if own else None
        if rows is not None:
            tables.write_snapshots(rows, path, clean.SNAPSHOT, keep=before is not None)
            loaded += len(own)
        found = stored(spark, path)
        if found is not None:
            order = [*clean.SNAPSHOT, *[c for c in found.columns if c not in clean.SNAPSHOT]]
            kinds = ", ".join(f"`{c}` {'bigint' if c == quality.ROW_ID else 'string'}" for c in order)
            datasets[dataset] = spark.read.schema(kinds).parquet(path).select(*order)
    if "listings" not in datasets:
        raise FileNotFoundError("no listings were found")
    return datasets, loaded


def run(
    spark: SparkSession, root: str, out: str, cities: Sequence[City], force: bool = False, model: bool = False
) -> dict[str, DataFrame]:
    """Read every city below `root` and write all layers and reports below `out`. Files
    that an earlier run into `out` has read are not read again unless `force`; with
    `model` the price model is fitted too."""
    reports_root = f"{out}/reports"
    known = stored(spark, f"{reports_root}/manifest")
    seen = files.file_manifest(spark, root, known)
    errors = files.missing_files(seen, cities)
    full = tables.write_report(seen.unionByName(errors, allowMissingColumns=True), f"{out}/manifest", "now")
    manifest = full.where("error IS NULL")
    datasets, loaded = load_bronze(spark, out, cities, manifest, known, force)
    tables.write_report(full, reports_root, "manifest")

    by = tenants(cities)
    reports = {
        name: tables.write_report(df, reports_root, name)
        for name, df in quality_reports(datasets, by).items()
    }
    reports["profile_type_distribution"] = tables.write_report(
        quality.type_distribution(reports["profile_columns"]), reports_root, "profile_type_distribution"
    )
    reports.update(write_near_copies(datasets["listings"], by, reports_root))

    gated = tables.write_layer(clean.gated_listings(datasets["listings"]), f"{out}/silver/gated")
    listings = tables.write_layer(clean.accepted(gated), f"{out}/silver/listings")
    rejects = clean.rejected(gated)
    reports["rejected_records"] = tables.write_rows(
        rejects.select("city_key", "id", "reject_reason"), reports_root, "rejected_records"
    )
    reports["repeats_removed"] = tables.write_report(clean.repeats_removed(gated), reports_root, "repeats_removed")
    raw_calendar = datasets["calendar"] if "calendar" in datasets else files.no_rows(spark, "calendar")
    raw_reviews = datasets["reviews"] if "reviews" in datasets else files.no_rows(spark, "reviews")
    calendar = tables.write_layer(clean.clean_calendar(raw_calendar), f"{out}/silver/calendar")
    reviews = clean.typed_reviews(raw_reviews)

    master = tables.write_layer(enrich.build_master(listings, reviews), f"{out}/gold/master")
    typed = {"listings": listings, "calendar": calendar, "reviews": reviews}
    reports["schema"] = tables.write_report(
        stack([quality.describe_schema(df, name) for name, df in typed.items()]), reports_root, "schema"
    )
    reports["layer_drift"] = tables.write_report(
        quality.layer_drift(datasets["listings"], master), reports_root, "layer_drift"
    )
    # stored dimensions have a known size, by which the fact lookups choose their joins
    load = tables.Load(spark, f"{out}/warehouse")
    dims = load.stage(warehouse.build_dims(master, calendar, reviews, cities))
    load.stage(warehouse.build_facts(master, calendar, reviews, dims))
    star = load.publish()
    counts = warehouse.table_counts(star)

    reports["quality_report"] = tables.write_report(
        quality_summary(files.inventory(datasets), reports, rejects, counts), reports_root, "quality_report"
    )
    reports["answers"] = tables.write_report(answer_all(star, f"{out}/answers"), reports_root, "answers")
    reports["hypotheses"] = tables.write_report(
        answer_all(star, f"{out}/hypotheses", HYPOTHESES), reports_root, "hypotheses"
    )
    if model:
        for name, df in price_model(listings).items():
            reports[name] = tables.write_report(df, reports_root, name)
    reports["loaded"] = spark.createDataFrame([(loaded,)], "files int")
    return {**star, **reports, "manifest": full, "master": master, "listings": listings, "rejects": rejects}
