"""Raw CSV snapshots: manifest, all-text reading by column name, tagged bronze tables.

Files lie at `<root>/<city key>/<snapshot>/<file name>`.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from staylens.config import DATASET_FILES, NA_TOKENS, City
from staylens.functions.parsing import blank_to_null
from staylens.operators.quality import ROW_ID

CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}
FILE_PATTERN = "*.csv*"


def own_path() -> Column:
    """The path of the file a row comes from, as it was given."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def place(path: Column, back: int) -> Column:
    """The last part of a path, the one before it, and so on, counted from 1."""
    return F.element_at(F.split(path, "/"), -back)


# ---- manifest -----------------------------------------------------------


def marks(spark: SparkSession, paths: str | Sequence[str], **options: str) -> DataFrame:
    """`url`, `digest`, `header` of text files. The digest is the number of lines and
    two sums over their hashes, so that a file of any size is digested by as many tasks
    as read it, and none holds more than a line of it."""
    lines = spark.read.options(**options).text(paths).select(
        own_path().alias("url"), "value", F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )
    small = "decimal(20,0)"
    return lines.groupBy("url").agg(
        F.concat_ws(
            "-", F.count(F.lit(1)), F.sum(F.xxhash64("value").cast(small)), F.bit_xor(F.xxhash64("value", F.lit(1)))
        ).alias("digest"),
        F.min_by("value", F.when(F.col("_block") == 0, F.col("_at"))).alias("header"),
    )


def file_manifest(spark: SparkSession, root: str, known: DataFrame | None = None) -> DataFrame:
    """Path, key, size, digest, time and header of every raw file. `reused` tells files
    that an earlier manifest already holds unchanged."""
    options = {"recursiveFileLookup": "true", "pathGlobFilter": FILE_PATTERN}
    listed = spark.read.format("binaryFile").options(**options).load(root).select(
        own_path().alias("url"), F.col("length").alias("bytes"), F.col("modificationTime").alias("fetched_at")
    )
    found = (
        listed.join(marks(spark, root, **options), "url", "left")
        .withColumn("key", F.concat_ws("/", *[place(F.col("url"), n) for n in (3, 2, 1)]))
        .withColumn("digest", F.coalesce("digest", F.lit("0")))
    )
    columns = ("url", "key", "bytes", "digest", "fetched_at", "header")
    if known is None:
        return found.select(*columns, F.lit(False).alias("reused"))
    before = known.select("key", "digest").distinct().withColumn("reused", F.lit(True))
    return found.join(before, ["key", "digest"], "left").select(
        *columns, F.coalesce("reused", F.lit(False)).alias("reused")
    )


def new_files(manifest: DataFrame, known: DataFrame | None, force: bool = False) -> DataFrame:
    """Files not loaded before with the same content, or all of them."""
    if force or known is None:
        return manifest
    return manifest.join(known.select("key", "digest").distinct(), ["key", "digest"], "left_anti")


def missing_files(
    manifest: DataFrame, cities: Sequence[City], files: Mapping[str, str] = DATASET_FILES
) -> DataFrame:
    """Configured files that the manifest lacks, as its errors."""
    wanted = [(f"{c.key}/{c.snapshot}/{name}", "not found") for c in cities for name in files.values()]
    spark = manifest.sparkSession
    return spark.createDataFrame(wanted, "key string, error string").join(manifest.select("key"), "key", "left_anti")


# ---- reading ------------------------------------------------------------


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def header_names(header: str | None) -> tuple[str, ...]:
    return tuple(next(csv.reader([(header or "").removeprefix("﻿")]), ()))


def read_by_header(
    spark: SparkSession, files: Iterable[tuple[str, str | None]], na: tuple[str, ...] = NA_TOKENS
) -> DataFrame | None:
    """Rows of (path, header) files, every column text and found by its name, with the
    path as `_url`. Files with the same header are one read; a column that a file lacks
    is null. None if no file has a column."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, header in files:
        groups.setdefault(header_names(header), []).append(path)
    frames = []
    for names, paths in groups.items():
        if names:
            raw = spark.read.options(**CSV_OPTIONS).schema(text_schema(names)).csv(paths)
            frames.append(raw.select(own_path().alias("_url"), *[blank_to_null(F.col(f"`{c}`"), na).alias(c) for c in names]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else None


def read_raw(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None, na: tuple[str, ...] = NA_TOKENS
) -> DataFrame:
    """CSV, plain or gzip, every column text; missing-value tokens become null. With a
    schema its columns are picked by name, whatever their order in a file; a column
    that a file lacks is null."""
    found = read_by_header(spark, [(r["url"], r["header"]) for r in marks(spark, path).collect()], na)
    if schema is None:
        if found is None:
            raise ValueError(f"no columns in {path}")
        return found.drop("_url")
    names = schema.fieldNames()
    if found is None:
        return spark.createDataFrame([], text_schema(names))
    return found.select(*[F.col(f"`{c}`") if c in found.columns else F.lit(None).cast("string").alias(c) for c in names])


def read_inferred(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """CSV with column types inferred from the data."""
    return spark.read.options(**CSV_OPTIONS).option("inferSchema", "true").csv(path)


FILE_ROWS = 1 << 33  # row numbers kept for one file


def bronze(spark: SparkSession, files: Sequence[tuple[str, str | None]], after: int = -1) -> DataFrame | None:
    """Rows of one dataset's files, tagged from their paths and numbered: first by the
    place of the file in the list, then by the place in the file. The numbers go on
    after `after`.

    A file is read by one task in order; the caller writes the result once and later
    layers read the stored number.
    """
    rows = read_by_header(spark, files)
    if rows is None:
        return None
    start = (after // FILE_ROWS + 1) * FILE_ROWS
    places = [(path, start + i * FILE_ROWS) for i, (path, _) in enumerate(files)]
    # one row per file
    ranked = F.broadcast(spark.createDataFrame(places, "_url string, _start long"))
    numbered = rows.withColumn("_at", F.monotonically_increasing_id() % FILE_ROWS)
    return numbered.join(ranked, "_url").select(
        place(F.col("_url"), 3).alias("city_key"), place(F.col("_url"), 2).alias("snapshot_date"),
        *[c for c in rows.columns if c != "_url"],
        (F.col("_start") + F.col("_at")).alias(ROW_ID),
    )


# The columns that later steps need of a dataset that no city has.
NEEDED = {
    "calendar": ("listing_id", "date", "available", "minimum_nights"),
    "reviews": ("id", "listing_id", "date"),
}


def no_rows(spark: SparkSession, dataset: str) -> DataFrame:
    """The empty bronze table of an absent dataset."""
    columns = ("city_key", "snapshot_date", *NEEDED[dataset])
    return spark.createDataFrame([], text_schema(columns)).withColumn(ROW_ID, F.lit(0).cast("bigint"))


def inventory(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns per city and dataset."""
    parts = [
        df.groupBy("city_key").agg(F.count(F.lit(1)).alias("rows")).select(
            F.concat_ws(".", "city_key", F.lit(name)).alias("dataset"), "rows",
            F.lit(len([c for c in df.columns if c != ROW_ID])).alias("cols"),
        )
        for name, df in datasets.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)
