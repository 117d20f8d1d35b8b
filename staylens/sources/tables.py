"""Parquet layers, warehouse tables and report files."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from staylens.operators.warehouse import TABLES, in_schema, require_keys

PUBLISHED = "load bigint, table string, path string"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_layer(df: DataFrame, path: str, by: Sequence[str] = ("city_key",)) -> DataFrame:
    """Write parquet partitioned by the tenant columns and read it back.

    `rebalance` evens out the files: a large city is spread over several, small
    ones are not split into crumbs.
    """
    columns = [c for c in by if c in df.columns]
    spread = df.hint("rebalance", *columns) if columns else df.hint("rebalance")
    spread.write.mode("overwrite").partitionBy(*columns).parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    return back.select(*df.columns)


def write_snapshots(df: DataFrame, path: str, by: Sequence[str], keep: bool) -> None:
    """Write the partitions that `df` has rows of; with `keep` the others stay."""
    mode = "dynamic" if keep else "static"
    df.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*by).parquet(path)


def published(spark: SparkSession, root: str) -> DataFrame:
    """The log of loads: one row per table that a load has published."""
    try:
        return spark.read.schema(PUBLISHED).parquet(f"{root}/published")
    except AnalysisException:
        return spark.createDataFrame([], PUBLISHED)


def current_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The warehouse as the last published loads left it."""
    latest = published(spark, root).groupBy("table").agg(F.max_by("path", "load").alias("path"))
    places = {r["table"]: r["path"] for r in latest.collect()}  # one row per table
    return {n: spark.read.schema(TABLES[n]).parquet(f"{root}/{places[n]}") for n in TABLES if n in places}


class Load:
    """A load of the warehouse below `root`: tables are staged in a folder of their own,
    their keys are checked there, and one appended log file then makes all of them the
    current ones. Until that file is there, which the commit of a write does in one
    step, readers see the tables of the load before, and so they do when the load is
    refused or interrupted. Loads of one warehouse run one after another."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.number = (published(spark, root).agg(F.max("load")).first()[0] or 0) + 1
        self.folder = f"loads/{self.number:06d}-{uuid.uuid4().hex[:12]}"
        self.staged: dict[str, DataFrame] = {}

    def stage(self, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """Write tables in load order, columns in schema order, and read them back."""
        added = {}
        for name in TABLES:
            if name in tables:
                path = f"{self.root}/{self.folder}/{name}"
                in_schema(tables[name], name).write.mode("overwrite").parquet(path)
                added[name] = self.spark.read.schema(TABLES[name]).parquet(path)
        self.staged.update(added)
        return added

    def publish(self, check: bool = True) -> dict[str, DataFrame]:
        """Check the keys of the staged tables together with the current ones they do not
        replace, then switch. A violation raises and changes nothing."""
        if check:
            require_keys({**current_tables(self.spark, self.root), **self.staged})
        rows = [(self.number, name, f"{self.folder}/{name}") for name in self.staged]
        self.spark.createDataFrame(rows, PUBLISHED).coalesce(1).write.mode("append").parquet(f"{self.root}/published")
        return dict(self.staged)


def write_tables(tables: Mapping[str, DataFrame], root: str, check: bool = True) -> dict[str, DataFrame]:
    """Load the given warehouse tables: stage, check, publish."""
    load = Load(next(iter(tables.values())).sparkSession, root)
    load.stage(tables)
    return load.publish(check)


def drop_old_loads(spark: SparkSession, root: str) -> list[str]:
    """Delete the folders of loads that no current table is in, published or not; not
    while a load runs or a reader still holds an older state."""
    latest = published(spark, root).groupBy("table").agg(F.max_by("path", "load").alias("path"))
    used = {r["path"].split("/")[1] for r in latest.collect()}
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/loads")
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [] if not system.exists(folder) else [
        f.getPath() for f in system.listStatus(folder) if f.getPath().getName() not in used
    ]
    for path in old:
        system.delete(path, True)
    return sorted(path.getName() for path in old)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make the tables visible to `spark.sql`."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def save_as_tables(tables: Mapping[str, DataFrame], database: str) -> None:
    """The same load into catalogue tables: dropped and created again."""
    require_keys(tables)
    for name in TABLES:
        in_schema(tables[name], name).write.mode("overwrite").saveAsTable(f"{database}.{name}")


def write_report(df: DataFrame, root: str, name: str) -> DataFrame:
    """A report table as parquet, and as one CSV file from the stored rows."""
    df.write.mode("overwrite").parquet(f"{root}/{name}")
    stored = read_table(df.sparkSession, f"{root}/{name}")
    stored.coalesce(1).write.mode("overwrite").option("header", "true").csv(f"{root}/{name}_csv")
    return stored


def write_rows(df: DataFrame, root: str, name: str) -> DataFrame:
    """A report whose length follows the data: CSV in as many files as it takes."""
    df.write.mode("overwrite").parquet(f"{root}/{name}")
    stored = read_table(df.sparkSession, f"{root}/{name}")
    stored.write.mode("overwrite").option("header", "true").csv(f"{root}/{name}_csv")
    return stored


def report_section(df: DataFrame, section: str, order: Sequence, most: int) -> DataFrame:
    """The first rows of a table as (section, rank, payload)."""
    rank = F.row_number().over(Window.orderBy(*order))
    top = df.orderBy(*order).limit(most)
    return top.select(
        F.lit(section).alias("section"), rank.alias("rank"), F.to_json(F.struct(*df.columns)).alias("payload")
    )
