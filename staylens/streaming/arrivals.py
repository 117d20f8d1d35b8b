"""Raw files that arrived since the last call, through a file stream.

The checkpoint remembers which files were read, so a file is loaded once and a
call without new files loads nothing. This is the incremental form of skipping
files that are already there.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from staylens.operators.quality import ROW_ID
from staylens.sources import files

LISTED = "path string, modificationTime timestamp, length long, content binary"


def arrivals(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Stream of the paths of one dataset's files; their content is not read here."""
    listed = (
        spark.readStream.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", name)
        .schema(LISTED)
        .load(root)
    )
    return listed.select(files.own_path().alias("url"))


def rows_of(spark: SparkSession, paths: list[str], schema: T.StructType, after: int) -> DataFrame | None:
    """Rows of the files with the columns of the schema, found by name, tagged and
    numbered from `after` + 1 on."""
    marked = [(r["url"], r["header"]) for r in files.marks(spark, paths).orderBy("url").collect()]
    found = files.bronze(spark, marked, after)
    if found is None:
        return None
    named = [
        F.col(f"`{c}`") if c in found.columns else F.lit(None).cast("string").alias(c) for c in schema.fieldNames()
    ]
    return found.select("city_key", "snapshot_date", *named, ROW_ID)


def load_arrivals(
    spark: SparkSession, root: str, name: str, schema: T.StructType, out: str, checkpoint: str
) -> None:
    """Add the rows of all new files to the table below `out` and stop.

    Each batch has its own folder, which a repeated batch overwrites, so rows are
    stored once even if a batch is retried. Row numbers go on after those of earlier
    batches, so they are unique over batches and rise within a file.
    """

    def last_before(number: int) -> int:
        try:
            stored = spark.read.parquet(out)
        except AnalysisException:  # nothing is stored yet
            return -1
        return stored.where(F.col("batch") < number).agg(F.max(ROW_ID)).first()[0] or -1

    def store(batch: DataFrame, number: int) -> None:
        # one row per new file
        paths = [r["url"] for r in batch.collect()]
        rows = rows_of(spark, paths, schema, last_before(number)) if paths else None
        if rows is not None:
            rows.write.mode("overwrite").parquet(f"{out}/batch={number}")

    (
        arrivals(spark, root, name)
        .writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
        .start()
        .awaitTermination()
    )
