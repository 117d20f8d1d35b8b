"""Session defaults and lineage cuts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "staylens", **conf: str) -> SparkSession:
    """A session with the defaults above; the cluster's own settings (master,
    memory, shuffle partitions, checkpoint folder) come from its configuration."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage in the cluster's shared checkpoint folder, `spark.checkpoint.dir`;
    where that is unset, in a folder beside the warehouse."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "-checkpoints")
    return df.checkpoint()
