"""Tables that a job writes between its steps, and size-checked joins.

A step whose result is used more than once, or whose row numbers must not
change when an executor is lost, is written as Parquet below the folder of
`spark.checkpoint.dir`, which all executors share, and read again.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BROADCAST_BYTES = 8 << 20


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; where it is unset, a folder beside the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "-checkpoints"


def written(df: DataFrame) -> DataFrame:
    """The rows of `df`, computed once and read back from the shared folder."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def if_small(stored: DataFrame, row_bytes: int) -> DataFrame:
    """`stored`, a written table of rows of known width, marked for broadcast when
    its row count proves it small; else it takes part in a shuffle join."""
    return F.broadcast(stored) if stored.count() * row_bytes <= BROADCAST_BYTES else stored


def whole(df: DataFrame) -> DataFrame:
    """Each row as one column `all`, so that working columns cannot clash with its own;
    `select("all.*")` unpacks it."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("all"))


def clear_of(columns: Sequence[str], *names: str) -> list[str]:
    """Working column names that do not clash with the columns of a table."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def spread(*columns: str, seed: int = 0) -> Column:
    """A number in [0, 1) fixed by the columns, the same in every run."""
    return F.pmod(F.xxhash64(*columns, F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))
