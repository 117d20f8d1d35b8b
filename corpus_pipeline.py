"""A corpus pipeline of five training-data operators.

`documents` are filtered by the quality classifier, freed of exact and near copies,
mixed to source weights and packed into sequences. Each stage gets what the stage
before it kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from staylens.llm.exact_dedup import without_copies
from staylens.llm.jaccard_join import without_near_copies
from staylens.llm.mixing import mixture
from staylens.llm.packing import packed
from staylens.llm.quality_cnn import accepted
from staylens.llm.queries import table, vocabulary
from staylens.llm.store import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on `labels`, does not reject."""
    return accepted(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return without_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of 0.8 on five-word shingles join."""
    return without_near_copies(docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to source weights takes them."""
    return mixture(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in sequences of 2048 tokens."""
    return packed(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mix", mix), ("pack", pack)]

# Training, tokenising and rounding by hash have no SQL form; the tests hold each
# stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
