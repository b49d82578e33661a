"""A corpus pipeline of the library's own operators: raw documents in, packed sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
reread as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventlake.llm import mixing, packing, pii, quality, simhash
from eventlake.llm.common import importable
from eventlake.session import scratch_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


# A stand-in: production runs pass a secret of their own.
PII_SECRET = "not a secret"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; all stay where nothing is labelled."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one of the least doc_id.

    Near copies have fingerprints of three-word shingles that differ in two bits at most, or are
    linked by others that do.
    """
    return simhash.keep_one(docs)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in every text replaced."""
    return pii.replace(docs, PII_SECRET)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks for."""
    return mixing.mix(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of several lengths."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_quality),
    ("simhash near-dedup", near_duplicates),
    ("pii surrogates", surrogates),
    ("mixing to target weights", mixture),
    ("packing", sequences),
]

# The classifier's training and the fingerprints are beyond SQL; tests/llm holds a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, each written to the shared folder and read again."""
    docs = importable(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
