"""The corpus pipeline: from raw documents to encoded training documents.

Every stage works on all rows that the one before kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricemart.llm import exact_dedup, near_dedup, pieces, quality, source_mix
from pricemart.llm.common import scratch, table


#: Bytes of rows that go to a Python worker at once, or one row.
BATCH_BYTES = 4_000_000


def small_batches(spark: SparkSession) -> None:
    """From now on Python workers get texts in small batches: a task holds a batch several times, here and there."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of 0.5 or more stay. The classifier learns from all labelled documents here."""
    small_batches(spark)
    model = quality.fit(quality.labelled_sample(docs, table(spark, sf_dir, "labels"), F.lit(True)))
    return quality.accepted(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space, the longest stays, then the smallest doc_id."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of texts that share 80% of their five-word shingles, the smallest doc_id stays."""
    small_batches(spark)
    return near_dedup.keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture draws them, in training order."""
    return source_mix.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their ids, and whether the ids decode to the very text."""
    small_batches(spark)
    vocabulary = pieces.Vocabulary()
    both = pieces.decode(pieces.encode(docs, vocabulary), vocabulary)
    return both.withColumn("exact", F.col("decoded").eqNullSafe(F.col("text"))).drop("decoded")


STAGES = [
    ("quality classifier", reject_low_quality),
    ("exact dedup", drop_exact_copies),
    ("minhash near-dedup", drop_near_copies),
    ("source mix", mix_sources),
    ("sentencepiece", encode),
]

#: Learned scores, sketches and segmentations cannot be stated in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after another; each is written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, name.replace(" ", "_"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
