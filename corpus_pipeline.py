"""From raw documents to packed training sequences, in stages that are written and read again.

Every stage works on all that the one before it kept.  All but the last return the columns of
``documents``; the last returns the pieces of the packed sequences.  Null and empty texts go with
the quality rules; of rows that repeat, one passes the join; very long texts pass whole and end
as many pieces; an empty table passes through all stages.  Columns beyond those of ``documents``
go along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corvane.llm import _session, mixing, near_duplicates, packing, quality, secrets


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.one_of_each(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", jaccard_join),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: No stage but the mix can be said in SQL: the field of the secret scan is trained, the packing is a search.
ORACLE_SQL = None


@_session.tidy
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.  What a stage returns is written to the shared folder and removed
    when the last one is done; what it wrote on the way is removed before the next one starts."""
    docs = _session.table(spark, sf_dir, "documents")
    folder = _session.folder(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        with _session.scope(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
