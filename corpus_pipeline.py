"""A corpus pipeline of five stages: bad documents out, near-duplicates out, benchmark copies out, personal data masked, the
rest mixed to target weights in training order.

Every stage takes (spark, docs, sf_dir), works on all that the one before has kept and returns a DataFrame; each result is
written as Parquet and read again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mixwright.llm import decontamination, mixing, near_dedup, pii, quality_rules
from mixwright.llm.common import remove, shared_folder, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned rules keep; those without a doc_id are judged by the same rules."""
    return quality_rules.kept(docs, table(spark, sf_dir, "labels"))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of exact and near copies."""
    return near_dedup.deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mask(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes words of, with n_words, taken and the positions of its uses, in training order."""
    return mixing.mixture(docs)


STAGES = [("quality rules", quality), ("near-duplicates", dedup), ("decontamination", decontaminate), ("personal data", mask), ("mixing", mix)]
#: Alignment and learned rules have no SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written under the shared checkpoint folder and read again, until the
    next has been written too."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if number:
            remove(spark, f"{folder}/{number - 1}")
    return docs
