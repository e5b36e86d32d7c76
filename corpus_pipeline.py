"""A training corpus from raw documents: toxic and poor ones go, near copies and leaks too, the rest is encoded.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's docs.  Models are fitted on ``documents`` and
``labels`` of ``sf_dir``; all decisions fall on the documents that the stage is given.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evergreen.llm import bpe, decontaminate, quality, simhash, toxicity
from evergreen.llm.common import read
from evergreen.session import materialize, run_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    marked = toxicity.training_rows(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, toxicity.fit(marked))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rated = quality.training_rows(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return quality.keep_good(docs, quality.fit(rated))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_classifier", drop_poor),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("bpe_encoding", encode),
]

#: SQL can express neither the fitted models nor the encoding; tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with run_folder(spark):  # what the stage wrote on its way goes, its result stays
            docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
    return docs
