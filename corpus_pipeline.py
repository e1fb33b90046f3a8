"""Training text from raw documents: score, drop near copies, drop benchmark leaks, redact secrets, pack.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``. Between stages the rows are a written table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewick.llm import classifier, decontamination, packing, secrets, simhash
from tidewick.llm.common import documents, kept
from tidewick.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = classifier.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return classifier.score(docs, model).filter(F.col("score") >= 0.5).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    return packing.packed_sequences(docs, tokenizer_path())


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("redact_secrets", redact_secrets), ("pack", pack)]
#: The stages train a model and compare edit distances; tests hold them against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
