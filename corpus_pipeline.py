"""From raw documents to training tokens, in five stages.

Documents that the quality classifier doesn't draw go; of each group of near
duplicates one document stays; passages that stand elsewhere are cut; sources
are mixed to target weights in training order; what is left is encoded, and the
tokens are decoded again to see that nothing was lost.

Each stage takes what the one before kept. All but the last return the columns
of ``documents``.

Defined results: the operators state theirs, and the stages follow. Rows with a
null id or text pass the filters (a null text has no n-grams, no near duplicates
and no passages), are mixed with size 0 and end with no tokens. Rows that share an
id are judged each by its own text, but are one document for near duplicates.
Texts of any length are worked on whole. An empty table gives an empty result.
Further columns are carried to the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltstone.llm import bpe, minhash, mixing, quality, substrings
from siltstone.llm.queries import vocabulary
from siltstone.runtime import passing_scratch, scratch_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs, minhash.Near())


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.training_order(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, vocabulary(), verify=True)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substrings", substring_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: SQL can't express the classifier, the signatures, the chunks and the merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of all documents that reach training.

    What a stage wrote on its way is removed once its result is written; the
    last stage is planned only, and reads the result before it.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, name)
        with passing_scratch(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
