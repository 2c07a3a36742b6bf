"""From raw documents to token sequences, in five stages.

Each stage is a function (spark, docs, sf_dir) -> DataFrame.  What it returns is written
as Parquet and read again as the docs of the next one.  All but the last return the
columns of documents, of the documents they keep.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeweave.llm import bpe, decontaminate, ngram_join, pii, quality_net
from lakeweave.llm.base import stored, table, tuned


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier (fitted on labelled ones of them) rejects go."""
    tuned(spark)
    return quality_net.good_documents(docs, quality_net.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of documents with a 5-word similarity of 0.8 or more, the smallest id stays."""
    tuned(spark)
    return ngram_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; a document that is mostly benchmark goes."""
    tuned(spark)
    return decontaminate.remove_spans(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    tuned(spark)
    return pii.masked(docs, pii.fit(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and hash of each document's token ids, and the hash of the bytes they decode to."""
    import public_tokenizers

    tuned(spark)
    return bpe.token_digests(docs, public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("quality_classifier", quality),
    ("ngram_join", near_duplicates),
    ("decontamination", decontamination),
    ("pii", personal_data),
    ("byte_bpe", tokens),
]

#: No SQL: the first stage is a fitted network.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
