"""From raw documents to token ids: each stage works on all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm import bpe, decontaminate, jaccard, pii, toxicity
from broadsheet.llm.scratch import Scratch
from broadsheet.session import prepare


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on what of them is labelled, does not reject."""
    prepare(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.reject(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of linked ones."""
    prepare(spark)
    return jaccard.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    prepare(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows the text."""
    prepare(spark)
    return pii.redact(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, as counts and digests of the ids and of what they decode to."""
    prepare(spark)
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, with_decoded=True)
    return coded.select("doc_id", *bpe.digests())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other, each written as Parquet and read again."""
    scratch = Scratch(prepare(spark), "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir))
    return docs


#: No SQL expresses a trained classifier or byte-level merges; tests compare with a plain version.
ORACLE_SQL = None
