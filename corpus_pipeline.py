"""A training corpus from raw documents: stages that each apply one corpus operator to all that the stage before kept."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendloom.llm import catalogue, mixing, near_texts, packing, quality, toxicity
from lendloom.llm.common import free_name, read_table, shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, trained on `labels`, doesn't score as toxic. Null and empty texts stay."""
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    score = free_name(docs, "_score")
    return toxicity.with_score(docs, model, name=score).where(F.col(score) < catalogue.TOXIC).select(*docs.columns)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass all quality rules. Null and empty texts have no words and go."""
    verdict = free_name(docs, "_quality")
    return quality.with_verdict(docs, name=verdict).where(F.col(f"{verdict}.kept")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts whose 5-word shingles are similar by 0.8 or more; that of least id."""
    return near_texts.drop_near_texts(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix takes them: none, one or two rows of each. Texts without words go."""
    return mixing.take_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in packed windows, as op4 returns them."""
    return packing.pack_online(docs, public_tokenizers.path(catalogue.TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_poor),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("packing", pack),
]
#: Classifier, fingerprints and tokens can't be put in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the corpus. Each stage's rows are written as Parquet to the shared folder and read again."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
