"""From raw documents to a training mix: five stages, each one operator of ``pinwheel.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's docs. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from pinwheel.llm import bpe, mixing, pii, simhash, toxicity
from pinwheel.llm.queries import tokenizer_path
from pinwheel.session import checkpoint_dir
from pinwheel.sources.tables import load


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold; learned from ``labels``."""
    return toxicity.without_toxic(docs, load(spark, sf_dir, "labels"))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links."""
    return simhash.one_per_group(docs)


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts replaced by pseudonyms; n_chars counted anew."""
    return pii.without_pii(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every copy that the mix takes, in training order."""
    return mixing.training_order(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, in the order of ``docs``' files, and digests of ids and decoded text."""
    return bpe.bpe_digest(docs, tokenizer_path("word_bpe_49k.json"), keep_ids=True)


STAGES = [
    ("toxicity", remove_toxic),
    ("near_duplicates", remove_near_duplicates),
    ("pii", replace_pii),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# A trained network, XXH64 with a seed and the vocabulary's merges have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``.

    Stage results lie in a folder ``pipeline-<uuid>`` of the shared checkpoint folder. The
    returned rows are read from there, so it stays; delete it when they have been used.
    """
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4()}"
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
