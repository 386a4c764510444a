"""From documents to sampled token ids: five stages, each a whole pass.

Every stage takes the table that the stage before wrote. All but the last
return the columns of documents. Null and empty texts are judged like others,
an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from repotide.llm import mixing, ngram_join, piece_sampling, quality_convnet, toxicity_chain
from repotide.llm.common import documents, labels, prepare, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain does not call toxic."""
    prepare(spark)
    return toxicity_chain.keep_clean(docs, toxicity_chain.train(docs, labels(spark, sf_dir)))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network scores 0.5 or more."""
    prepare(spark)
    return quality_convnet.keep_good(docs, quality_convnet.train(docs, labels(spark, sf_dir)))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    prepare(spark)
    return ngram_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    prepare(spark)
    return mixing.mixed(docs)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every document."""
    prepare(spark)
    return piece_sampling.encode(docs, piece_sampling.read_model())


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_copies", drop_copies),
    ("mixing", mix_sources),
    ("pieces", to_pieces),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
