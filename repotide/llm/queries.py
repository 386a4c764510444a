"""The operators of this subpackage as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.llm import (
    digest_runs,
    hard_negatives,
    language_codes,
    license_scan,
    line_rules,
    mixing,
    multiset_hash,
    ngram_join,
    piece_sampling,
    quality_convnet,
    toxicity_chain,
    training_order,
    whitening,
)
from repotide.llm.common import documents, embeddings, labels

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


@query
def op1_quality_convnet(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return quality_convnet.score(docs, quality_convnet.train(docs, labels(spark, sf_dir)))


@query
def op2_license_scan(spark, sf_dir):
    return license_scan.scan(documents(spark, sf_dir))


@query
def op3_language_codes(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return language_codes.identify(docs, language_codes.train(docs))


@query
def op4_toxicity_chain(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return toxicity_chain.score(docs, toxicity_chain.train(docs, labels(spark, sf_dir)))


@query
def op5_source_mix(spark, sf_dir):
    taken = mixing.mix(documents(spark, sf_dir))
    return taken.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


@query
def op6_line_rules(spark, sf_dir):
    return line_rules.clean_lines(documents(spark, sf_dir))


@query
def op7_piece_sampling(spark, sf_dir):
    return piece_sampling.encode(documents(spark, sf_dir), piece_sampling.read_model())


@query
def op8_ngram_join(spark, sf_dir):
    return ngram_join.near_duplicates(documents(spark, sf_dir))


@query
def op9_multiset_hash(spark, sf_dir):
    return multiset_hash.fingerprints(documents(spark, sf_dir))


@query
def op10_training_order(spark, sf_dir):
    return training_order.materialise(documents(spark, sf_dir))


@query
def op11_digest_runs(spark, sf_dir):
    return digest_runs.copies(documents(spark, sf_dir))


@query
def op12_hard_negatives(spark, sf_dir):
    rows = hard_negatives.from_embeddings(embeddings(spark, sf_dir))
    return hard_negatives.mine(rows, F.col("id") % 100 == 0)


@query
def op13_whitening(spark, sf_dir):
    return whitening.whitened(embeddings(spark, sf_dir))
