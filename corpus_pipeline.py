"""A training corpus from raw documents: toxic ones go, copies and near copies go, sources are mixed, texts are segmented."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from catalogmart.llm import exact_dedup, mixing, piece_sampling, simhash, toxicity
from catalogmart.llm.common import Scratch, documents
from catalogmart.llm.queries import PIECES


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon learned from the labels does not reject."""
    lexicon = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, lexicon)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the one with the smallest doc_id."""
    return simhash.keep_representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.apply_mix(docs)


def segment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and ids: a sampled segmentation of every document, from which decoding gives the text back."""
    return piece_sampling.sample_pieces(docs, PIECES)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("simhash near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("piece sampling", segment),
]

#: Learned scores, fingerprints and sampled segmentations are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return docs
