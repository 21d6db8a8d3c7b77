"""A corpus pipeline over ``documents``: five stages, each written and read again.

toxicity         documents scored as toxic go
near_duplicates  one document of each group of near copies stays
substrings       repeated 13-word windows are cut out of the texts
mixing           documents are taken so that the sources meet their targets
sentencepiece    the mix is encoded and decoded again
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from coinsieve.llm import mixing, partenum, pieces, recompress, toxicity
from coinsieve.llm.queries import piece_model, table
from coinsieve.llm.storage import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; trained on ``labels`` of the documents."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, Jaccard 0.8 or more: the smallest doc_id of each component stays."""
    return partenum.keep_one(docs, n=5, num=80, den=100)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in 13-word windows that a smaller doc_id has too go."""
    return recompress.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document of the mix."""
    return pieces.encode_documents(docs, piece_model())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substrings", cut_repeats),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: The stages learn, search and draw: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
