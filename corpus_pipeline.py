"""A corpus pipeline over ``documents``: rejects bad documents, drops copies and near copies, mixes
the sources to their target weights, and packs what is left into training sequences.

Each stage takes the table its predecessor wrote. All but the last return the columns of
``documents``. Quality rules judge whole texts and leave the texts of the documents they keep as
they are. A document that the mix takes several times is there several times.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shotmarts.llm import common, exact, mixing, ngram_join, packing, quality

SIZE = 2048


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.deduplicate(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.stream(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), SIZE)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality rules", rules),
    ("exact dedup", copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing to target weights", mix),
    ("best-fit packing", pack),
]

#: Language models' tokenizers and hash functions are beyond SQL: tests hold the stages against
#: brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = common.Workspace(spark, "pipeline")
    docs = common.read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = ws.store(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
