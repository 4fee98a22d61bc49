"""The corpus pipeline: quality, exact and near duplicates, mixing, packing, over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snaphist.llm import catalog, exact_dedup, jaccard_join, mixing, packing, quality_lm
from snaphist.llm.store import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within the limit of their language and length.

    Texts that are null or without a word go. A null language takes the limit of all; without trusted
    labels only texts without a word go. An empty table stays empty; all columns pass unchanged.
    """
    return quality_lm.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the largest doc_id of each group of texts equal but for the case of A-Z.

    A null id is below all others; of repeated rows one stays. An empty table stays empty; all columns pass unchanged.
    """
    return exact_dedup.keep(docs, exact_dedup.deduplicate(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group linked by a similarity of 0.8 in five-word shingles.

    Texts without words are linked with nothing and stay; a null id is above all others. An empty table stays
    empty; all columns pass unchanged.
    """
    return jaccard_join.keep(docs, jaccard_join.join(docs, k=5, num=80, den=100))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights; a document taken twice comes twice, whole each time.

    Null is a source of its own, the last one. Texts without words are never taken. An empty table stays
    empty; all columns pass unchanged.
    """
    return mixing.deal(mixing.mix(docs), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 ids.

    Null or empty text gives the end id alone, a null doc_id is kept, and other columns go. An empty table gives no rows.
    """
    return packing.pack(docs, catalog.tokenizer_path())


STAGES = [
    ("quality", quality),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("packed", packed),
]

# The language model and the tokenizer are beyond SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = catalog.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
