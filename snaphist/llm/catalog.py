"""The corpus operators as named queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaphist.llm import centroids, exact_dedup, importance, jaccard_join, license_rules, mixing, multi_index
from snaphist.llm import packing, personal_data, quality_lm, substring_dedup, topk, url_rules

# The rules of the URL query.
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path())


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(documents(spark, sf_dir), k=3, num=90, den=100)


def op3_quality_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_lm.classify(documents(spark, sf_dir), labels)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    decisions = exact_dedup.deduplicate(documents(spark, sf_dir))
    return decisions.withColumnRenamed("digest", "text_sha256")


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    judged = url_rules.judge(pages, url_rules.rules(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return topk.search(vectors, F.col("vec_id") % 20 == 0, "vec_id", "embedding", k=20)


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.scan(documents(spark, sf_dir))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring_dedup.remove(documents(spark, sf_dir))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_rules.detect(documents(spark, sf_dir)).drop("detections")


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return centroids.cluster(vectors, "vec_id", "embedding", k=16, rounds=3)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return importance.resample(documents(spark, sf_dir), target, longest=1, percent=10)


def op13_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return multi_index.search(vectors, F.col("vec_id") % 20 == 0, "vec_id", "embedding", k=20)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_packing, op2_ngram_join, op3_quality_lm, op4_exact_dedup, op5_url_rules, op6_topk, op7_personal_data,
        op8_substring_dedup, op9_mixing, op10_license_rules, op11_centroid_clusters, op12_importance_resampling,
        op13_multi_index,
    ]
    return {f.__name__: f for f in found}
