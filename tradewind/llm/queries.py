"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tradewind.llm import alignment, centroids, dac, decontaminate, differencing, hilbert, language, neardup, packing, quality, reputation, toxicity, warc
from tradewind.llm.folds import in_fold
from tradewind.session import stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("tiles")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic", folds=5, fold=0)
    scored = toxicity.predict(docs, model)
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    return scored.select("doc_id", in_fold("doc_id", 5, 0).alias("held_out"), "score", predicted)


def op3_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op4_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reputation.judge(table(spark, sf_dir, "pages").select("page_id", "url"), reputation.RULES).drop("url")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "quality", folds=4, fold=2)
    scored = quality.predict(docs, model)
    predicted = F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted")
    return scored.select("doc_id", in_fold("doc_id", 4, 2).alias("held_out"), "score", predicted)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", in_fold("doc_id", 5, 0))
    model = language.fit(docs, "NOT held_out")
    return language.predict(docs.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score")


def op7_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(table(spark, sf_dir, "pages"), least_bytes=0)
    return warc.page_records(warc.read_records(index))


def op8_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = stored(packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1))
    return packing.pack(parts)


def op9_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), neardup.Settings(shingle=2))


def op10_direct_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = dac.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return dac.checksums(dac.read_tokens(dac.with_starts(index)))


def op11_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return differencing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op12_token_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = alignment.Tokenizers(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    aligned = alignment.align(table(spark, sf_dir, "documents"), both).withColumn("groups_sha256", digest).drop("groups")
    counted = alignment.link_counts(stored(aligned), both)
    return counted.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.with_inertia(*centroids.cluster(table(spark, sf_dir, "embeddings")))


QUERIES = {
    "op1_string_tiling": op1_string_tiling,
    "op2_toxicity": op2_toxicity,
    "op3_hilbert_neighbours": op3_hilbert_neighbours,
    "op4_host_reputation": op4_host_reputation,
    "op5_quality": op5_quality,
    "op6_language": op6_language,
    "op7_warc_index": op7_warc_index,
    "op8_best_fit": op8_best_fit,
    "op9_hyperminhash": op9_hyperminhash,
    "op10_direct_codes": op10_direct_codes,
    "op11_differencing": op11_differencing,
    "op12_token_windows": op12_token_windows,
    "op13_bit_planes": op13_bit_planes,
}

ORACLES: dict[str, str] = {"op4_host_reputation": reputation.SQL, "op13_bit_planes": centroids.SQL}
