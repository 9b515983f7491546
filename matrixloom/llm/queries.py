"""Registered queries: each applies one operator with production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, collocations, language, lexical, licences, packing, pii, pstable, quality, simhash, suffix, topk

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.recognised(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", F.size("licence_sentences").cast("long").alias("n_sentences"), F.array_join("licences", ",").alias("licences"), F.array_join("unmatched", ",").alias("unmatched"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    found = language.predict(docs, language.fit(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detected(documents(spark, sf_dir))
    base = F.col("base")
    return found.select(
        "doc_id",
        *(pii.of_kind(base, k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)),
        F.sha2(pii.listed(base), 256).alias("base_sha256"),
        pii.listed(F.col("every")).alias("spans"),
    )


def op4_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.matrices(documents(spark, sf_dir), WORDS)


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.top(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), every=50)
    return found.withColumnRenamed("id", "vec_id")


def op6_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    cut = suffix.cut(docs, suffix.repeats(docs))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0))
    return cut.select(
        "doc_id",
        n_bytes.cast("long").alias("n_bytes"),
        (n_bytes - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(documents(spark, sf_dir))
    return found.select("doc_id", simhash.hexadecimal(F.col("bits")).alias("fingerprint"), "component_id")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(documents(spark, sf_dir), WORDS)
    return packing.pack(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(documents(spark, sf_dir).select("doc_id", "text", "source")).drop("source")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(documents(spark, sf_dir), RANKS, outputs=("ids", "decoded"))
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_pstable(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pstable.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.withColumnRenamed("id", "vec_id")


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mined(documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # beside the package, which it imports

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_licences": op1_licences,
        "op2_language": op2_language,
        "op3_pii": op3_pii,
        "op4_matrices": op4_matrices,
        "op5_topk": op5_topk,
        "op6_suffix": op6_suffix,
        "op7_simhash": op7_simhash,
        "op8_packing": op8_packing,
        "op9_quality": op9_quality,
        "op10_byte_bpe": op10_byte_bpe,
        "op11_pstable": op11_pstable,
        "op12_lexical": op12_lexical,
        "op13_collocations": op13_collocations,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_topk": topk.ORACLE, "op9_quality": quality.ORACLE, "op11_pstable": pstable.ORACLE, "op12_lexical": lexical.ORACLE, "op13_collocations": collocations.ORACLE}
