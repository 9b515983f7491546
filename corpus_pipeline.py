"""A corpus from raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents. Stages neither read nor change anything but what
they are given. Rows that are repeated whole are one document: they stay or go together.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matrixloom.llm import language, packing, pii, simhash, suffix
from matrixloom.llm.common import quoted, stored

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def with_text(docs: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """``columns`` of docs with its column ``text`` as the text, and n_chars to match."""
    new = {"text": F.col(text), "n_chars": F.length(text).cast("long")}
    return docs.select(*(new[c].alias(c) if c in new else quoted(c) for c in columns))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, with lang as predicted. Those without a letter, and null texts, go; rows without doc_id
    stay if their text does."""
    found = language.predict(docs, language.fit(docs), keep=True).filter(F.col("lang_pred") != language.UNKNOWN)
    return found.select(*(F.col("lang_pred").alias(c) if c == "lang" else F.col("row")[c].alias(c) for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id.

    Near duplicates share 0.8 or more of their five-word shingles: the fingerprints find candidates, with files and a radius that are wide
    enough for that, and each link is verified. The four words and four bits of ``simhash.groups`` are for operator 7's query only.
    Texts without words, null ones too, are equal, so one of them stays; rows without doc_id belong to no group and stay.
    """
    return simhash.one_of_each(docs, simhash.similar_groups(docs, shingle=5, least=0.8))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of repeated 100-byte passages. Bytes of a character that was cut through go too. All rows stay: a
    text may end up empty, a null one stays null, and rows without doc_id are neither compared nor cut."""
    return with_text(suffix.cut(docs, suffix.repeats(docs)), "kept_text", docs.columns)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind, and the terms that give it away generalised or removed. All rows stay; null texts stay null."""
    return with_text(pii.sanitised(docs), "text", docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens. A null or empty text is one piece of its end mark; rows
    without doc_id, and repeated rows, are packed like any other."""
    cut = packing.pieces(docs, TOKENIZER)
    return packing.pack(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [
    ("language identification", identify_language),
    ("near-duplicate removal", drop_near_duplicates),
    ("repeated-passage removal", cut_repeats),
    ("personal data", sanitise),
    ("packing", pack),
]

#: No stage but packing's arithmetic can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
