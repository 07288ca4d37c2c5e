"""From raw documents to encoded training data: five stages, each written as Parquet and read again by the next.

Language ID -> near duplicates -> personal data -> mixing -> BPE. All stages but the last return the columns of
``documents``; a stage looks at these columns only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageglean.llm import bpe, jaccard_join, language, mixing, pii
from pageglean.llm.catalog import TOKENIZER, table
from pageglean.session import shared_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# Texts whose language is less sure than this are rejected, besides those without letters.
LANGUAGE_SCORE = 0.5
# SQL cannot express the stages' models; the tests hold them against plain versions.
ORACLE_SQL = None


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled rest of the table is written in."""
    docs = docs.select(*COLUMNS)
    known = language.predict(docs, language.fit(docs), keep=COLUMNS)
    return known.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LANGUAGE_SCORE)).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: that of the least id, once. Rows without id stay."""
    docs = docs.select(*COLUMNS)
    kept = jaccard_join.near_duplicates(docs).filter(F.col("doc_id") == F.col("class_id")).select("doc_id").distinct()
    # The second grouping is by the key that the join has already dealt by.
    first = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return first.unionByName(docs.filter(F.col("doc_id").isNull())).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal values; ``n_chars`` follows the text."""
    return pii.pseudonymize(docs.select(*COLUMNS)).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its drawn number of copies says; documents without id stay once."""
    docs = docs.select(*COLUMNS)
    rated = mixing.mix(docs, table(spark, sf_dir, "labels")).filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("copies").alias("copies"))
    times = docs.join(rated, "doc_id", "left").withColumn("copy", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)))))
    return times.filter(F.col("copy") > 0).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digest of ids and decoded text of every document of the mixture."""
    return bpe.encode_documents(docs.select(*COLUMNS), TOKENIZER)


STAGES = [("language", languages), ("near_copies", near_copies), ("personal_data", personal_data), ("mixture", mixture), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result is stored in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
