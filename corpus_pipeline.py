"""Corpus pipeline: stages over the documents table, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm import language, minhash, pieces, suffixes, templates
from tidelake.llm.shared import bound_batches, keep, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; those without a letter or with an uncertain prediction go.

    Null and empty texts go; repeated rows are judged alike; columns pass through under any name; an empty table stays empty.
    """
    bound_batches(spark)
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    found = language.identify(rows, language.train(docs))
    return found.filter(language.certain(found)).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8 or more.

    Null and empty texts and rows without an id stay; of rows with one id and text one stays; an empty table stays empty.
    """
    return minhash.deduplicate(docs, words=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of passages of 200 bytes and more are cut out of the texts; ``n_chars`` follows.

    Every row stays, null and short texts as they are; of equal copies the one with the smallest id is the first.
    """
    return suffixes.remove_repeats(docs, length=200, size="n_chars")


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark, re-parameterised ones included.

    Null and empty texts and rows without an id stay; an empty benchmark removes nothing.
    """
    return templates.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def segmentations(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two distinct sampled segmentations of each document: piece ids and scores.

    A null text counts as empty and has one segmentation, without pieces; fewer than two where a text has no second.
    """
    import public_tokenizers

    bound_batches(spark)
    found = pieces.segmentations(docs, public_tokenizers.path("piece_bpe_32k.model"), k=2)
    return found.withColumnRenamed("id", "doc_id").drop("decoded")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("segmentations", segmentations),
]

#: Learned models and byte-level matches are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
