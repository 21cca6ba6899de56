"""The operators as registered queries, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm import caps, chains, language, merges, minhash, pages, pieces, quality, runs, suffixes, talks, templates, tokens
from tidelake.llm.shared import held_out, table


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)
    return found.withColumnRenamed("id", "doc_id")


def op2_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages")
    found = pages.extract(rows.select("page_id", "url", "html"), pages.train(rows))
    return found.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def op3_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = templates.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnsRenamed({"doc": "doc_id", "item": "item_id"})


def op4_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chains.passages(table(spark, sf_dir, "documents"), least=50, percent=80)


def op5_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.98).withColumnRenamed("id", "vec_id")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.filter(~held_out("doc_id")))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.summaries(table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"), k=2)
    return found.withColumnRenamed("id", "doc_id")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels.filter(~held_out("doc_id")))
    found = quality.score(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted")
    )


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokens.write(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))
    found = tokens.read(spark, path)
    return found.select(F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.digest(table(spark, sf_dir, "documents"), length=200, keep_first=False)
    return found.withColumnRenamed("id", "doc_id")


def op11_talks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return talks.summaries(table(spark, sf_dir, "conversations"), damage=True)


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.digest(runs.planted(table(spark, sf_dir, "documents")), least=12)
    return found.withColumnRenamed("id", "doc_id")


def op13_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merges.digests(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))
    return found.withColumnRenamed("id", "doc_id")


_OPERATORS = (
    *(op1_minhash, op2_pages, op3_templates, op4_chains, op5_caps, op6_language, op7_pieces, op8_quality, op9_token_files, op10_suffix_array),
    *(op11_talks, op12_runs, op13_merges),
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _OPERATORS}
ORACLE_SQL: dict[str, str] = {}
