"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.llm import chat, near, oracles, pages, pieces, repeats, rules, secrets
from tallywatch.llm.decontaminate import leaks
from tallywatch.llm.divergence import divergence
from tallywatch.llm.licenses import find_licenses
from tallywatch.llm.negatives import mine
from tallywatch.llm.registry import ORACLES, QUERIES, query, read
from tallywatch.llm.token_counts import count_tokens
from tallywatch.llm.token_files import read_documents, write_token_files
from tallywatch.session import new_folder

MAX_TOKENS = 2048


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op1_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage, each with the item and the overlap."""
    found = leaks(spark, read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.withColumnsRenamed({"doc_key": "doc_id", "item_key": "item_id"})


@query(oracles.SHARED_PASSAGES)
def op2_shared_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that a passage of 50 words in an earlier document has too, and a hash of the rest."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    left = repeats.without_repeats(spark, docs, tidy=True)
    return left.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op3_repaired_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations in legal order of turns, rendered in pieces."""
    return chat.repair(spark, read(spark, sf_dir, "conversations")).withColumnRenamed("key", "conv_id")


@query()
def op4_rule_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule statistics of every document, the scores of the forests and the verdict."""
    folder = new_folder(spark, "rules")
    rules.rule_statistics(read(spark, sf_dir, "documents")).write.parquet(folder)
    statistics = spark.read.parquet(folder)
    forests = rules.fit(statistics, read(spark, sf_dir, "labels"))
    return rules.judged(statistics, forests).withColumnRenamed("key", "doc_id")


@query()
def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether decoding them gives the text back."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.encode(docs, vocabulary("piece_bpe_32k.model"), round_trip="round_trip")
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "round_trip")


@query(oracles.NEAR_DUPLICATES)
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document, by the smallest doc_id in it."""
    found = near.near_duplicates(spark, read(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.col("class").alias("class_id"))


@query()
def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page."""
    found = pages.extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


@query()
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and whether they exceed MAX_TOKENS."""
    counted = count_tokens(read(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > MAX_TOKENS)


@query()
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written to Arrow files and read back."""
    docs, folder = read(spark, sf_dir, "documents"), new_folder(spark, "token-files")
    write_token_files(docs, vocabulary("word_bpe_49k.json"), folder, end_id=2)
    return read_documents(spark, folder, docs.schema["doc_id"].dataType).withColumnRenamed("key", "doc_id")


@query()
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses named or quoted in documents."""
    return find_licenses(read(spark, sf_dir, "documents"))


@query(oracles.SECRETS)
def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document, by a ledger that starts empty."""
    found = secrets.scan(spark, read(spark, sf_dir, "documents"), new_folder(spark, "ledger"))
    spans = F.col("spans")
    return found.select(
        "doc_id", *(secrets.number_of(spans, r).alias(f"n_{r.name}") for r in secrets.BASE_RULES),
        F.sha2(secrets.listed(spans, secrets.BASE_RULES), 256).alias("base_sha256"),
        secrets.listed(spans, secrets.RULES).alias("spans"))


@query(oracles.DIVERGENCE)
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of each language, and the terms that set a source apart."""
    return divergence(spark, read(spark, sf_dir, "documents"))


@query(oracles.NEGATIVES)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of other labels that score nearly as high as each positive of each anchor."""
    return mine(spark, read(spark, sf_dir, "embeddings"))

__all__ = ["ORACLES", "QUERIES"]
