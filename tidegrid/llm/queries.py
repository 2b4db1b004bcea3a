"""The dealt operators as queries over the whole test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegrid.llm import (
    bpe, conversation_repair, decontamination, html_text, kneser_ney, language_id, ngram_join, order_minhash, packing,
    prefix_trie, quotation, sharding, substring_dedup)
from tidegrid.llm.oracles import ORACLES  # noqa: F401
from tidegrid.session import configure

TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
SHARDS = 40


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """Every fifth document by CRC-32 of its id, which language ID never learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return packed.withColumnRenamed("id", "doc_id")


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = ngram_join.ngram_join(_table(spark, sf_dir, "documents"))
    return joined.select(F.col("id").alias("doc_id"), "class_id", "copies", "n_links")


def op3_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.col("text").cast("binary")
    rows = _table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(raw, F.lit("").cast("binary"))).alias("text_crc32"), F.lit("key").alias("law"))
    rows = sharding.with_shard(rows, "doc_id", [1.0] * SHARDS)
    rows = sharding.with_shard(rows, "doc_id", [1.0] * (SHARDS + 1), "grown_shard")
    return sharding.numbered(rows)


def op4_quotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotation.reply_ordered(_table(spark, sf_dir, "conversations"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.main_text(_table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = _table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0").select("doc_id")
    return kneser_ney.score(_table(spark, sf_dir, "documents"), trusted).withColumnRenamed("id", "doc_id")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    aside = held_out(F.col("doc_id"))
    model = language_id.train(documents, ~aside)
    found = language_id.identify(documents.select("doc_id", aside.alias("held_out"), "text"), model)
    return found.drop("text")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    words = F.concat_ws(" ", F.expr(r"regexp_extract_all(kept, '[^\\x20\\x09-\\x0D]+', 0)"))
    return cut.select("doc_id", "n_words", "n_removed",
                      F.sha2(F.coalesce(words, F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.with_edits(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_repair.damaged(_table(spark, sf_dir, "conversations"))
    return conversation_repair.whole(conversation_repair.repair(rows)).withColumnRenamed("conv", "conv_id")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_TOKENIZER)
    coded = bpe.decode(bpe.encode(_table(spark, sf_dir, "documents"), path), path)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pack": op1_pack,
    "op2_ngram_join": op2_ngram_join,
    "op3_shard": op3_shard,
    "op4_quotation": op4_quotation,
    "op5_html_text": op5_html_text,
    "op6_kneser_ney": op6_kneser_ney,
    "op7_decontaminate": op7_decontaminate,
    "op8_language": op8_language,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_order_minhash": op10_order_minhash,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_bpe": op13_bpe,
}
