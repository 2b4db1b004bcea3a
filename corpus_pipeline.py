"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before it kept, and gives
the rows that go on, with the columns of ``documents``; the last gives the packed pieces.

* language: rows that language ID rejects go (undetermined or ambiguous);
* near_duplicates: one row of each class of the n-gram Jaccard join stays;
* repeats: repeated passages are cut from the texts; a text without one stays as it is;
* decontamination: rows that leak a benchmark item go;
* packing: what is left, as places of token pieces in sequences.

All stages accept empty tables, null or empty texts, repeated rows and extra columns, as the
operators' docstrings say. Rows without a letter are undetermined, hence rejected by the first.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegrid.llm import decontamination, language_id, ngram_join, packing, substring_dedup
from tidegrid.llm.queries import TOKENIZER, held_out
from tidegrid.session import configure, materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.train(docs, ~held_out(F.col("doc_id")))
    told = language_id.identify(docs, model)
    kept = told.where((F.col("lang_pred") != language_id.UNDETERMINED) & ~F.col("ambiguous"))
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.distinct_documents(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(docs)
    changed = F.col("n_removed") > 0
    columns = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(changed, F.length("kept").cast(docs.schema["n_chars"].dataType)).otherwise(
            F.col("n_chars"))
    return cut.withColumns(columns).select(*(F.col(f"`{c}`") for c in docs.columns))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.clean(docs, benchmark)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack(docs, public_tokenizers.path(TOKENIZER))
    return pieces.withColumnRenamed("id", "doc_id")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("decontamination", decontaminated),
    ("packing", packed),
]

# Language ID, MinHash and a tokenizer have no SQL counterpart; tests compare the stages with
# brute force.
ORACLE_SQL = None

# Rows of very long texts reach Python in batches of this size at most, or one row; both sides of
# the exchange hold a batch several times.
BATCH_BYTES = "8m"


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
