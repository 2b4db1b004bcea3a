"""Each stage of the pipeline on its own input, and the whole."""

import collections

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from llm_helpers import SF, DOCUMENT, documents, grams, prose, words  # noqa: F401

STAGES = dict(corpus_pipeline.STAGES)


def ids(df):
    return sorted(r["doc_id"] for r in df.collect())


def test_it_is_registered():
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    assert list(STAGES) == ["language", "near_duplicates", "repeats", "decontamination", "packing"]
    numbers = sorted(int(n[2:].split("_")[0]) for n in contract.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14))


def test_stages_keep_columns_and_clean_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit("extra"))
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns
        rows = after.collect()
        assert 0.5 * docs.count() < len(rows) <= docs.count(), name
        docs = spark.createDataFrame(rows, after.schema)
    packed = STAGES["packing"](spark, docs, SF).toPandas()
    assert 0 < packed.doc_id.nunique() <= n and packed.sequence_id.nunique() <= packed.length.sum() // 4096 + 2


def test_one_document_of_each_group_stays(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = STAGES["near_duplicates"](spark, docs, SF).collect()
    sets = [grams(r["text"]) for r in kept]
    owners = collections.defaultdict(set)
    for i, own in enumerate(sets):
        for g in own:
            owners[g].add(i)
    pairs = {tuple(sorted(p)) for own in owners.values() if len(own) > 1 for p in [(a, b) for a in own for b in own if a < b]}
    assert all(len(sets[a] & sets[b]) < 0.8 * len(sets[a] | sets[b]) for a, b in pairs)
    assert min(r["doc_id"] for r in docs.collect()) in {r["doc_id"] for r in kept}


def test_cut_texts_and_their_lengths(spark, documents, prose):  # noqa: F811
    shared = prose(60, 1)
    docs = documents((1, f"{shared} one  two"), (2, f"zero {shared}"), (3, "a  b"), (4, None))
    found = {r["doc_id"]: (r["text"], r["n_chars"]) for r in STAGES["repeats"](spark, docs, SF).collect()}
    assert found == {1: ("one two", 7), 2: ("zero", 4), 3: ("a  b", 4), 4: (None, None)}


def test_leaking_documents_go(spark, documents):  # noqa: F811
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    assert ids(STAGES["decontamination"](spark, documents((1, f"so {item} and on"), (2, "fine"), (3, None)), SF)) == [2, 3]


@pytest.mark.parametrize("name", STAGES)
def test_stages_take_empty_tables(spark, name):
    assert STAGES[name](spark, spark.createDataFrame([], DOCUMENT), SF).count() == 0


def test_the_whole(spark):
    found = corpus_pipeline.run(spark, SF).toPandas()
    assert found.length.max() <= 4096 and not found.duplicated(["doc_id", "piece"]).any()
    for _, sequence in found.sort_values("offset").groupby("sequence_id"):
        assert (sequence.offset.diff().dropna().values == sequence.length.values[:-1]).all()
