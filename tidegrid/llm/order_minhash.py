"""Order MinHash fingerprints: signatures that follow edit distance, not only shared content.

The k-mers of a text are its runs of K code points, numbered by occurrence. Each of SKETCHES
hash functions selects the TUPLE numbered k-mers with the least hashes, keeps them in the order
in which they stand in the text, and hashes that tuple. The likeness of two fingerprints is the
share of equal hashes: texts made of the same pieces in another order are not alike.

Defined results: a null text counts as empty; a text shorter than K is one k-mer, the empty text
included; a text of fewer than TUPLE k-mers has a shorter tuple; equal texts have equal
fingerprints; texts of any length are hashed whole. ``with_edits`` orders rows by id, largest
first, then by text, and nulls last; after the last row comes the first, and a lone row is its
own next. Equal ids share a task. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tidegrid.llm.shipping import ship
from tidegrid.llm.words import _window_sums, mixed
from tidegrid.session import materialize

K = 12
TUPLE = 2
SKETCHES = 32

_BASE = 0x94D049BB133111EB
_FACTORS = mixed(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


def _numbered_kmers(points: np.ndarray) -> np.ndarray:
    """A hash of each k-mer and of how often it occurred before, in text order."""
    values = mixed(points.astype(np.uint64) + np.uint64(1))
    starts = np.arange(max(1, len(points) - K + 1))
    found = mixed(_window_sums(values, starts, np.minimum(starts + K, len(points)), _BASE))
    order = np.argsort(found, kind="stable")
    ranked = found[order]
    heads = np.append(True, ranked[1:] != ranked[:-1])
    if not heads.all():
        first = np.maximum.accumulate(np.where(heads, np.arange(len(ranked)), 0))
        number = np.empty(len(ranked), np.uint64)
        number[order] = (np.arange(len(ranked)) - first).astype(np.uint64)
        again = number > 0
        found[again] = mixed(found[again] + number[again] * np.uint64(0xA24BAED4963EE407))
    return found


def signature(text: str) -> np.ndarray:
    """SKETCHES 32-bit hashes."""
    kmers = _numbered_kmers(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"))
    chosen = np.empty((SKETCHES, min(TUPLE, len(kmers))), np.int64)
    drawn = np.empty_like(kmers)
    for i in range(SKETCHES):
        np.multiply(kmers, _FACTORS[i], out=drawn)
        for j in range(chosen.shape[1]):
            chosen[i, j] = place = drawn.argmin()
            drawn[place] = _LAST
    chosen.sort(axis=1)
    total = _FACTORS.copy()
    for column in kmers[chosen].T:
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + column)
    return (total >> np.uint64(32)).astype(np.uint32)


def shown(found: np.ndarray) -> str:
    return found.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal hashes of two signatures, 0 to 1."""
    return float((a == b).mean())


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype(np.uint32)


def fingerprints(df: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """The rows of ``df`` with the fingerprint of a text column; replaces a column of that name."""
    ship(df.sparkSession)

    @F.pandas_udf("string")
    def of(texts):
        return texts.fillna("").map(lambda t: shown(signature(t)))
    return df.withColumn(name, of(F.col(text)))


def edited(text: str, following: str) -> str:
    """The last half of a text replaced by as much of the beginning of another."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_TOLD = [
    StructField("n_chars", LongType()), StructField("edited_sha256", StringType()),
    StructField("fingerprint", StringType()), StructField("edited_fingerprint", StringType()),
    StructField("near_edited", DoubleType()), StructField("near_next", DoubleType()),
]
_ENDS = [StructField("part", LongType()), StructField("first_text", StringType()),
         StructField("first_print", StringType()), StructField("last_text", StringType())]


def _row(text: str, own: np.ndarray, following: str, next_print: np.ndarray) -> dict:
    """What ``with_edits`` tells of a text and the one after it."""
    new = edited(text, following)
    changed = own if new == text else signature(new)
    return {"n_chars": len(text), "edited_sha256": hashlib.sha256(new.encode()).hexdigest(),
            "fingerprint": shown(own), "edited_fingerprint": shown(changed),
            "near_edited": likeness(own, changed), "near_next": likeness(own, next_print)}


def _in_order(schema: pa.Schema):
    """Rows of a sorted partition, each with the next one; the last one waits for its next."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # id, part, text and signature of the row before
        first: dict = {}
        for batch in batches:
            out = []
            for row_id, part, text in zip(*(batch.column(c).to_pylist() for c in ("id", "part", "text"))):
                text = text or ""
                own = held[3] if held and held[2] == text else signature(text)
                if held is None:
                    first = {"first_text": text, "first_print": shown(own)}
                else:
                    out.append({"id": held[0], "part": held[1], **_row(held[2], held[3], text, own), **first})
                    first = {}
                held = (row_id, part, text, own)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if held is not None:
            last = {"id": held[0], "part": held[1], "last_text": held[2], "fingerprint": shown(held[3])}
            yield pa.RecordBatch.from_pylist([{**last, **first}], schema)
    return run


def with_edits(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Per row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text with its last half replaced by the beginning of the next row's.
    Rows are range-partitioned and sorted by id, and a task goes through its rows once; only the
    first and last row of each partition are matched across partitions.
    """
    spark = ship(df.sparkSession)
    order = [F.col("id").desc_nulls_last(), F.col("text").desc_nulls_last()]
    rows = df.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text"))
    row_id = StructField("id", rows.schema["id"].dataType)
    result, told = StructType([row_id, *_TOLD]), StructType([row_id, *_TOLD, *_ENDS])
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (rows.repartitionByRange(n, order[0]).sortWithinPartitions(*order)
              .withColumn("part", F.spark_partition_id().cast("long")))
    found = materialize(ranged.mapInArrow(_in_order(to_arrow_schema(told)), told), "omh-rows")

    # One row for each partition that has rows; the window sorts their numbers only.
    firsts = found.where("first_text IS NOT NULL").select("part", "first_text", "first_print")
    inside = Window.orderBy("part")
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = firsts.select("part", F.coalesce(
        F.lead("part").over(inside), F.first("part").over(whole)).alias("next_part"))
    ends = (found.where("last_text IS NOT NULL").select("id", "part", "last_text", "fingerprint")
            .join(following, "part").join(firsts.withColumnRenamed("part", "next_part"), "next_part")
            .select("id", "last_text", "fingerprint", "first_text", "first_print"))
    schema = to_arrow_schema(result)

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([
                {"id": r["id"], **_row(r["last_text"], read(r["fingerprint"]), r["first_text"],
                                       read(r["first_print"]))} for r in batch.to_pylist()], schema)
    inner = found.where("last_text IS NULL").select(*result.names)
    return inner.unionByName(ends.mapInArrow(finish, result))
