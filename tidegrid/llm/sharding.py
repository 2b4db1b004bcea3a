"""Shards by rendezvous hashing, as columns: no Python runs on the executors.

Every shard draws a number for a record's key, ``-weight / ln(u)`` with u a hash of key and shard
spread over (0, 1); the largest wins. A key's shard depends on nothing but the key, the shards
and their weights: a new shard takes the keys for which it draws the largest number, and no other
key moves; a shard gets its share of the weights.

``numbered`` gives the rows of each shard places without a gap. It counts equal rows first, so a
key that many rows share is one row to it, and numbers the counts in BUCKETS buckets by hash for
each shard; only bucket totals, as many as shards times buckets, are numbered across buckets.

Defined results: a null key is a key like any other; rows with equal keys share a shard; null
texts have no bytes; repeated rows get a place each; an empty table gives an empty result; extra
columns are handed on by ``with_shard``, which replaces a column of the result's name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegrid.session import materialize

BUCKETS = 1024
SPLIT = 10_000


def shard_of(key: Column, weights: list[float]) -> Column:
    """The shard, 0 to len(weights) - 1, of a key. A shard of weight 0 gets nothing."""
    draws = []
    for shard, weight in enumerate(weights):
        if weight > 0:
            bits = F.shiftrightunsigned(F.xxhash64(F.lit(shard), key), 11).cast("double")
            draws.append(F.struct((F.lit(float(weight)) / -F.log((bits + 0.5) / float(1 << 53))).alias("draw"),
                                  F.lit(shard).alias("shard")))
    if not draws:
        raise ValueError("some shard needs a weight above 0")
    return (F.greatest(*draws) if len(draws) > 1 else draws[0])["shard"]


def with_shard(df: DataFrame, key: str, weights: list[float], name: str = "shard") -> DataFrame:
    return df.withColumn(name, shard_of(F.col(key), weights))


def numbered(df: DataFrame, shard: str = "shard", name: str = "slot", buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``df`` with their places, from 0 and gapless, in their shards."""
    columns = [F.col(f"`{c}`") for c in df.columns if c != name]
    rows = df.select(*columns)
    bucket = F.pmod(F.xxhash64(*columns), F.lit(buckets)).alias("_bucket")
    counted = materialize(rows.groupBy(*columns, bucket).agg(F.count("*").alias("_n")), "shard-counts")
    cell = [F.col(f"`{shard}`"), F.col("_bucket")]
    totals = counted.groupBy(*cell).agg(F.sum("_n").alias("_total"))
    before = Window.partitionBy(shard).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = materialize(totals.select(F.col(f"`{shard}`").alias("_shard"), F.col("_bucket").alias("_of"),
                                       F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before")),
                         "shard-totals")
    inside = Window.partitionBy(*cell).orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.join(totals, cell[0].eqNullSafe(F.col("_shard")) & (cell[1] == F.col("_of")))
    first = (F.col("_before") + F.coalesce(F.sum("_n").over(inside), F.lit(0))).alias("_first")
    placed = placed.select(*columns, "_n", first)
    last = F.col("_first") + F.col("_n") - 1
    once = placed.where("_n = 1").select(*columns, F.col("_first").alias(name))
    parts = placed.where("_n > 1").withColumn(
        "_from", F.explode(F.sequence("_first", last, F.lit(SPLIT)))).withColumn(
        "_to", F.least(F.col("_from") + SPLIT - 1, last)).repartition("_from")
    return once.unionByName(parts.select(*columns, F.explode(F.sequence("_from", "_to")).alias(name)))
