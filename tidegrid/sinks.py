"""Result files: one comma-separated line per row, without header or quotes.

A rank list such as ``{I34, D20}`` holds commas and is still written bare, so a CSV writer,
which would quote it, does not fit; readers split at commas outside braces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

COMMA_OUTSIDE_BRACES = r",(?![^{]*\})"


def as_lines(rows: DataFrame) -> DataFrame:
    """One text column, for a text sink in batch or stream."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rows.columns]
    return rows.select(F.concat_ws(",", *fields).alias("value"))


def write_lines(rows: DataFrame, path: str) -> None:
    as_lines(rows).write.text(path)


def read_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    fields = F.split("value", COMMA_OUTSIDE_BRACES)
    return spark.read.text(path).select(*[
        fields[i].cast(field.dataType).alias(field.name) for i, field in enumerate(schema)])
