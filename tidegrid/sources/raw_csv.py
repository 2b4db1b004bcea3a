"""Ingest of the raw position log.

The log is comma separated without quoting, with a header line, two timestamp formats and
blank fields. A record with a bad field is kept aside with the reason instead of failing
the job. A bad draught is no reason: it reads as 0 and no report uses it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegrid.constants import RAW_DASH_PATTERNS, RAW_SLASH_PATTERNS
from tidegrid.schema import RAW_SCHEMA

LOG_ORDER = ("log_file", "log_block", "log_line")


def with_place(lines: DataFrame) -> DataFrame:
    """Add each line's place in the log. ``log_line`` grows along the lines of one file
    block, so with file and block it orders the whole log without a sort."""
    return lines.select(
        "*",
        F.col("_metadata.file_path").alias("log_file"),
        F.col("_metadata.file_block_start").alias("log_block"),
        F.monotonically_increasing_id().alias("log_line"))


def scan(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The raw fields as text, and each line's place in the log."""
    return with_place(spark.read.schema(RAW_SCHEMA)
                      .option("header", True).option("quote", "")
                      .option("mode", "PERMISSIVE").csv(path))


def parse_timestamp(text: Column, source_tz: str = "UTC") -> Column:
    """Day-first text with slashes or dashes and a year of two or four digits. The pattern
    is picked by looking, because a failed parse costs far more than a good one."""
    date = F.substring_index(text, " ", 1)

    def by_year(separator: str, patterns: tuple[str, str]) -> Column:
        short, long = (F.try_to_timestamp(text, F.lit(p)) for p in patterns)
        return F.when(F.substring(date, -3, 1) == F.lit(separator), short).otherwise(long)

    ts = (F.when(text.contains("/"), by_year("/", RAW_SLASH_PATTERNS))
           .otherwise(by_year("-", RAW_DASH_PATTERNS)))
    return ts if source_tz == "UTC" else F.to_utc_timestamp(ts, source_tz)


def _blank(text: Column) -> Column:
    return F.coalesce(F.trim(text), F.lit("")) == F.lit("")


def heading_or_zero(text: Column) -> Column:
    """Blank is 0; other text that is no number stays null and gets the record rejected."""
    return F.when(_blank(text), F.lit(0)).otherwise(text.try_cast("int"))


def draught_or_zero(text: Column, compat: bool = False) -> Column:
    """Blank, quoted blank and unreadable are 0; with ``compat`` every draught is 0."""
    if compat:
        return F.lit(0)
    bare = F.replace(text, F.lit('"'))
    number = F.coalesce(F.trim(bare).try_cast("int"), F.lit(0))
    return F.when(_blank(bare), F.lit(0)).otherwise(number)


def without_parentheses(text: Column) -> Column:
    whole = F.coalesce(text, F.lit(""))
    return F.replace(F.replace(whole, F.lit("(")), F.lit(")"))


def parse(raw: DataFrame, source_tz: str = "UTC", draught_compat: bool = False) -> DataFrame:
    """Typed fields, plus ``reject_reason``: the names of the fields that could not be read,
    null for a good record, and ``raw_record``: the fields of a bad one as they were."""
    typed = raw.select(
        without_parentheses(F.col("ship_id")).alias("ship_id"),
        F.col("shiptype").try_cast("int").alias("shiptype"),
        F.col("speed").try_cast("double").alias("speed"),
        F.col("lon").try_cast("double").alias("lon"),
        F.col("lat").try_cast("double").alias("lat"),
        F.col("course").try_cast("int").alias("course"),
        heading_or_zero(F.col("heading")).alias("heading"),
        parse_timestamp(F.col("timestamp"), source_tz).alias("ts"),
        without_parentheses(F.col("departure_port_name")).alias("departure_port_name"),
        draught_or_zero(F.col("reported_draught"), draught_compat).alias("reported_draught"),
        F.nullif(without_parentheses(F.col("trip_id")), F.lit("")).alias("trip_id"),
        *LOG_ORDER,
        F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in RAW_SCHEMA.fieldNames()]).alias("raw_record"))
    found = with_reject_reason(typed)
    return found.withColumn("raw_record", F.when(F.col("reject_reason").isNotNull(), F.col("raw_record")))


def with_reject_reason(typed: DataFrame) -> DataFrame:
    required = ("shiptype", "speed", "lon", "lat", "course", "heading", "ts", "trip_id")
    bad = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
    return typed.withColumn("reject_reason", F.nullif(bad, F.lit("")))


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNull()).drop("reject_reason", "raw_record")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNotNull())
