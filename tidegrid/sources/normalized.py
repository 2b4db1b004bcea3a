"""The normalised position table: typed, in event-time order, partitioned by UTC day."""

from __future__ import annotations

import json
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidegrid.constants import TEXT_LOG_PATTERN
from tidegrid.session import configure, is_complete, materialize, remove, stored_bytes
from tidegrid.sources import publication, raw_csv, ships

# Documented layout of monotonically_increasing_id: partition number above 33 bits.
PARTITION_BITS = 33

# Compressed columns per sort task. The number of tasks follows the data, where the session
# default would stay at 200 for a log of any size.
SORT_PARTITION_BYTES = 64 << 20

CODEC = "zstd"
STAGED_SCHEMA = (
    "ship_id string, shiptype int, speed double, lon double, lat double, course int, "
    "heading int, ts timestamp, departure_port_name string, reported_draught int, "
    "trip_id string, log_file string, log_block bigint, log_line bigint, "
    "reject_reason string, raw_record string")
POSITIONS_SCHEMA = (
    "ship_id string, shiptype int, speed double, lon double, lat double, course int, "
    "heading int, ts timestamp, departure_port_name string, reported_draught int, "
    "trip_id string, arrival bigint, event_date date")


def sort_partitions(spark: SparkSession, size: int) -> int:
    return max(ceil(size / SORT_PARTITION_BYTES), spark.sparkContext.defaultParallelism)


def in_event_time_order(df: DataFrame, *tie_break: str, partitions: int | None = None
                        ) -> DataFrame:
    """Range-partitioned and sorted by time, with the position in that order as ``arrival``.

    The tie-break belongs to the partitioning too: a single minute that holds a large part
    of the log is then split over partitions like any other range. The day leads the sort,
    which changes nothing in the order but spares the writer a sort of its own.
    """
    size = [partitions] if partitions else []
    return (df.withColumn("event_date", F.to_date("ts"))
            .repartitionByRange(*size, "ts", *tie_break)
            .sortWithinPartitions("event_date", "ts", *tie_break)
            .withColumn("arrival", F.monotonically_increasing_id()))


def write_positions(ordered: DataFrame, path: str) -> DataFrame:
    """Store an ordered frame by day, once; an already complete table is left as it is."""
    spark = ordered.sparkSession
    if not is_complete(spark, path):
        (ordered.write.mode("overwrite").option("compression", CODEC)
         .partitionBy("event_date").parquet(path))
    return spark.read.schema(ordered.schema).parquet(path)


def ingest(spark: SparkSession, csv_path: str, out_dir: str, source_tz: str = "UTC",
           draught_compat: bool = False) -> tuple[DataFrame, DataFrame]:
    """Raw log to (positions, rejects), both stored under ``out_dir``. Rejects keep the text
    of their record. What is stored is used again, but only for the same unchanged files and options.

    The text is parsed once, into a staged table: range partitioning samples its input, and
    rejects need it too, so both read the staged columns instead of the text. Row groups
    without rejects are skipped when reading those.
    """
    staged, positions = f"{out_dir}/staged", f"{out_dir}/positions"
    configure(spark)
    _same_input(spark, csv_path, out_dir, source_tz=source_tz, draught_compat=draught_compat)
    if not is_complete(spark, staged):
        parsed = raw_csv.parse(raw_csv.scan(spark, csv_path), source_tz, draught_compat)
        parsed.write.mode("overwrite").option("compression", CODEC).parquet(staged)
    stored = spark.read.schema(STAGED_SCHEMA).parquet(staged)
    rejects = raw_csv.rejected(stored)
    if is_complete(spark, positions):
        return spark.read.schema(TAKEN_IN_SCHEMA).parquet(positions), rejects
    good = raw_csv.accepted(stored)
    return _store_in_order(good, stored_bytes(spark, staged), positions), rejects


def _store_in_order(records: DataFrame, size: int, path: str) -> DataFrame:
    """Number records by time and place in the log, and store them by day."""
    partitions = sort_partitions(records.sparkSession, size)
    ordered = in_event_time_order(records, *raw_csv.LOG_ORDER, partitions=partitions)
    return write_positions(ordered.drop(*raw_csv.LOG_ORDER), path)


def _same_input(spark: SparkSession, path: str, out_dir: str, **options) -> None:
    """Note the files and options that ``out_dir`` is made from; raise if they have changed.

    A file is its path, length and time of modification; contents are not read.
    """
    told = ("path", "length", F.unix_micros("modificationTime"))
    files = spark.read.format("binaryFile").load(path).agg(
        F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
        F.sum(F.xxhash64(*told).cast("decimal(20,0)")).alias("sum"),
        F.bit_xor(F.xxhash64(F.lit("xor"), *told)).alias("xor")).first()
    digest = f"{files['sum']} {files['xor']}"
    now = json.dumps({"files": files["files"], "bytes": files["bytes"], "digest": digest, **options}, sort_keys=True)
    noted = f"{out_dir}/input"
    if not is_complete(spark, noted):
        spark.createDataFrame([(now,)], "value string").write.mode("overwrite").text(noted)
        return
    before = spark.read.text(noted).first()["value"]
    if before != now:
        raise ValueError(f"{out_dir} was made from other files or options: {before}, now {now}")


TAKEN_IN_SCHEMA = f"{POSITIONS_SCHEMA}, ship_no bigint"
MANIFEST_SCHEMA = "path string, length bigint, modified bigint, lines bigint"
# An arrival number of a table that grows: the minute, and the place among the records of that minute.
MINUTE_BITS = 34


def take_in(spark: SparkSession, csv_path: str, out_dir: str, source_tz: str = "UTC",
            draught_compat: bool = False) -> tuple[DataFrame, DataFrame]:
    """Take in what is new in a raw log: (positions, rejects) of all that was taken in so far.

    A manifest notes the files of each run with their lengths and lines. New files are read, and of
    files that grew the lines that were added (a log ends in a whole line). A file that became shorter,
    or other at the same length, raises. Nothing that is stored is read again but counts per minute.

    ``arrival`` orders all records by (time, place in the log), runs following each other, and a
    record's number never changes: it is the minute with the place among that minute's records, to which
    later runs only add. ``ship_no`` is the ship's number in the dictionary below ``ships``. Each run is sorted by itself; its files join the table in event order, so a
    stream can read the table as it grows. A run counts once its manifest is written; what broke off
    before is done again, what broke off after is finished by the next call.
    """
    configure(spark)
    manifest, positions, staged = (f"{out_dir}/{name}" for name in ("manifest", "positions", "staged"))
    run, fresh = _what_is_new(spark, csv_path, manifest)
    if run:
        publication.reveal(spark, positions, run - 1)
    if fresh:
        paths = [row["path"] for row in fresh]
        parsed = raw_csv.parse(raw_csv.scan(spark, paths), source_tz, draught_compat)
        parsed.write.mode("overwrite").option("compression", CODEC).parquet(f"{staged}/run={run}-all")
        lines = _numbered_lines(spark.read.schema(STAGED_SCHEMA).parquet(f"{staged}/run={run}-all"))
        taken = spark.createDataFrame([(row["path"], row["lines"]) for row in fresh], "log_file string, taken bigint")
        new = lines.join(taken, "log_file").where("log_line >= taken").drop("taken")
        new.write.mode("overwrite").option("compression", CODEC).parquet(f"{staged}/run={run}")
        good = raw_csv.accepted(_taken_in(spark, staged, run))
        good = ships.with_numbers(good, ships.add_ships(good, f"{out_dir}/ships", run))
        size = stored_bytes(spark, f"{staged}/run={run}")
        publication.stage(_in_minutes(good, spark, staged, run, size), positions, run, compression=CODEC)
        counts = lines.groupBy(F.col("log_file").alias("path")).agg(F.count("*").alias("lines"))
        told = spark.createDataFrame([(r["path"], r["length"], r["modified"]) for r in fresh],
                                     "path string, length bigint, modified bigint")
        told.join(counts, "path", "left").select(
            "path", "length", "modified", F.coalesce("lines", F.lit(0)).alias("lines")).write.mode(
            "overwrite").parquet(f"{manifest}/run={run}")
        publication.reveal(spark, positions, run)
        remove(spark, f"{staged}/run={run}-all")
        run += 1
    rejects = raw_csv.rejected(_taken_in(spark, staged, *range(run)))
    return spark.read.schema(TAKEN_IN_SCHEMA).parquet(positions), rejects


def _taken_in(spark: SparkSession, staged: str, *runs: int) -> DataFrame:
    return spark.read.schema(STAGED_SCHEMA).parquet(*[f"{staged}/run={run}" for run in runs])


def _what_is_new(spark: SparkSession, path: str, manifest: str) -> tuple[int, list]:
    """The number of the next run, and (path, length, modified, lines taken before) of its files."""
    now = spark.read.format("binaryFile").load(path).select(
        "path", "length", F.unix_micros("modificationTime").alias("modified"))
    run = 0
    while is_complete(spark, f"{manifest}/run={run}"):
        run += 1
    if not run:
        return 0, now.withColumn("lines", F.lit(0)).orderBy("path").collect()
    noted = spark.read.schema(MANIFEST_SCHEMA).parquet(*[f"{manifest}/run={r}" for r in range(run)])
    before = noted.groupBy("path").agg(*[
        F.max(c).alias(f"_{c}") for c in ("length", "lines")], F.max_by("modified", "length").alias("_modified"))
    both = now.join(before, "path", "left")
    same = (F.col("length") == F.col("_length")) & (F.col("modified") == F.col("_modified"))
    other = both.where(F.col("_length").isNotNull() & ~same & (F.col("length") <= F.col("_length")))
    replaced = other.select("path").limit(1).collect()
    if replaced:
        raise ValueError(f"{replaced[0]['path']} was replaced since it was taken in")
    fresh = both.where(F.col("_length").isNull() | ~same).select(
        "path", "length", "modified", F.coalesce("_lines", F.lit(0)).alias("lines"))
    return run, fresh.orderBy("path").collect()


def _numbered_lines(staged: DataFrame) -> DataFrame:
    """``log_line`` as the number of the line in its file, from 0: the place in its block, after the
    lines of the blocks before, of which there is a row each."""
    blocks = staged.groupBy("log_file", "log_block").agg(
        F.min("log_line").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("log_file").orderBy("log_block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = materialize(blocks.select("log_file", "log_block", (
        F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift")), "log-blocks")
    return staged.join(shifts, ["log_file", "log_block"]).withColumn(
        "log_line", F.col("log_line") + F.col("shift")).select(*staged.columns)


def _minute(ts: Column) -> Column:
    return F.floor(F.unix_micros(ts) / 60_000_000)


def _in_minutes(records: DataFrame, spark: SparkSession, staged: str, run: int, size: int) -> DataFrame:
    """The records of a run in event order, with their arrival numbers."""
    order = ("ts", *raw_csv.LOG_ORDER)
    by_range = records.withColumn("event_date", F.to_date("ts")).repartitionByRange(
        sort_partitions(spark, size), *order).sortWithinPartitions("event_date", *order)
    ordered = materialize(by_range.withColumns(
        {"minute": _minute(F.col("ts")), "id": F.monotonically_increasing_id()}), "taken-in")
    part = F.shiftright("id", PARTITION_BITS)
    sizes = ordered.groupBy("minute", part.alias("part")).agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("minute").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("minute", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    if run:
        earlier = raw_csv.accepted(_taken_in(spark, staged, *range(run))).groupBy(
            _minute(F.col("ts")).alias("minute")).agg(F.count("*").alias("taken"))
        shifts = shifts.join(earlier, "minute", "left").select(
            "minute", "part", (F.col("shift") + F.coalesce("taken", F.lit(0))).alias("shift"))
    shifts = materialize(shifts, "minute-shifts")
    place = F.col("id") + F.col("shift")
    return (ordered.withColumn("part", part).join(shifts, ["minute", "part"])
            .withColumn("arrival", F.shiftleft("minute", MINUTE_BITS) + place)
            .drop(*raw_csv.LOG_ORDER, "minute", "part", "id", "shift"))


def replay_numbers(positions: DataFrame, bits: int = PARTITION_BITS) -> DataFrame:
    """Gap-free position in event-time order, ``replay_seq``, from 0.

    ``arrival`` holds the range partition and the place within it; only the sizes of the
    partitions before are missing. They come from a count per partition: one row for each
    partition the table was written from (or for each minute, with MINUTE_BITS).
    """
    partition = F.shiftright("arrival", bits)
    sizes = positions.groupBy(partition.alias("part")).agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bounds = materialize(
        sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before")),
        "partition-bounds")
    place = F.col("arrival").bitwiseAND(F.lit((1 << bits) - 1))
    return (positions.withColumn("part", partition)
            .join(bounds, "part")
            .withColumn("replay_seq", F.col("before") + place)
            .drop("part", "before"))


TEXT_FIELDS = (
    "ship_id", "shiptype", "speed", "lon", "lat", "course", "heading", "ts",
    "departure_port_name", "reported_draught", "trip_id")


def to_text_log(positions: DataFrame) -> DataFrame:
    """One text line per record, with the time as ``Thu Mar 05 10:15:00 UTC 2015``."""
    fields = [F.date_format("ts", TEXT_LOG_PATTERN) if c == "ts" else F.col(c).cast("string")
              for c in TEXT_FIELDS]
    fields = [F.coalesce(field, F.lit("")) for field in fields]
    return positions.select(F.concat_ws(",", *fields).alias("value"))


def from_text_log(lines: DataFrame, *extra: str) -> DataFrame:
    """The reverse of ``to_text_log``. Spark parses no day names, so the first four
    characters of the time are skipped; the date says the same."""
    f = F.split("value", ",")
    casts = dict(zip(TEXT_FIELDS, (
        "string", "int", "double", "double", "double", "int", "int", None,
        "string", "int", "string")))
    return lines.select(*[
        (F.try_to_timestamp(F.substring(F.get(f, F.lit(i)), 5, 64), F.lit(TEXT_LOG_PATTERN[4:])) if kind is None
         else F.get(f, F.lit(i)).try_cast(kind)).alias(name)
        for i, (name, kind) in enumerate(casts.items())], *extra)


def _parsed_text_log(spark: SparkSession, path: str) -> DataFrame:
    lines = raw_csv.with_place(spark.read.text(path))
    records = from_text_log(lines, "value", *raw_csv.LOG_ORDER)
    return raw_csv.with_reject_reason(records).withColumnRenamed("value", "raw_record")


def import_text_log(spark: SparkSession, path: str, out_dir: str) -> DataFrame:
    """An already normalised text log to stored positions; see ``text_log_rejects``."""
    positions = f"{out_dir}/positions"
    configure(spark)
    _same_input(spark, path, out_dir)
    if is_complete(spark, positions):
        return spark.read.schema(POSITIONS_SCHEMA).parquet(positions)
    good = raw_csv.accepted(_parsed_text_log(spark, path))
    return _store_in_order(good, stored_bytes(spark, path), positions)


def text_log_rejects(spark: SparkSession, path: str) -> DataFrame:
    """(raw_record, reject_reason) of the lines that ``import_text_log`` leaves out."""
    configure(spark)
    return raw_csv.rejected(_parsed_text_log(spark, path)).select("raw_record", "reject_reason")
