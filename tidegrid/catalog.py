"""Every operator and report as a query over the test tables.

Each takes (spark, sf_dir). What several of them read (the printed raw log, the ingested
table, the replay feed) is written once per application, below the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidegrid import metrics, sinks
from tidegrid.constants import MONTH_DAYS, WEEK_DAYS
from tidegrid.functions import (
    cell_name, day_slot, event_window, in_area, sea_label, sea_name, ship_class, window_label)
from tidegrid.operators import aggregates, filters
from tidegrid.operators.grid import with_sector
from tidegrid.plans import q1, q2
from tidegrid.schema import Q1_RENDERED_SCHEMA, Q2_RENDERED_SCHEMA
from tidegrid.session import configure, materialize, new_workspace, stored_bytes
from tidegrid.sources import clustered, events, normalized, raw_csv, replay, ships
from tidegrid.streaming import cumulative, job as stream_job, late, open_windows, periods, ranking_state, reports, runner

Query = Callable[[SparkSession, str], DataFrame]

FIRST_ARRIVALS = 100  # the depth of the top-n report
FILES_PER_TRIGGER = 16

_written: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], object]):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        _written[key] = write(new_workspace(spark, name))
    return _written[key]


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.positions(configure(spark), sf_dir)


# -- shared inputs -------------------------------------------------------------------------

def raw_log(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> str:
        events.write_raw_log(events.read_events(configure(spark), sf_dir), path)
        return path
    return _once(spark, sf_dir, "raw-log", write)


def ingested(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    log = raw_log(spark, sf_dir)
    return _once(spark, sf_dir, "ingest", lambda out: normalized.ingest(spark, log, out))


def position_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived positions as a normalised table: ordered, numbered, one folder per day."""
    def write(path: str) -> DataFrame:
        rows = positions(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
        return normalized.write_positions(normalized.in_event_time_order(rows, "event_id"), path)
    return _once(spark, sf_dir, "positions", write)


def numbered_days(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The same table with ship numbers, and the dictionary of the ships."""
    def write(path: str) -> tuple[DataFrame, DataFrame]:
        rows = position_days(spark, sf_dir)
        known = ships.add_ships(rows, f"{path}/ships", 0)
        return normalized.write_positions(ships.with_numbers(rows, known), f"{path}/positions"), known
    return _once(spark, sf_dir, "numbered", write)


def clustered_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table by place."""
    rows = position_days(spark, sf_dir)
    size = stored_bytes(spark, f"{sf_dir}/events.parquet")
    return _once(spark, sf_dir, "clustered", lambda path: clustered.write_clustered(rows, path, size))


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = position_days(spark, sf_dir)
    path = _once(spark, sf_dir, "feed", lambda out: replay.publish(days, out))
    return replay.read_feed(runner.streaming_session(spark), path, FILES_PER_TRIGGER)


# -- ingest --------------------------------------------------------------------------------

def _naive(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps without zone, as the test tables have them (the session zone is UTC)."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def ingest_csv(spark, sf_dir):
    good, _ = ingested(spark, sf_dir)
    return _naive(good.select(*normalized.TEXT_FIELDS), "ts")


def ingest_timestamps(spark, sf_dir):
    raw = raw_csv.scan(spark, raw_log(spark, sf_dir))
    parsed = raw.select("trip_id", raw_csv.parse_timestamp(F.col("timestamp")).alias("ts"))
    return _naive(parsed, "ts")


def ingest_defaults(spark, sf_dir):
    raw = raw_csv.scan(spark, raw_log(spark, sf_dir))
    draught = F.col("reported_draught")
    return raw.select(
        "trip_id",
        raw_csv.heading_or_zero(F.col("heading")).alias("heading"),
        raw_csv.draught_or_zero(draught).alias("draught"),
        raw_csv.draught_or_zero(draught, compat=True).alias("draught_compat"))


def ingest_rejects(spark, sf_dir):
    _, bad = ingested(spark, sf_dir)
    return bad.select("trip_id", "reject_reason")


def event_time_topn(spark, sf_dir):
    """The first arrivals of the log, in event-time order."""
    return (positions(spark, sf_dir).select("event_id", "ts", "ship_id")
            .orderBy("ts", "event_id").limit(FIRST_ARRIVALS))


def event_time_order(spark, sf_dir):
    """The place of every ingested record in the event-time order of the whole log."""
    good, _ = ingested(spark, sf_dir)
    return _naive(normalized.replay_numbers(good).select("trip_id", "ts", "replay_seq"), "ts")


PARTS = 3


def taken_in(spark: SparkSession, sf_dir: str) -> str:
    """Folder of a log that came in three parts, each taken in as it came."""
    def write(out: str) -> str:
        rows = events.read_events(configure(spark), sf_dir)
        last = rows.agg(F.max("event_id")).scalar()
        for part in range(PARTS):
            of_part = F.floor(F.col("event_id") * PARTS / (last + 1)) == part
            events.write_raw_log(rows.where(of_part), f"{out}/log/{part}")
            normalized.take_in(spark, f"{out}/log/*", f"{out}/ingest")
        return f"{out}/ingest"
    return _once(spark, sf_dir, "taken-in", write)


def ingest_incremental(spark, sf_dir):
    """The place of every record of that log in the order of the whole."""
    good = spark.read.schema(normalized.POSITIONS_SCHEMA).parquet(f"{taken_in(spark, sf_dir)}/positions")
    numbered = normalized.replay_numbers(good, normalized.MINUTE_BITS)
    return _naive(numbered.select("trip_id", "ts", "replay_seq"), "ts")


def text_log_roundtrip(spark, sf_dir):
    """The ingested table printed as a normalised text log, and imported again."""
    good, _ = ingested(spark, sf_dir)
    path = new_workspace(spark, "text-log")
    normalized.to_text_log(good).write.text(f"{path}/lines")
    imported = normalized.import_text_log(spark, f"{path}/lines", path)
    return _naive(imported.select(*normalized.TEXT_FIELDS), "ts")


# -- filters and functions -----------------------------------------------------------------

def bbox_filter(spark, sf_dir):
    return (positions(spark, sf_dir).transform(filters.within_area)
            .select("event_id", "lat", "lon"))


SECTOR = "E2"


def clustered_bbox_filter(spark, sf_dir):
    return (clustered_days(spark, sf_dir).transform(filters.within_area)
            .select("event_id", "lat", "lon"))


def clustered_sector_filter(spark, sf_dir):
    """The positions in one sector, by comparisons that pass over row groups elsewhere."""
    return filters.in_sector(clustered_days(spark, sf_dir), SECTOR).select("event_id", "lat", "lon")


def sea_west_filter(spark, sf_dir):
    return positions(spark, sf_dir).transform(filters.western).select("event_id", "lat", "lon")


def sea_east_filter(spark, sf_dir):
    return positions(spark, sf_dir).transform(filters.eastern).select("event_id", "lat", "lon")


def sea_label_query(spark, sf_dir):
    return positions(spark, sf_dir).select(
        "event_id", sea_label(F.col("lat"), F.col("lon")).alias("sea"))


def sector_assign(spark, sf_dir):
    return (positions(spark, sf_dir).transform(with_sector)
            .select("event_id", "lat", "lon", "sector"))


def shiptype_class(spark, sf_dir):
    return positions(spark, sf_dir).select(
        "event_id", "shiptype", ship_class(F.col("shiptype")).alias("ship_class"))


def day_slot_query(spark, sf_dir):
    return positions(spark, sf_dir).select("event_id", "ts", day_slot(F.col("ts")).alias("slot"))


def window_label_query(spark, sf_dir):
    # Spark allows one window per projection, hence two
    ts = F.col("ts")
    weeks = positions(spark, sf_dir).withColumn(
        "week_label", window_label(event_window(ts, WEEK_DAYS)["start"]))
    return weeks.select(
        "event_id", "week_label",
        window_label(event_window(ts, MONTH_DAYS)["start"]).alias("month_label"))


# -- windowed aggregates -------------------------------------------------------------------

def _sector() -> Column:
    return cell_name(F.col("cell")).alias("sector")


def window_counts(days: int) -> Query:
    def query(spark, sf_dir):
        counts = aggregates.window_counts(positions(spark, sf_dir), days)
        return counts.select("window_start", _sector(), "n")
    return query


def last_arrival_type(spark, sf_dir):
    totals = aggregates.class_totals(positions(spark, sf_dir), WEEK_DAYS)
    return totals.select("window_start", _sector(), "last_shiptype")


def daily_rollup(spark, sf_dir):
    rollup = aggregates.daily_rollup(positions(spark, sf_dir))
    return rollup.select(
        "day", _sector(), sea_name(F.col("west")).alias("sea"),
        *aggregates.CLASS_COLUMNS, "am", "pm", "last_shiptype")


def slot_counts(days: int) -> Query:
    def query(spark, sf_dir):
        rows, known = numbered_days(spark, sf_dir)
        totals = aggregates.with_ship_ids(aggregates.slot_totals_with_last_number(rows, days), known)
        return _naive(totals, "window_start", "last_ts").select(
            "window_start", _sector(), F.col("am").alias("am_num"), F.col("pm").alias("pm_num"),
            "last_ship_id", "last_lat", "last_lon", "last_ts")
    return query


# -- reports -------------------------------------------------------------------------------

def q1_report(days: int) -> Query:
    return lambda spark, sf_dir: q1.q1(positions(spark, sf_dir), days)


def q1_rendered(days: int) -> Query:
    return lambda spark, sf_dir: q1.rendered(q1.q1(positions(spark, sf_dir), days))


def stored_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(aggregates.daily_rollup(positions(spark, sf_dir)), "daily-rollup")


def q1_by_rollup(days: int) -> Query:
    return lambda spark, sf_dir: q1.q1_from_rollup(stored_rollup(spark, sf_dir), days)


def q2_by_rollup(days: int) -> Query:
    def query(spark, sf_dir):
        rollup = stored_rollup(spark, sf_dir)
        return q2.top_sectors(aggregates.slot_totals_from_rollup(rollup, days, by_sea=True))
    return query


def q2_top3(days: int) -> Query:
    return lambda spark, sf_dir: q2.q2_top3(positions(spark, sf_dir), days)


def q2_rendered(days: int) -> Query:
    return lambda spark, sf_dir: q2.q2_rendered(q2.q2_top3(positions(spark, sf_dir), days))


def over_stored_totals(plan: Callable[[DataFrame, int], DataFrame], days: int) -> Query:
    return lambda spark, sf_dir: plan(
        q2.stored_slot_totals(positions(spark, sf_dir), days), days)


# -- streams -------------------------------------------------------------------------------

def stream_q1(days: int) -> Query:
    def query(spark, sf_dir):
        stream = reports.stream_q1(feed(spark, sf_dir), days)
        return _naive(runner.run_to_table(stream, "stream-q1")[0], "window_start")
    return query


def open_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed without a record that closes its last windows."""
    days = position_days(spark, sf_dir)
    path = _once(spark, sf_dir, "open-feed", lambda out: replay.publish(days, out, sentinel=False))
    return replay.read_feed(runner.streaming_session(spark), path, FILES_PER_TRIGGER)


def stream_q1_open_end(days: int) -> Query:
    """The windows that closed, and those that the state still holds at the end."""
    def query(spark, sf_dir):
        totals = aggregates.class_totals(reports.with_watermark(open_feed(spark, sf_dir)), days).drop("window")
        closed, _, checkpoint = runner.run_to_checkpoint(totals, "stream-q1-open")
        rows = closed.unionByName(open_windows.open_class_totals(spark, checkpoint))
        return _naive(q1.report(rows, days), "window_start")
    return query


def stream_q2_top3(days: int) -> Query:
    def query(spark, sf_dir):
        stream = reports.stream_q2_top3(feed(spark, sf_dir), days)
        return _naive(runner.run_to_table(stream, "stream-q2")[0], "window_start")
    return query


def ranked_windows(spark: SparkSession, sf_dir: str, days: int) -> DataFrame:
    """The cumulative ranking of each closed window, by a stream of one period."""
    closed = periods.closed_windows(feed(spark, sf_dir), (days,))
    both, _ = runner.run_to_table(ranking_state.closed_and_ranked(closed), f"stream-ranked-{days}")
    return ranking_state.ranked_rows(both)


def stream_changelog(days: int) -> Query:
    return lambda spark, sf_dir: _naive(
        ranked_windows(spark, sf_dir, days).where("changed").select("window_start", "rank_a", "rank_p"), "window_start")


def stream_cumulative_rendered(days: int) -> Query:
    return lambda spark, sf_dir: q2.render(ranked_windows(spark, sf_dir, days))


def stream_emissions(days: int) -> Query:
    def query(spark, sf_dir):
        rows = cumulative.run_cumulative(feed(spark, sf_dir), days, "emissions")
        return _naive(rows, "window_start")
    return query


def fanned_out(spark: SparkSession, sf_dir: str) -> str:
    """Folder with all reports of the stream job over the feed."""
    rows = feed(spark, sf_dir)

    def write(out: str) -> str:
        stream_job.start(rows, out, finite=True).awaitTermination()
        return out
    return _once(spark, sf_dir, "fan-out", write)


def stream_fanout(period: str, report: str, schema: StructType) -> Query:
    return lambda spark, sf_dir: sinks.read_lines(
        spark, f"{fanned_out(spark, sf_dir)}/{period}/{report}", schema)


def stream_late_drop(spark, sf_dir):
    """Weekly counts of a feed in which the first day comes after all others.

    The stream first runs over the days on time and then goes on from its checkpoint, with
    the late day in front of it and its week closed.
    """
    days = position_days(spark, sf_dir)
    first_day = days.agg(F.min("event_date")).scalar()
    out = new_workspace(spark, "late-drop")
    on_time = days.where(F.col("event_date") > first_day)
    replay.append_days(on_time, f"{out}/feed")
    session = runner.streaming_session(spark)

    def run() -> None:
        rows = replay.read_feed(session, f"{out}/feed", FILES_PER_TRIGGER)
        stream = reports.stream_window_counts(rows, WEEK_DAYS)
        runner.start_file_sink(stream, f"{out}/counts").awaitTermination()

    run()
    replay.append_days(days.where(F.col("event_date") == first_day), f"{out}/feed")
    replay.append_sentinel(spark, f"{out}/feed")
    run()
    counts = spark.read.schema("window_start timestamp, sector string, n bigint").parquet(
        f"{out}/counts")
    return _naive(counts, "window_start")


def stream_late_rows(spark, sf_dir):
    """The late records of a feed in which the first day comes after all others."""
    days = position_days(spark, sf_dir)
    first_day = days.agg(F.min("event_date")).scalar()
    out = new_workspace(spark, "late-rows")
    session = runner.streaming_session(spark)
    for part in (F.col("event_date") > first_day, F.col("event_date") == first_day):
        replay.append_days(days.where(part), f"{out}/feed")
        rows = replay.read_feed(session, f"{out}/feed", FILES_PER_TRIGGER)
        late.start_late_rows(rows, WEEK_DAYS, out).awaitTermination()
    found = late.read_late(spark, out, rows)
    return _naive(found.select("ship_id", "ts", "shiptype", "lat", "lon", "watermark"), "ts", "watermark")


def stream_counts(spark, sf_dir):
    """Records and late rows of the stream job, from the table that its batches' counts went to."""
    out = new_workspace(spark, "counts")
    rows = feed(spark, sf_dir)
    listener = metrics.BatchCounts(spark, f"{out}/counts")
    rows.sparkSession.streams.addListener(listener)
    try:
        stream = reports.stream_window_counts(metrics.count_records(rows, "feed_records"), WEEK_DAYS)
        listener.wait_for(runner.start_file_sink(stream, f"{out}/rows"))
    finally:
        rows.sparkSession.streams.removeListener(listener)
    return metrics.batch_counts(spark, f"{out}/counts").groupBy("name").agg(F.sum("n").alias("n"))


# -- sinks and metrics ---------------------------------------------------------------------

def _roundtrip(spark: SparkSession, rows: DataFrame, schema: StructType) -> DataFrame:
    path = new_workspace(spark, "lines")
    sinks.write_lines(rows, path)
    return sinks.read_lines(spark, path, schema)


def sink_csv_roundtrip(spark, sf_dir):
    return _roundtrip(spark, q1_rendered(WEEK_DAYS)(spark, sf_dir), Q1_RENDERED_SCHEMA)


def sink_csv_roundtrip_q2(spark, sf_dir):
    return _roundtrip(spark, q2_rendered(WEEK_DAYS)(spark, sf_dir), Q2_RENDERED_SCHEMA)


def out_of_area(rows: DataFrame) -> DataFrame:
    return rows.where(~in_area(F.col("lat"), F.col("lon")))


def _counts_over(spark, name: str, *appends: Callable[[str], None]) -> DataFrame:
    """Weekly counts of a feed that grows between the runs of one stream."""
    out = new_workspace(spark, name)
    session = runner.streaming_session(spark)
    for append in appends:
        append(f"{out}/feed")
        rows = replay.read_feed(session, f"{out}/feed", FILES_PER_TRIGGER)
        stream = reports.stream_window_counts(rows, WEEK_DAYS)
        runner.start_file_sink(stream, f"{out}/counts").awaitTermination()
    counts = spark.read.schema("window_start timestamp, sector string, n bigint").parquet(
        f"{out}/counts")
    return _naive(counts, "window_start")


def stream_watermark_all_rows(spark, sf_dir):
    """Rows of the area first, then those outside it, which close the windows alone."""
    days = position_days(spark, sf_dir)
    return _counts_over(
        spark, "watermark-all",
        lambda feed: replay.append_days(days.transform(filters.within_area), feed),
        lambda feed: replay.append_days(out_of_area(days), feed))


def stream_late_drop_mixed(spark, sf_dir):
    """Rows outside the area first, which make all rows of the area late but the last weeks'."""
    days = position_days(spark, sf_dir)

    def rest(feed: str) -> None:
        replay.append_days(days.transform(filters.within_area), feed)
        replay.append_sentinel(spark, feed)
    return _counts_over(
        spark, "late-mixed", lambda feed: replay.append_days(out_of_area(days), feed), rest)


def stream_csv_sink(spark, sf_dir):
    """The streamed weekly report as appended part files, read back."""
    rows = q1.rendered(reports.stream_q1(feed(spark, sf_dir), WEEK_DAYS))
    out = new_workspace(spark, "stream-lines")
    runner.start_file_sink(sinks.as_lines(rows), out, "text").awaitTermination()
    return sinks.read_lines(spark, out, Q1_RENDERED_SCHEMA)


def observe_counts(spark, sf_dir):
    """Records seen at three points of one pass."""
    points = [Observation(name) for name in ("all", "in_area", "western")]
    rows = metrics.count_records(positions(spark, sf_dir), points[0])
    rows = metrics.count_records(rows.transform(filters.within_area), points[1])
    rows = metrics.count_records(rows.transform(filters.western), points[2])
    rows.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(
        [(p._name, p.get[metrics.RECORDS]) for p in points], "stage string, records bigint")


QUERIES: dict[str, Query] = {
    "ingest_csv": ingest_csv,
    "ingest_timestamps": ingest_timestamps,
    "ingest_defaults": ingest_defaults,
    "ingest_rejects": ingest_rejects,
    "event_time_topn": event_time_topn,
    "event_time_order": event_time_order,
    "ingest_incremental": ingest_incremental,
    "text_log_roundtrip": text_log_roundtrip,
    "bbox_filter": bbox_filter,
    "clustered_bbox_filter": clustered_bbox_filter,
    "clustered_sector_filter": clustered_sector_filter,
    "sea_west_filter": sea_west_filter,
    "sea_east_filter": sea_east_filter,
    "sea_label": sea_label_query,
    "sector_assign": sector_assign,
    "shiptype_class": shiptype_class,
    "day_slot": day_slot_query,
    "window_label": window_label_query,
    "window_week_counts": window_counts(WEEK_DAYS),
    "window_month_counts": window_counts(MONTH_DAYS),
    "last_arrival_type": last_arrival_type,
    "daily_rollup": daily_rollup,
    "q1_week": q1_report(WEEK_DAYS),
    "q1_month": q1_report(MONTH_DAYS),
    "q1_week_rendered": q1_rendered(WEEK_DAYS),
    "q1_month_rendered": q1_rendered(MONTH_DAYS),
    "q1_week_by_rollup": q1_by_rollup(WEEK_DAYS),
    "q1_month_by_rollup": q1_by_rollup(MONTH_DAYS),
    "slot_counts_week": slot_counts(WEEK_DAYS),
    "slot_counts_month": slot_counts(MONTH_DAYS),
    "q2_week_top3": q2_top3(WEEK_DAYS),
    "q2_month_top3": q2_top3(MONTH_DAYS),
    "q2_week_by_rollup": q2_by_rollup(WEEK_DAYS),
    "q2_month_by_rollup": q2_by_rollup(MONTH_DAYS),
    "q2_week_rendered": q2_rendered(WEEK_DAYS),
    "q2_month_rendered": q2_rendered(MONTH_DAYS),
    "q2_cumulative_week": over_stored_totals(q2.q2_cumulative, WEEK_DAYS),
    "q2_cumulative_month": over_stored_totals(q2.q2_cumulative, MONTH_DAYS),
    "q2_cumulative_week_rendered": over_stored_totals(q2.q2_cumulative_rendered, WEEK_DAYS),
    "q2_cumulative_month_rendered": over_stored_totals(q2.q2_cumulative_rendered, MONTH_DAYS),
    "q2_changelog_week": over_stored_totals(q2.q2_changelog, WEEK_DAYS),
    "q2_changelog_month": over_stored_totals(q2.q2_changelog, MONTH_DAYS),
    "q2_emissions_week": over_stored_totals(q2.q2_emissions, WEEK_DAYS),
    "q2_emissions_month": over_stored_totals(q2.q2_emissions, MONTH_DAYS),
    "stream_q1_week": stream_q1(WEEK_DAYS),
    "stream_q1_month": stream_q1(MONTH_DAYS),
    "stream_q1_week_open_end": stream_q1_open_end(WEEK_DAYS),
    "stream_q1_month_open_end": stream_q1_open_end(MONTH_DAYS),
    "stream_q2_week_top3": stream_q2_top3(WEEK_DAYS),
    "stream_q2_month_top3": stream_q2_top3(MONTH_DAYS),
    "stream_q2_changelog": stream_changelog(WEEK_DAYS),
    "stream_q2_changelog_month": stream_changelog(MONTH_DAYS),
    "stream_q2_cumulative_rendered_week": stream_cumulative_rendered(WEEK_DAYS),
    "stream_q2_cumulative_rendered_month": stream_cumulative_rendered(MONTH_DAYS),
    "stream_q2_emissions": stream_emissions(WEEK_DAYS),
    "stream_q2_emissions_month": stream_emissions(MONTH_DAYS),
    "stream_fanout_q1_week": stream_fanout("week", "q1", Q1_RENDERED_SCHEMA),
    "stream_fanout_q1_month": stream_fanout("month", "q1", Q1_RENDERED_SCHEMA),
    "stream_fanout_q2_week": stream_fanout("week", "q2", Q2_RENDERED_SCHEMA),
    "stream_fanout_q2_month": stream_fanout("month", "q2", Q2_RENDERED_SCHEMA),
    "stream_fanout_q2_cumulative_week": stream_fanout("week", "q2_cumulative", Q2_RENDERED_SCHEMA),
    "stream_fanout_q2_cumulative_month": stream_fanout("month", "q2_cumulative", Q2_RENDERED_SCHEMA),
    "stream_late_drop": stream_late_drop,
    "stream_watermark_all_rows": stream_watermark_all_rows,
    "stream_late_drop_mixed": stream_late_drop_mixed,
    "stream_late_rows": stream_late_rows,
    "stream_counts": stream_counts,
    "stream_csv_sink": stream_csv_sink,
    "sink_csv_roundtrip": sink_csv_roundtrip,
    "sink_csv_roundtrip_q2": sink_csv_roundtrip_q2,
    "observe_counts": observe_counts,
}
