import pytest
from pyspark.sql import Observation, functions as F

from conftest import plan_of, rows
from tidegrid import metrics, sinks
from tidegrid.constants import MONTH_DAYS, WEEK_DAYS
from tidegrid.operators import aggregates
from tidegrid.plans import job as batch_job, q1, q2
from tidegrid.schema import Q1_RENDERED_SCHEMA, Q2_RENDERED_SCHEMA
from tidegrid.sources import events, normalized, replay
from tidegrid.streaming import cumulative, job, late, periods, ranking_state, reports, runner

WEST = (40.0, 5.0)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    p = events.positions(spark, SF).withColumn("ts", F.col("ts").cast("timestamp"))
    ordered = normalized.in_event_time_order(p, "event_id")
    return normalized.write_positions(ordered, str(tmp_path_factory.mktemp("t") / "positions"))


@pytest.fixture(scope="module")
def feed(table, tmp_path_factory):
    return replay.publish(table, str(tmp_path_factory.mktemp("f") / "feed"))


def stream(spark, feed, files=5):
    return replay.read_feed(runner.streaming_session(spark), feed, files)


def test_feed_is_published_once(spark, table, feed):
    before = spark.read.parquet(feed).count()
    replay.publish(table, feed)
    assert spark.read.parquet(feed).count() == before == table.count() + 1


def test_feed_goes_on_after_a_failure(spark, table, tmp_path):
    feed = str(tmp_path / "feed")
    days = sorted(r[0] for r in table.select("event_date").distinct().collect())
    for day in days[:2]:
        of_day = table.where(F.col("event_date") == F.lit(day))
        replay.append(of_day.select(*replay.FEED_COLUMNS), feed)
    replay.publish(table, feed)
    assert (rows(spark.read.parquet(feed).where("arrival >= 0"), "arrival")
            == rows(table, "arrival"))


@pytest.mark.parametrize("days", [WEEK_DAYS, MONTH_DAYS])
def test_q1_equals_batch_without_drops(spark, table, feed, days):
    out, query = runner.run_to_table(reports.stream_q1(stream(spark, feed), days), "t-q1")
    assert len(query.recentProgress) > 3
    assert metrics.late_rows(query) == 0
    assert rows(out) == rows(q1.q1(table, days))
    assert "ship_id" not in query._jsq.explainInternal(False)     # pruned from the scan


@pytest.mark.parametrize("days", [WEEK_DAYS, MONTH_DAYS])
def test_q2_equals_batch(spark, table, feed, days):
    out, _ = runner.run_to_table(reports.stream_q2_top3(stream(spark, feed), days), "t-q2")
    batch = q2.q2_top3(table, days)
    assert rows(out, *batch.columns) == rows(batch)


def test_emissions_equal_batch(spark, table, feed):
    out = cumulative.run_cumulative(stream(spark, feed), WEEK_DAYS, "emissions")
    assert rows(out) == rows(q2.q2_emissions(q2.stored_slot_totals(table, WEEK_DAYS), WEEK_DAYS))


def test_cumulative_state_goes_on_after_a_restart(spark, table, tmp_path):
    """One run, and a run for each fortnight of the feed from the same checkpoint, give the same."""
    def ranked(feed, out):
        closed = periods.closed_windows(stream(spark, feed, 40), (WEEK_DAYS, MONTH_DAYS))
        both = ranking_state.closed_and_ranked(closed)
        runner.start_file_sink(both, out).awaitTermination()
        return ranking_state.ranked_rows(spark.read.schema(both.schema).parquet(out))

    whole = replay.publish(table, str(tmp_path / "whole"))
    expected = ranked(whole, str(tmp_path / "once"))
    days = sorted(r[0] for r in table.select("event_date").distinct().collect())
    parts = str(tmp_path / "parts")
    for start in range(0, len(days), 14):
        replay.append_days(table.where(F.col("event_date").isin(days[start:start + 14])), parts)
        found = ranked(parts, str(tmp_path / "again"))
    replay.append_sentinel(spark, parts)
    found = ranked(parts, str(tmp_path / "again"))
    assert rows(found) == rows(expected)
    for period in (WEEK_DAYS, MONTH_DAYS):
        stored = q2.stored_slot_totals(table, period)
        own = found.where(F.col("days") == period)
        assert rows(q2.render(own)) == rows(q2.q2_cumulative_rendered(stored, period))
        assert rows(own.where("changed"), "window_start", "rank_a", "rank_p") == rows(
            q2.q2_changelog(stored, period))


def test_ranked_windows_by_hand():
    """Equal counts count once, silent sectors keep their score, a window seen again is passed over."""
    def closed(window, cell, am, pm, west=True, arrival=0):
        return {"window_micros": window, "cell": cell, "am": am, "pm": pm, "west": west, "last_arrival": arrival}
    memory = ranking_state.Memory()
    first = list(ranking_state.ranked([closed(1, 0, 5, 0), closed(1, 1, 3, 2)], memory))
    assert first == [] and dict(memory.all_scores()) == {0: (5, 0), 1: (3, 2)}
    rows_ = [closed(3, 1, 9, 2, False, 7), closed(2, 0, 5, 1, True, 3), closed(1, 2, 99, 99)]
    found = list(ranking_state.ranked(rows_, memory))
    assert [(w["window_micros"], w["cells_a"], w["cells_p"], w["last_west"], w["changed"]) for w in found] == [
        (2, [0, 1], [1, 0], True, True), (3, [1, 0], [1, 0], False, True)]
    assert list(ranking_state.ranked(rows_, memory)) == []


def test_one_scan_and_one_aggregation_for_both_periods(spark, feed):
    plan = plan_of(periods.closed_windows(stream(spark, feed), (WEEK_DAYS, MONTH_DAYS)))
    assert plan.count("StateStoreSave") == 1 and plan.count("StreamingRelation") == 1
    assert plan.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in plan


def test_streams_hash_aggregate(spark, feed):
    rows_ = stream(spark, feed)
    for df in (reports.stream_q1(rows_, WEEK_DAYS),
               aggregates.rollup(reports.with_watermark(rows_), WEEK_DAYS)):
        plan = plan_of(df)
        assert "StateStoreSave" in plan and "SortAggregate" not in plan
        assert plan.count("Exchange hashpartitioning") == 1


def test_late_rows(spark, positions, tmp_path):
    """After the watermark has passed the first week, a row for it is dropped; a row that is
    older than the watermark but lies in an open week still counts."""
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")

    def run():
        counts = reports.stream_window_counts(stream(spark, feed), WEEK_DAYS)
        query = runner.start_file_sink(counts, out)
        query.awaitTermination()
        return query

    def append(*rows_):
        replay.append(positions(*rows_).withColumnRenamed("event_id", "arrival"), feed)

    append(("2015-03-05 10:00", *WEST), ("2015-03-13 10:00", *WEST))
    run()
    append(("2015-03-06 10:00", *WEST), ("2015-03-12 01:00", *WEST))
    query = run()
    assert metrics.late_rows(query) == 1
    replay.append_sentinel(spark, feed)
    run()
    found = spark.read.schema("window_start timestamp, sector string, n bigint").parquet(out)
    assert rows(found.select(F.col("window_start").cast("date").cast("string"), "n")) == [
        ("2015-03-05", 1), ("2015-03-12", 2)]


def test_stays_open_until_the_watermark_passes(spark, positions, tmp_path):
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    week_end = ("2015-03-12 00:00", *WEST)     # 60 s short of closing the first week
    replay.append(positions(("2015-03-05 10:00", *WEST), week_end)
                  .withColumnRenamed("event_id", "arrival"), feed)
    counts = reports.stream_window_counts(stream(spark, feed), WEEK_DAYS)
    runner.start_file_sink(counts, out).awaitTermination()
    schema = "window_start timestamp, sector string, n bigint"
    assert spark.read.schema(schema).parquet(out).count() == 0
    replay.append(positions(("2015-03-12 00:01", *WEST, 70, 9))
                  .withColumnRenamed("event_id", "arrival"), feed)
    runner.start_file_sink(counts, out).awaitTermination()
    assert spark.read.schema(schema).parquet(out).count() == 1


def test_counts_are_observed(spark, table, feed):
    seen = Observation("seen")
    metrics.count_records(table, seen).write.format("noop").mode("overwrite").save()
    assert seen.get[metrics.RECORDS] == table.count()
    counted = metrics.count_records(stream(spark, feed), "feed_records")
    _, query = runner.run_to_table(counted.select("arrival"), "t-observed")
    assert metrics.streamed_records(query, "feed_records") == table.count() + 1


def test_counts_outlive_what_a_query_remembers(spark, table, feed, tmp_path):
    session = runner.streaming_session(spark)
    session.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    listener = metrics.BatchCounts(spark, str(tmp_path / "counts"))
    session.streams.addListener(listener)
    try:
        counted = metrics.count_records(replay.read_feed(session, feed, 5), "feed_records").select("arrival")
        query = runner.start_file_sink(counted, str(tmp_path / "out"))
        assert listener.wait_for(query)
    finally:
        session.streams.removeListener(listener)
    assert len(query.recentProgress) <= 2
    found = metrics.batch_counts(spark, str(tmp_path / "counts"))
    assert rows(found.groupBy("name").agg(F.sum("n"))) == [("feed_records", table.count() + 1), ("late", 0)]
    assert found.select("batch").distinct().count() > 5
    assert metrics.batch_counts(spark, str(tmp_path / "none")).count() == 0


def test_late_records_are_told_one_by_one(spark, positions, tmp_path):
    """Those of closed windows, by the watermark of the batches before; a batch run again leaves the same."""
    out = str(tmp_path / "out")
    first = positions(("2015-03-05 10:00", *WEST), ("2015-03-12 00:01", *WEST))
    second = positions(("2015-03-11 23:59", *WEST), ("2015-03-12 00:00", *WEST), ("2015-03-19 00:00", *WEST))
    third = positions(("2015-03-18 10:00", *WEST), ("2015-03-04 10:00", 0.0, 0.0))
    for batch_id, batch in enumerate((first, second, third, third)):
        late.record_late(batch, min(batch_id, 2), WEEK_DAYS, out)
    found = late.read_late(spark, out, first)
    text = F.date_format("ts", "MM-dd HH:mm"), F.date_format("watermark", "MM-dd HH:mm")
    assert rows(found.select(*text)) == [("03-04 10:00", "03-18 23:59"), ("03-11 23:59", "03-12 00:00")]


def test_both_periods_together(spark, table, feed, tmp_path):
    out = str(tmp_path / "out")
    job.start_feed(spark, feed, out, finite=True).awaitTermination()
    batch = batch_job.reports(table)
    for name, days in job.PERIODS.items():
        for report, schema in (("q1", Q1_RENDERED_SCHEMA), ("q2", Q2_RENDERED_SCHEMA)):
            lines = sinks.read_lines(spark, f"{out}/{name}/{report}", schema)
            assert rows(lines) == rows(batch[f"{report}_{name}"])
        lines = sinks.read_lines(spark, f"{out}/{name}/q2_cumulative", Q2_RENDERED_SCHEMA)
        assert rows(lines) == rows(batch[f"q2_{name}_cumulative"])
        changes = spark.read.text(f"{out}/{name}/q2_changelog")
        assert changes.count() == q2.q2_changelog(q2.stored_slot_totals(table, days), days).count()


def test_a_taken_in_table_is_a_feed_without_a_last_record(spark, tmp_path):
    """A stream over the ingested table itself, which grows between two runs; what stays open comes from
    the state, and no row is late."""
    out, events_ = str(tmp_path / "out"), events.read_events(spark, SF).orderBy("ts", "event_id")
    halves = (F.col("ts") < F.lit("2024-01-15"), F.col("ts") >= F.lit("2024-01-15"))
    for part, half in enumerate(halves):
        events.write_raw_log(events_.where(half), str(tmp_path / "log" / str(part)))
        good, _ = normalized.take_in(spark, str(tmp_path / "log" / "*"), str(tmp_path / "in"))
        session = runner.streaming_session(spark)
        positions_ = replay.read_positions(session, str(tmp_path / "in" / "positions"), 12)
        query = job.start(positions_, out, finite=True)
        query.awaitTermination()
        assert metrics.late_rows(query) == 0
        job.write_open(spark, out)
        batch = batch_job.reports(good)
        for name in job.PERIODS:
            for report, schema in (("q1", Q1_RENDERED_SCHEMA), ("q2", Q2_RENDERED_SCHEMA),
                                   ("q2_cumulative", Q2_RENDERED_SCHEMA)):
                lines = sinks.read_lines(spark, f"{out}/{name}/{report}", schema)
                assert rows(lines) == rows(batch[f"{report}_{name}" if report != "q2_cumulative" else f"q2_{name}_cumulative"])


def test_a_batch_run_again_leaves_the_same_files(spark, table, tmp_path):
    out = str(tmp_path / "out")
    totals = q2.stored_slot_totals(table, WEEK_DAYS)
    second = sorted(r[0] for r in totals.select("window_start").distinct().collect())[1]
    first = totals.where(F.col("window_start") <= second)
    rest = totals.where(F.col("window_start") > second)
    for closed, batch_id in ((first, 1), (rest, 4), (rest, 4), (first, 1)):
        cumulative.record_windows(closed, batch_id, WEEK_DAYS, out)
    assert (rows(cumulative.read_report(spark, out, "emissions"))
            == rows(q2.q2_emissions(totals, WEEK_DAYS)))


def test_half_a_day_in_the_feed_is_completed(spark, positions, tmp_path):
    days = normalized.write_positions(normalized.in_event_time_order(positions(
        *[(f"2015-03-{d:02d} {h:02d}:00", 40.0, 5.0) for d in (5, 6, 7) for h in range(20)]),
        "event_id"), str(tmp_path / "days"))
    feed = str(tmp_path / "feed")
    replay.append_days(days.where("event_date = '2015-03-05'"), feed)
    half = days.where("event_date = '2015-03-06'").orderBy("arrival").limit(7)
    replay.append(half.select(*replay.FEED_COLUMNS), feed)
    (tmp_path / "feed" / "_SUCCESS").unlink()  # as after a crash before the first commit
    replay.publish(days, feed)
    replay.publish(days, feed)
    written = spark.read.parquet(feed)
    assert rows(written.where("arrival >= 0"), "arrival") == rows(days, "arrival")
    assert written.count() == days.count() + 1


def test_filters_stay_above_the_watermark(spark, positions, tmp_path):
    positions(("2015-03-05 10:00", 40.0, 5.0)).withColumn("arrival", F.col("event_id")).select(
        *replay.FEED_COLUMNS).write.parquet(str(tmp_path / "feed"))
    feed = replay.read_feed(spark, str(tmp_path / "feed"))
    plan = plan_of(reports.stream_q1(feed, 7))
    assert plan.index("Filter") < plan.index("EventTimeWatermark") and "PushedFilters: [Is" not in plan


def test_a_foreign_session_zone_changes_nothing(spark, positions):
    table = positions(("2015-03-05 14:00", 40.0, 5.0), ("2015-03-05 02:00", 40.0, 5.0))
    expected = rows(q2.q2_rendered(q2.q2_top3(table, 7)))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert rows(q2.q2_rendered(q2.q2_top3(table, 7))) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
