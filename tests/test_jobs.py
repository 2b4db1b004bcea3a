from conftest import rows
from tidegrid import __main__ as cli, metrics, sinks
from tidegrid.plans import job, q1, q2
from tidegrid.constants import WEEK_DAYS
from tidegrid.schema import Q1_RENDERED_SCHEMA, Q2_RENDERED_SCHEMA
from tidegrid.sources import events, normalized

SF = "/root/testdata/sf0.001"


def test_batch_job_from_raw_log(spark, tmp_path):
    log, out = str(tmp_path / "raw"), str(tmp_path / "out")
    events.write_raw_log(events.read_events(spark, SF), log)
    cli.main(["batch", log, out])
    positions = spark.read.parquet(f"{out}/ingest/positions")
    assert positions.count() == events.read_events(spark, SF).where("event_id % 97 <> 0").count()
    assert (rows(sinks.read_lines(spark, f"{out}/q1_week", Q1_RENDERED_SCHEMA))
            == rows(q1.rendered(q1.q1(positions, WEEK_DAYS))))
    assert (rows(sinks.read_lines(spark, f"{out}/q2_week", Q2_RENDERED_SCHEMA))
            == rows(q2.q2_rendered(q2.q2_top3(positions, WEEK_DAYS))))
    stored = q2.stored_slot_totals(positions, WEEK_DAYS)
    assert (rows(sinks.read_lines(spark, f"{out}/q2_week_cumulative", Q2_RENDERED_SCHEMA))
            == rows(q2.q2_cumulative_rendered(stored, WEEK_DAYS)))


def test_batch_job_from_text_log(spark, tmp_path):
    log, text, out = (str(tmp_path / name) for name in ("raw", "text", "out"))
    events.write_raw_log(events.read_events(spark, SF), log)
    positions, _ = normalized.ingest(spark, log, str(tmp_path / "ingest"))
    normalized.to_text_log(positions).write.text(text)
    cli.main(["--text-log", "batch", text, out])
    imported = spark.read.parquet(f"{out}/ingest/positions")
    fields = (*normalized.TEXT_FIELDS, "event_date")
    assert rows(imported, *fields) == rows(positions, *fields)
    q1_rows = sinks.read_lines(spark, f"{out}/q1_week", Q1_RENDERED_SCHEMA)
    assert rows(q1_rows) == rows(q1.rendered(q1.q1(positions, WEEK_DAYS)))


def test_stream_job_from_raw_log(spark, tmp_path):
    log, out = str(tmp_path / "raw"), str(tmp_path / "out")
    events.write_raw_log(events.read_events(spark, SF), log)
    cli.main(["feed", log, out])
    cli.main(["stream", f"{out}/feed", f"{out}/reports"])
    positions = spark.read.parquet(f"{out}/ingest/positions")
    assert (rows(sinks.read_lines(spark, f"{out}/reports/week/q1", Q1_RENDERED_SCHEMA))
            == rows(q1.rendered(q1.q1(positions, WEEK_DAYS))))
    counted = metrics.batch_counts(spark, f"{out}/reports/counts").groupBy("name").sum("n")
    assert rows(counted) == [("feed_records", positions.count() + 1), ("late", 0)]


def test_no_records_give_empty_reports(spark, positions):
    empty = positions(("2015-03-05 10:00", 0.0, 0.0)).where("false")
    for name, report in job.reports(empty).items():
        assert report.count() == 0, name
    stored = q2.stored_slot_totals(empty, WEEK_DAYS)
    for plan in (q2.q2_cumulative, q2.q2_changelog, q2.q2_emissions):
        assert plan(stored, WEEK_DAYS).count() == 0


def test_one_window_has_no_cumulative_output(spark, positions):
    rows_ = positions(("2015-03-05 10:00", 40.0, 5.0), ("2015-03-06 10:00", 36.0, 15.0))
    reports = job.reports(rows_)
    assert reports["q2_week"].count() == 2
    assert reports["q2_week_cumulative"].count() == 0


def test_slot_zone_moves_slots_but_not_windows(spark, positions):
    late = positions(("2015-03-04 23:30", 40.0, 5.0))      # 00:30 on Thursday in Rome
    utc = q2.q2_top3(late, WEEK_DAYS).where("n = 1").first()
    rome = q2.q2_top3(late, WEEK_DAYS, slot_tz="Europe/Rome").where("n = 1").first()
    assert utc.window_start == rome.window_start
    assert (utc.slot, rome.slot) == ("12:00-23:59", "00:00-11:59")
    by_rollup = job.reports(late, slot_tz="Europe/Rome")["q2_week"].first()
    assert (by_rollup.rank_a, by_rollup.rank_p) == ("{H11}", "{H11}")
