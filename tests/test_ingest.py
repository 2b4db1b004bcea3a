import os

import pytest
from pyspark.sql import functions as F

from conftest import at, rows
from tidegrid import session, sinks
from tidegrid.schema import Q1_RENDERED_SCHEMA, Q2_RENDERED_SCHEMA
from tidegrid.sources import normalized, publication, raw_csv

HEADER = ("SHIP_ID,SHIPTYPE,SPEED,LON,LAT,COURSE,HEADING,TIMESTAMP,DEPARTURE_PORT_NAME,"
          "REPORTED_DRAUGHT,TRIP_ID")


def line(ship="s", shiptype="70", speed="1.5", lon="5.0", lat="40.0", course="10", heading="20",
         ts="05-03-15 10:15", port="GENOA", draught="88", trip="t1"):
    return ",".join((ship, shiptype, speed, lon, lat, course, heading, ts, port, draught, trip))


@pytest.fixture
def log(tmp_path):
    def write(*lines, name="log.csv"):
        folder = tmp_path / "raw"
        folder.mkdir(exist_ok=True)
        (folder / name).write_text("\n".join((HEADER, *lines)) + "\n")
        return str(folder)
    return write


def parse(spark, path, **options):
    return raw_csv.parse(raw_csv.scan(spark, path), **options)


def test_good_record(spark, log):
    r = raw_csv.accepted(parse(spark, log(line()))).drop(*raw_csv.LOG_ORDER)
    assert rows(r) == [("s", 70, 1.5, 5.0, 40.0, 10, 20, at("2015-03-05 10:15"), "GENOA", 88, "t1")]


@pytest.mark.parametrize("text, expected", [
    ("05-03-15 10:15", "2015-03-05 10:15"), ("05/03/15 10:15", "2015-03-05 10:15"),
    ("5/3/15 9:05", "2015-03-05 09:05"), ("05-03-2015 10:15", "2015-03-05 10:15"),
])
def test_timestamp_formats(spark, log, text, expected):
    assert parse(spark, log(line(ts=text))).first().ts == at(expected)


def test_source_zone(spark, log):
    r = parse(spark, log(line(ts="05-07-15 10:15")), source_tz="Europe/Rome").first()
    assert r.ts == at("2015-07-05 08:15")


def test_defaults(spark, log):
    path = log(line(heading="", draught=""), line(heading="7", draught='""'),
               line(heading="8", draught="12"), line(heading="9", draught="n/a"))
    assert rows(parse(spark, path), "heading", "reported_draught", "reject_reason") == [
        (0, 0, None), (7, 0, None), (8, 12, None), (9, 0, None)]
    assert rows(parse(spark, path, draught_compat=True), "reported_draught") == [(0,)] * 4


def test_parentheses_go(spark, log):
    r = parse(spark, log(line(ship="(a)", port="NAME (X)", trip="t(1)"))).first()
    assert (r.ship_id, r.departure_port_name, r.trip_id) == ("a", "NAME X", "t1")


@pytest.mark.parametrize("fault, reason", [
    ({"shiptype": "x70"}, "shiptype"), ({"shiptype": ""}, "shiptype"), ({"speed": "fast"}, "speed"),
    ({"lon": ""}, "lon"), ({"lat": "?"}, "lat"), ({"course": "1.5"}, "course"),
    ({"heading": "north"}, "heading"), ({"ts": "2015"}, "ts"), ({"trip": ""}, "trip_id"),
    ({"lat": "", "ts": "31-02-15 10:00"}, "lat,ts"),
])
def test_rejects(spark, log, fault, reason):
    parsed = parse(spark, log(line(**fault), line()))
    assert rows(raw_csv.rejected(parsed), "reject_reason") == [(reason,)]
    assert raw_csv.accepted(parsed).count() == 1


def test_short_and_long_lines(spark, log):
    parsed = parse(spark, log("s,70,1.5", line() + ",extra", line(ship="")))
    assert rows(raw_csv.rejected(parsed), "reject_reason") == [
        ("lon,lat,course,ts,trip_id",)]
    assert rows(raw_csv.accepted(parsed), "ship_id", "trip_id") == [("", "t1"), ("s", "t1")]


def test_quotes_mean_nothing(spark, log):
    r = parse(spark, log(line(port='"LA', trip='SPEZIA"'))).first()
    assert (r.departure_port_name, r.trip_id) == ('"LA', 'SPEZIA"')


def test_ingest_orders_by_time_then_place_in_the_log(spark, log, tmp_path):
    log(line(trip="a", ts="06-03-15 10:00"), line(trip="b", ts="05-03-15 10:00"),
        line(trip="c", ts="05-03-15 10:00"), name="1.csv")
    path = log(line(trip="d", ts="05-03-15 10:00"), line(trip="e", ts="04-03-15 10:00"),
               line(trip="f", ts="bad"), name="2.csv")
    good, bad = normalized.ingest(spark, path, str(tmp_path / "out"))
    assert [r.trip_id for r in good.orderBy("arrival").collect()] == ["e", "b", "c", "d", "a"]
    numbers = normalized.replay_numbers(good)
    assert rows(numbers, "replay_seq", "trip_id") == [
        (0, "e"), (1, "b"), (2, "c"), (3, "d"), (4, "a")]
    assert rows(bad, "trip_id", "reject_reason") == [("f", "ts")]
    days = good.select(F.col("event_date").cast("string")).distinct()
    assert rows(days) == [("2015-03-04",), ("2015-03-05",), ("2015-03-06",)]


def test_records_of_many_files_keep_their_order(spark, log, tmp_path):
    log(line(trip="a"), line(trip="b"), name="1.csv")
    path = log(line(trip="c"), line(trip="d"), name="2.csv")
    good, _ = normalized.ingest(spark, path, str(tmp_path / "out"))
    assert [r.trip_id for r in good.orderBy("arrival").collect()] == ["a", "b", "c", "d"]


def test_one_hot_minute_spreads_over_partitions(spark):
    df = spark.range(20000).select(
        F.lit(at("2015-03-05 10:00")).cast("timestamp").alias("ts"), F.col("id").alias("event_id"))
    ordered = normalized.in_event_time_order(df, "event_id", partitions=8)
    sizes = [r["count"] for r in ordered.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 5000
    assert ordered.orderBy("arrival").select("event_id").first()[0] == 0


@pytest.mark.parametrize("ingest", [normalized.ingest, normalized.import_text_log])
def test_a_log_that_grew_or_was_replaced_is_not_taken_for_the_old_one(spark, tmp_path, ingest):
    path, out = tmp_path / "raw.csv", str(tmp_path / "out")
    path.write_text("\n".join((HEADER, line(ship="a"))) + "\n")
    ingest(spark, str(path), out)
    ingest(spark, str(path), out)
    before = path.stat()
    with path.open("a") as grown:
        grown.write(line(ship="b") + "\n")
    os.utime(path, ns=(before.st_atime_ns, before.st_mtime_ns))
    with pytest.raises(ValueError):
        ingest(spark, str(path), out)
    path.write_text("\n".join((HEADER, line(ship="c"))) + "\n")
    os.utime(path, ns=(before.st_atime_ns, before.st_mtime_ns + 10**9))
    with pytest.raises(ValueError):
        ingest(spark, str(path), out)


def arrivals(good):
    return [r.trip_id for r in good.orderBy("arrival").collect()]


def test_a_log_in_parts_equals_the_log_at_once(spark, log, tmp_path):
    """New files and a file that grew; a later run may bring earlier times and the same minutes."""
    parts = [[line(trip=f"{k}{i}", ts=f"0{1 + (i * 7 + ord(k)) % 5}-03-15 10:1{i % 3}", shiptype="x" if i == 4 else "7")
              for i in range(9)] for k in "abc"]
    for k, lines in zip("abc", parts):
        path = log(*lines, name=f"{k}.csv")
        good, bad = normalized.take_in(spark, path, str(tmp_path / "parts"))
        before = {r.trip_id: r.arrival for r in good.collect()}
    once, all_bad = normalized.ingest(spark, path, str(tmp_path / "once"))
    assert arrivals(good) == arrivals(once)
    fields = [f for f in normalized.TEXT_FIELDS]
    assert rows(good, *fields) == rows(once, *fields) and rows(bad, "raw_record") == rows(all_bad, "raw_record")
    numbers = normalized.replay_numbers(good, normalized.MINUTE_BITS)
    assert sorted(r.replay_seq for r in numbers.collect()) == list(range(24))
    log(*parts[2], line(trip="late", ts="01-03-15 10:10"), name="c.csv")
    good, _ = normalized.take_in(spark, path, str(tmp_path / "parts"))
    after = {r.trip_id: r.arrival for r in good.collect()}
    assert after.items() > before.items() and after.keys() - before.keys() == {"late"}
    again, _ = normalized.take_in(spark, path, str(tmp_path / "parts"))
    assert rows(again, "arrival") == rows(good, "arrival")


def test_a_replaced_file_raises(spark, log, tmp_path):
    path, out = log(line(), line()), str(tmp_path / "out")
    normalized.take_in(spark, path, out)
    log(line())
    with pytest.raises(ValueError):
        normalized.take_in(spark, path, out)


def test_a_run_that_broke_off_is_finished(spark, log, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    path = log(*[line(trip=f"t{d}", ts=f"0{d}-03-15 10:00") for d in range(1, 6)])
    moved = []

    def breaks(*args):
        if len(moved) == 2:
            raise OSError("gone")
        moved.append(args)
        session_move(*args)
    session_move = publication.move
    monkeypatch.setattr(publication, "move", breaks)
    with pytest.raises(OSError):
        normalized.take_in(spark, path, out)
    monkeypatch.setattr(publication, "move", session_move)
    good, _ = normalized.take_in(spark, path, out)
    assert arrivals(good) == ["t1", "t2", "t3", "t4", "t5"]
    times = [t for _, t in session.data_files(spark, f"{out}/positions")]
    assert times == sorted(times) and len(set(times)) == 5


def test_ingest_happens_once_for_the_same_input(spark, log, tmp_path):
    out = str(tmp_path / "out")
    path = log(line())
    for _ in range(2):
        good, _ = normalized.ingest(spark, path, out)
        assert good.count() == 1
    with pytest.raises(ValueError):
        normalized.ingest(spark, path, out, source_tz="Europe/Rome")
    log(line(trip="new"), name="more.csv")
    with pytest.raises(ValueError):
        normalized.ingest(spark, path, out)


def test_rejects_keep_their_text_and_may_be_all_there_is(spark, log, tmp_path):
    good, bad = normalized.ingest(spark, log(line(shiptype="x", ts="soon")), str(tmp_path / "out"))
    assert good.count() == 0 and good.schema["event_date"].dataType.simpleString() == "date"
    r = bad.first()
    assert r.reject_reason == "shiptype,ts" and r.raw_record == line(shiptype="x", ts="soon")


def test_text_log_rejects_and_patterns(spark, log, tmp_path):
    good, _ = normalized.ingest(spark, log(line(port=""), line(trip="t2")), str(tmp_path / "o"))
    text = [r.value for r in normalized.to_text_log(good).collect()]
    (tmp_path / "1.txt").write_text("\n".join([*text, "s,x,1.5", text[0].replace("2015", "never")]) + "\n")
    found = normalized.import_text_log(spark, str(tmp_path / "*.txt"), str(tmp_path / "p"))
    assert rows(found.select(*normalized.TEXT_FIELDS)) == rows(good.select(*normalized.TEXT_FIELDS))
    bad = normalized.text_log_rejects(spark, str(tmp_path / "*.txt"))
    assert len(rows(bad)) == 2 and "ts" in {r.reject_reason for r in bad.collect()}


def test_text_log(spark, log, tmp_path):
    good, _ = normalized.ingest(spark, log(line(), line(ts="06/03/15 00:00")), str(tmp_path / "o"))
    lines = normalized.to_text_log(good)
    assert rows(lines)[0][0] == "s,70,1.5,5.0,40.0,10,20,Fri Mar 06 00:00:00 UTC 2015,GENOA,88,t1"
    assert rows(normalized.from_text_log(lines)) == rows(good.select(*normalized.TEXT_FIELDS))


def test_text_log_keeps_its_zone(spark):
    text = "s,70,1.5,5.0,40.0,10,20,Sun Jul 05 10:15:00 CEST 2015,GENOA,88,t1"
    lines = spark.createDataFrame([(text,)], "value string")
    assert normalized.from_text_log(lines).first().ts == at("2015-07-05 08:15")


def test_result_lines_read_back(spark, tmp_path):
    q1 = [("Thu Mar 05", 99, "E20", "35", 0.0, "60-69", 0.0, "70-79", 0.0, "Others", 4.0)]
    q2 = [("Thu Mar 19", "Orientale", "00:00-11:59", "{I34, D20, D19}", "12:00-23:59", "{I34}")]
    for name, data, schema, text in (
            ("q1", q1, Q1_RENDERED_SCHEMA,
             "Thu Mar 05,99,E20,35,0.0,60-69,0.0,70-79,0.0,Others,4.0"),
            ("q2", q2, Q2_RENDERED_SCHEMA,
             "Thu Mar 19,Orientale,00:00-11:59,{I34, D20, D19},12:00-23:59,{I34}")):
        path = str(tmp_path / name)
        sinks.write_lines(spark.createDataFrame(data, schema), path)
        assert rows(spark.read.text(path)) == [(text,)]
        assert rows(sinks.read_lines(spark, path, schema)) == data
