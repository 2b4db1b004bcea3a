"""Record layouts."""

from __future__ import annotations

from pyspark.sql import types as T

# Fields of the raw log in file order. All are read as text.
RAW_FIELDS = (
    "ship_id", "shiptype", "speed", "lon", "lat", "course", "heading", "timestamp",
    "departure_port_name", "reported_draught", "trip_id")
RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_FIELDS])

# A position as the reports read it. ``event_id`` identifies a record and breaks ties in
# time. Ingested tables have ``arrival`` in its place, a number that grows with (ts, place in
# the log); it serves both purposes at once and faster.
POSITION_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ship_id", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("shiptype", T.IntegerType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
])

Q1_RENDERED_SCHEMA = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("stype", T.IntegerType()),
    T.StructField("id_cella", T.StringType()),
    T.StructField("stype_35", T.StringType()),
    T.StructField("avg_35", T.DoubleType()),
    T.StructField("stype_6069", T.StringType()),
    T.StructField("avg_6069", T.DoubleType()),
    T.StructField("stype_7079", T.StringType()),
    T.StructField("avg_7079", T.DoubleType()),
    T.StructField("stype_others", T.StringType()),
    T.StructField("avg_others", T.DoubleType()),
])

Q2_RENDERED_SCHEMA = T.StructType([
    T.StructField(name, T.StringType())
    for name in ("ts", "sea", "slot_a", "rank_a", "slot_p", "rank_p")])
