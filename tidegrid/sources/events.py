"""Position records derived from the ``events`` table of the test data.

That table has no coordinates, so each user gets one of twelve home ports and a small
offset that depends on the event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Home ports in hundredths of a degree, by user_id modulo 12.
PORT_LAT = (3614, 3957, 4330, 4390, 3680, 3590, 4085, 3795, 3125, 3465, 4490, 3700)
PORT_LON = (-535, 265, 530, 890, 1510, 1450, 2930, 2360, 3230, 3300, 1230, 3695)


EVENTS_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                 "value double, props string")


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def _degrees(ports: tuple[int, ...], offset: str) -> Column:
    port = f"array({', '.join(map(str, ports))})[CAST(user_id % 12 AS INT)]"
    return F.expr(f"CAST({port} + {offset} AS DOUBLE) / 100")


def positions_from_events(events: DataFrame, *extra: str) -> DataFrame:
    return events.select(
        "event_id",
        F.col("user_id").cast("string").alias("ship_id"),
        "ts",
        F.get_json_object("props", "$.k").cast("int").alias("shiptype"),
        _degrees(PORT_LAT, "event_id % 7 * 3 - 9").alias("lat"),
        _degrees(PORT_LON, "event_id % 11 * 5 - 25").alias("lon"),
        *extra)


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions_from_events(read_events(spark, sf_dir))


def to_raw_log(events: DataFrame) -> DataFrame:
    """The events printed as raw log fields, with the faults a real log has: both timestamp
    formats, blank headings, blank and quoted-blank draughts, ports with parentheses, and
    ship types that are no number. The trip id is the event id, and the lines are in its
    order."""
    event_id = F.col("event_id")

    def text(column: str) -> Column:
        return F.col(column).cast("string")

    fields = {
        "ship_id": F.col("ship_id"),
        "shiptype": F.when(event_id % 97 == 0, F.concat(F.lit("x"), text("shiptype")))
                     .otherwise(text("shiptype")),
        "speed": text("value"),
        "lon": text("lon"),
        "lat": text("lat"),
        "course": (event_id % 360).cast("string"),
        "heading": F.when(event_id % 5 != 0, (event_id % 359).cast("string")),
        "timestamp": F.when(event_id % 2 == 0, F.date_format("ts", "dd/MM/yy HH:mm"))
                      .otherwise(F.date_format("ts", "dd-MM-yy HH:mm")),
        "departure_port_name": F.concat(F.upper("event_type"), F.lit(" (X)")),
        "reported_draught": F.when(event_id % 4 == 1, F.lit('""'))
                             .when(event_id % 4 > 1, (event_id % 120).cast("string")),
        "trip_id": text("event_id"),
    }
    rows = positions_from_events(events, "value", "event_type")
    in_order = rows.repartitionByRange("event_id").sortWithinPartitions("event_id")
    return in_order.select(*[column.alias(name) for name, column in fields.items()])


def write_raw_log(events: DataFrame, path: str) -> None:
    (to_raw_log(events).write.option("header", True).option("quote", "\u0000")
     .option("emptyValue", "").csv(path))
