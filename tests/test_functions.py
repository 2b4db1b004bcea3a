import datetime as dt

from pyspark.sql import functions as F

from conftest import at, rows
from tidegrid.functions import (
    arrival_key, day_slot, rank_list, sea_label, ship_class, window_label)
from tidegrid.operators import filters


def test_area_is_inclusive(spark):
    points = [(32.0, -6.0), (45.0, 37.0), (31.999, 0.0), (45.001, 0.0), (40.0, -6.001),
              (40.0, 37.001)]
    df = spark.createDataFrame(points, "lat double, lon double")
    assert rows(filters.within_area(df)) == [(32.0, -6.0), (45.0, 37.0)]


def test_seas_are_strict(spark):
    points = [(37.2, 5.0), (37.201, 5.0), (40.0, 11.2), (40.0, 11.199), (37.2, 12.0),
              (37.199, 12.0)]
    df = spark.createDataFrame(points, "lat double, lon double")
    assert rows(filters.western(df)) == [(37.201, 5.0), (40.0, 11.199)]
    assert rows(filters.eastern(df)) == [(37.199, 12.0)]
    seas = [r[0] for r in df.select(sea_label(F.col("lat"), F.col("lon"))).collect()]
    assert seas == ["Orientale", "Occidentale", "Orientale", "Occidentale", "Orientale",
                    "Orientale"]


def test_ship_classes(spark):
    types = [0, 34, 35, 36, 59, 60, 69, 70, 79, 80, 99]
    df = spark.createDataFrame([(t,) for t in types], "t int")
    classes = [r[0] for r in df.select(ship_class(F.col("t"))).collect()]
    assert classes == ["Others", "Others", "35", "Others", "Others", "60-69", "60-69",
                       "70-79", "70-79", "Others", "Others"]


def test_day_slots(spark):
    times = ["2015-03-10 00:00", "2015-03-10 11:59", "2015-03-10 12:00", "2015-03-10 23:30"]
    df = spark.createDataFrame([(at(t),) for t in times], "ts timestamp")
    for ts in (F.col("ts"), F.col("ts").cast("timestamp_ntz")):
        utc = [r[0][:2] for r in df.select(day_slot(ts)).collect()]
        rome = [r[0][:2] for r in df.select(day_slot(ts, "Europe/Rome")).collect()]
        assert utc == ["00", "00", "12", "12"]
        assert rome == ["00", "12", "12", "00"]


def test_window_label(spark):
    df = spark.createDataFrame([(at("2015-03-05 00:00"),)], "ts timestamp")
    assert df.select(window_label(F.col("ts"))).first()[0] == "Thu Mar 05"


def test_rank_list(spark):
    df = spark.createDataFrame([(["I34", "D20", "D19"],), ([],)], "s array<string>")
    assert [r[0] for r in df.select(rank_list(F.col("s"))).collect()] == ["{I34, D20, D19}", "{}"]


def test_arrival_key_orders_like_the_pair(spark):
    big = 2 ** 63 - 1
    base = dt.datetime(2015, 3, 5)
    pairs = [(base + dt.timedelta(microseconds=us), i)
             for us in (-1, 0, 1) for i in (-big - 1, -5, 0, 7, big)]
    df = spark.createDataFrame(pairs[::-1], "ts timestamp, id bigint")
    in_order = df.orderBy(arrival_key(F.col("ts"), F.col("id"))).collect()
    assert [tuple(r) for r in in_order] == pairs
