"""Ship numbers and storage by place."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from tidegrid.constants import GRID_COLUMNS, WEEK_DAYS
from tidegrid.functions.geo import cell_code, cell_name, cell_of_name, in_cell
from tidegrid.operators import aggregates, filters
from tidegrid.sources import clustered, events, normalized, ships

SF = "/root/testdata/sf0.001"


def test_last_ships_come_from_one_scan(spark, tmp_path):
    table = normalized.write_positions(normalized.in_event_time_order(
        events.positions(spark, SF).withColumn("ts", F.col("ts").cast("timestamp")), "event_id"), str(tmp_path / "p"))
    known = ships.add_ships(table, str(tmp_path / "ships"), 0)
    numbered = normalized.write_positions(ships.with_numbers(table, known), str(tmp_path / "n"))
    found = aggregates.slot_totals_with_last_number(numbered, WEEK_DAYS)
    plan = plan_of(found)
    assert plan.count("FileScan") == 1 and "SortAggregate" not in plan and "ship_id" not in plan
    columns = ["window_start", "cell", "am", "pm", "last_ship_id", "last_lat", "last_lon", "last_ts"]
    assert rows(aggregates.with_ship_ids(found, known), *columns) == rows(
        aggregates.slot_totals_with_last(table, WEEK_DAYS), *columns)


def test_ship_numbers_never_change(spark, tmp_path):
    path = str(tmp_path / "ships")

    def of(*names):
        return spark.createDataFrame([(n,) for n in names], "ship_id string")
    first = dict((r.ship_id, r.ship_no) for r in ships.add_ships(of("a", "b", "b", None), path, 0).collect())
    known = ships.add_ships(of("c", "a", ""), path, 1)
    second = dict((r.ship_id, r.ship_no) for r in known.collect())
    assert second.items() > first.items() and set(second) == {"a", "b", "c", ""}
    assert len(set(second.values())) == 4
    assert rows(ships.with_numbers(of("b", None), known)) == rows(
        spark.createDataFrame([("b", second["b"]), (None, None)], "ship_id string, ship_no long"))


def test_the_curve_keeps_neighbours_together(spark):
    places = spark.createDataFrame([(40.0, 5.0), (40.01, 5.01), (-90.0, -180.0), (90.0, 180.0), (None, 1.0)],
                                   "lat double, lon double")
    found = [r[0] for r in places.select(clustered.curve(F.col("lat"), F.col("lon"))).collect()]
    assert found[0] == found[1] and found[2] == 0 and found[3] > found[0] and found[4] == -1


def test_row_groups_elsewhere_are_passed_over(spark, tmp_path):
    """By the statistics of the files, and by what the scan of a sector reads."""
    rows_ = spark.range(200_000).select(
        F.col("id").alias("arrival"), F.to_date(F.lit("2015-03-05")).alias("event_date"),
        (32 + F.rand(1) * 13).alias("lat"), (-6 + F.rand(2) * 43).alias("lon"))
    path = str(tmp_path / "by-place")
    table = clustered.write_clustered(rows_, path, 0, row_group_bytes=64 << 10, partitions=4)
    files = glob.glob(f"{path}/*/*.parquet")
    groups = [pq.ParquetFile(f).metadata.row_group(i) for f in files
              for i in range(pq.ParquetFile(f).metadata.num_row_groups)]

    def bounds(group, name):
        column = next(c for c in map(group.column, range(group.num_columns)) if c.path_in_schema == name)
        return column.statistics.min, column.statistics.max
    touched = [g for g in groups if bounds(g, "lat")[1] > 40.4 and bounds(g, "lat")[0] <= 41.6
               and bounds(g, "lon")[1] > 3.9 and bounds(g, "lon")[0] <= 5.0]
    assert len(groups) > 8 and len(touched) < len(groups) / 3
    found = filters.in_sector(table, "I10")
    assert "PushedFilters: [IsNotNull(lat), IsNotNull(lon), LessThanOrEqual(lat" in plan_of(found)
    expected = rows_.where(cell_name(cell_code(F.col("lat"), F.col("lon"))) == "I10")
    assert found.count() == expected.count() > 0
    assert sorted(r.arrival for r in found.select("arrival").collect()) == sorted(
        r.arrival for r in expected.select("arrival").collect())
    # Alone, a scan that nothing is pushed to reads every row.
    scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
    found._jdf.queryExecution().executedPlan().executeCollect()
    assert scan.metrics().apply("numOutputRows").value() < 200_000 / 3


@pytest.mark.parametrize("sector", ["A1", "A7", "B2", "D7", "J7", "J40", "C40", "Error!"])
def test_bounds_of_a_sector_are_the_sector(spark, sector):
    lats = [31.25, 32.0, 32.0000001, 33.2, 33.2000001, 34.4, 35.6, 35.6000001, 42.8, 43.5, 44.0, 44.01, 45.0]
    lons = [-6.1, -6.0, -5.9999, -4.9, -4.8999999, 0.0, 0.6, 0.6000001, 35.8, 36.9, 36.95, 37.0]
    places = spark.createDataFrame([(a, o) for a in lats for o in lons], "lat double, lon double")
    lat, lon, code = F.col("lat"), F.col("lon"), cell_of_name(sector)
    named = places.withColumn("cell", cell_code(lat, lon)).withColumn("sector", cell_name(F.col("cell")))
    assert rows(named.where(in_cell(lat, lon, code)), "lat", "lon") == rows(
        named.where(F.col("sector") == sector), "lat", "lon")
    assert code == -1 or 0 <= code < 10 * GRID_COLUMNS
