import math
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import plan_of
from tidegrid.functions import cell_code
from tidegrid.operators.grid import with_sector

LAT_EDGES = [Decimal("32.0") + Decimal("1.2") * k for k in range(11)]
LON_EDGES = [Decimal("-6.0") + Decimal("1.1") * k for k in range(40)]


def expected_sector(lat: float, lon: float) -> str:
    """The first edge that is not below the value, in decimals."""
    lat_index = next((i for i, e in enumerate(LAT_EDGES) if Decimal(repr(lat)) <= e), None)
    lon_index = next((i for i, e in enumerate(LON_EDGES) if Decimal(repr(lon)) <= e), None)
    if lat_index is None or lon_index is None:
        return "Error!"
    return "ABCDEFGHIJJ"[lat_index] + str(lon_index + 1)


def sectors(spark, points):
    df = spark.createDataFrame(points, "lat double, lon double")
    return [(r.lat, r.lon, r.sector) for r in with_sector(df).collect()]


@pytest.mark.parametrize("lat, lon, name", [
    (32.0, -6.0, "A1"), (32.0, 0.0, "A7"), (33.2, -4.9, "B2"),
    (33.2000001, -4.8999999, "C3"), (35.6, 0.0, "D7"), (42.8, 0.0, "J7"),
    (43.5, 0.0, "J7"), (44.0, 36.9, "J40"), (44.01, 0.0, "Error!"),
    (33.0, 36.95, "Error!"), (45.0, 37.0, "Error!"), (31.25, 32.3, "A36"),
])
def test_edge_points(spark, lat, lon, name):
    assert sectors(spark, [(lat, lon)]) == [(lat, lon, name)]
    assert expected_sector(lat, lon) == name


def test_every_edge_and_its_neighbours(spark):
    def around(edges):
        for edge in map(float, edges):
            yield from (edge, math.nextafter(edge, -math.inf), math.nextafter(edge, math.inf))

    points = [(lat, 5.0) for lat in around(LAT_EDGES)]
    points += [(38.0, lon) for lon in around(LON_EDGES)]
    for lat, lon, name in sectors(spark, points):
        assert name == expected_sector(lat, lon), (lat, lon)


two_digits = st.integers(-1000, 5000).map(lambda n: n / 100)
any_double = st.floats(-90, 180, allow_nan=False)


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(two_digits | any_double, two_digits | any_double),
                min_size=50, max_size=400))
def test_same_as_decimal_rule(spark, points):
    for lat, lon, name in sectors(spark, points):
        assert name == expected_sector(lat, lon), (lat, lon)


def test_codes_are_small(spark):
    df = spark.createDataFrame([(math.inf, 0.0), (-math.inf, -math.inf), (0.0, 1e300)],
                               "lat double, lon double")
    codes = [r[0] for r in df.select(cell_code(F.col("lat"), F.col("lon"))).collect()]
    assert codes == [-1, 0, -1]


def test_cell_code_is_worked_out_once_per_row(spark):
    df = spark.range(10).selectExpr("32.5 + id AS lat", "id * 1.0D AS lon")
    df = df.select(F.col("lat").cast("double"), "lon")
    plan = plan_of(with_sector(df).select("sector"))
    assert plan.count("ELSE cast((") == 1
