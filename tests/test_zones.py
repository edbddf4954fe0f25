import math

import pytest

from odometer.functions.zones import box_zone, grid_zone, zone_of_point

NAN = float("nan")


@pytest.mark.parametrize(
    "lat,lon,zone",
    [
        (6.90, 79.82, "colombo_south_west"),
        (6.90, 79.90, "colombo_south_east"),
        (6.98, 79.82, "colombo_north_west"),
        (6.98, 79.90, "colombo_north_east"),
        (7.06, 79.90, "outside_service_area"),
    ],
)
def test_quadrants_and_outside(spark, lat, lon, zone):
    assert zone_of_point(spark, lat, lon) == zone


def _zones(spark, rows, strict=False):
    df = spark.createDataFrame(rows, "i int, lat double, lon double")
    return [r["z"] for r in df.select("i", grid_zone("lat", "lon", strict).alias("z")).orderBy("i").collect()]


def test_edges(spark):
    rows = [
        (0, 6.85, 79.80),
        (1, 6.95, 79.875),
        (2, 7.05, 79.95),
        (3, 6.9499, 79.8749),
        (4, None, None),
        (5, None, 90.0),
        (6, 6.9, None),
        (7, NAN, 79.9),
    ]
    assert _zones(spark, rows) == [
        "colombo_south_west",
        "colombo_north_east",
        "colombo_north_east",
        "colombo_south_west",
        "colombo_south_west",
        "outside_service_area",
        "colombo_south_west",
        "outside_service_area",
    ]


def test_strict_sends_unknown_coordinates_outside(spark):
    rows = [(0, None, None), (1, 6.9, None), (2, 6.9, NAN), (3, 6.9, 79.9)]
    assert _zones(spark, rows, strict=True) == [
        "outside_service_area",
        "outside_service_area",
        "outside_service_area",
        "colombo_south_east",
    ]


def test_older_boxes_first_match_half_open(spark):
    rows = [
        (0, 6.90, 79.83),  # central (lower bounds closed)
        (1, 6.94, 79.85),  # central upper lat is open -> west? no: lon 79.85 not west -> Other
        (2, 6.92, 79.88),  # central upper lon open -> east
        (3, 6.95, 79.81),  # west
        (4, 7.05, 79.81),  # west upper lat open -> Other
        (5, 6.89, 79.90),  # below all boxes
    ]
    df = spark.createDataFrame(rows, "i int, lat double, lon double")
    got = [r["z"] for r in df.select("i", box_zone().alias("z")).orderBy("i").collect()]
    assert got == ["Colombo-Central", "Other", "Colombo-East", "Colombo-West", "Other", "Other"]


def test_nan_is_not_a_python_float_zone(spark):
    assert math.isnan(NAN)
    assert zone_of_point(spark, NAN, 79.9) == "outside_service_area"
