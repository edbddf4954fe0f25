"""Zone rules as Column expressions (never Python UDFs).

Two zone systems exist and disagree on purpose: the primary four-quadrant
grid, and an older first-match table of half-open boxes.
"""

from __future__ import annotations

import functools
import math
import operator

from pyspark.sql import Column
from pyspark.sql import functions as F

# The primary service rectangle, its split lines and zone names.
SERVICE_LAT_MIN = 6.85
SERVICE_LAT_MAX = 7.05
SERVICE_LON_MIN = 79.80
SERVICE_LON_MAX = 79.95
NORTH_FROM_LAT = 6.95
EAST_FROM_LON = 79.875
OUTSIDE_ZONE = "outside_service_area"
NORTH_EAST, NORTH_WEST = "colombo_north_east", "colombo_north_west"
SOUTH_EAST, SOUTH_WEST = "colombo_south_east", "colombo_south_west"

# The grid as half-open bands (name, lat from, lat below, lon from, lon below),
# None being open.  The rectangle is closed, so what lies beyond its upper edges
# begins at the next double.
GRID_BANDS = (
    (OUTSIDE_ZONE, None, SERVICE_LAT_MIN, None, None),
    (OUTSIDE_ZONE, math.nextafter(SERVICE_LAT_MAX, math.inf), None, None, None),
    (OUTSIDE_ZONE, None, None, None, SERVICE_LON_MIN),
    (OUTSIDE_ZONE, None, None, math.nextafter(SERVICE_LON_MAX, math.inf), None),
    (NORTH_EAST, NORTH_FROM_LAT, None, EAST_FROM_LON, None),
    (NORTH_WEST, NORTH_FROM_LAT, None, None, None),
    (SOUTH_EAST, None, None, EAST_FROM_LON, None),
)

# The older zone boxes, checked in this order, first match
# wins; each box is (name, lat_low, lat_high, lon_low, lon_high), half-open.
OLDER_ZONE_BOXES = (
    ("Colombo-Central", 6.90, 6.94, 79.83, 79.88),
    ("Colombo-East", 6.90, 6.98, 79.88, 79.95),
    ("Colombo-West", 6.90, 7.05, 79.80, 79.83),
)
OLDER_ZONE_FALLBACK = "Other"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_band(lat: Column, lon: Column, bands, default: str) -> Column:
    """Name of the first band that holds the point, else ``default``.  A null
    coordinate is in no band that bounds it; NaN is above every number."""

    def holds(lat_from, lat_below, lon_from, lon_below) -> Column:
        sides = [axis >= F.lit(v) for axis, v in ((lat, lat_from), (lon, lon_from)) if v is not None]
        sides += [axis < F.lit(v) for axis, v in ((lat, lat_below), (lon, lon_below)) if v is not None]
        return functools.reduce(operator.and_, sides)

    return F.coalesce(*[F.when(holds(*bounds), F.lit(name)) for name, *bounds in bands], F.lit(default))


def grid_zone(lat: Column | str = "lat", lon: Column | str = "lon", strict: bool = False) -> Column:
    """The closed-rectangle quadrant grid.

    A NaN coordinate is outside; a null one falls through to the first band
    that doesn't ask for it, at last to the south-west.  ``strict=True`` sends
    any null or NaN coordinate to the outside zone instead.
    """
    lat, lon = _col(lat), _col(lon)
    zone = first_band(lat, lon, GRID_BANDS, SOUTH_WEST)
    if strict:
        known = F.coalesce(~F.isnan(lat) & ~F.isnan(lon) & lat.isNotNull() & lon.isNotNull(), F.lit(False))
        zone = F.when(known, zone).otherwise(F.lit(OUTSIDE_ZONE))
    return zone


def box_zone(
    lat: Column | str = "lat",
    lon: Column | str = "lon",
    boxes=OLDER_ZONE_BOXES,
    fallback: str = OLDER_ZONE_FALLBACK,
) -> Column:
    """First-match zone from a box table (half-open on both axes)."""
    return first_band(_col(lat), _col(lon), boxes, fallback)


def zone_of_point(spark, latitude: float, longitude: float, strict: bool = False) -> str:
    """Scalar form of the grid, evaluated by the same Column expression."""
    row = spark.range(1).select(
        grid_zone(F.lit(latitude).cast("double"), F.lit(longitude).cast("double"), strict).alias("z")
    ).first()
    return row["z"]
