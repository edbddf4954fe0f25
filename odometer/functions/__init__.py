"""Column-expression building blocks (JVM-side, codegen friendly)."""

from odometer.functions.money import money_sum, to_decimal
from odometer.functions.timeutil import as_instant, as_wall_clock, iso_text, naive_to_utc, parse_event_time
from odometer.functions.zones import box_zone, first_band, grid_zone, zone_of_point

__all__ = [
    "as_instant",
    "as_wall_clock",
    "box_zone",
    "first_band",
    "grid_zone",
    "iso_text",
    "money_sum",
    "naive_to_utc",
    "parse_event_time",
    "to_decimal",
    "zone_of_point",
]
