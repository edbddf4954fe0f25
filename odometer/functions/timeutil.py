"""Timestamp parsing and normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_event_time(c: Column | str = "timestamp") -> Column:
    """ISO-8601 text (offset aware) to a UTC instant; malformed -> NULL."""
    return F.try_to_timestamp(_col(c))


def iso_text(c: Column | str) -> Column:
    """Microsecond ISO-8601 text with an explicit UTC offset."""
    return F.concat(F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def as_instant(c: Column | str) -> Column:
    """TIMESTAMP_NTZ (wall clock in UTC) to TIMESTAMP; lossless under UTC."""
    return _col(c).cast("timestamp")


def as_wall_clock(c: Column | str) -> Column:
    """TIMESTAMP to TIMESTAMP_NTZ in the (UTC) session zone."""
    return _col(c).cast("timestamp_ntz")


def naive_to_utc(c: Column | str, local_zone: str) -> Column:
    """A naive wall-clock time taken in ``local_zone``, expressed in UTC."""
    return F.to_utc_timestamp(_col(c), local_zone)


def ts_literal(value) -> Column:
    """A TIMESTAMP literal that does not depend on the driver's local zone.

    Aware datetimes are converted to UTC; naive datetimes and text are taken
    as UTC wall-clock (the session zone), the rule the freshness check uses.
    """
    import datetime as _dt

    if isinstance(value, Column):
        return value.cast("timestamp")
    if isinstance(value, _dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp")
