"""Epoch seconds to zone-free UTC and local time.

Both work on `timestamp_ntz`, so results do not depend on the session time
zone and local times that a zone skips come out right.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NEW_YORK = "America/New_York"


def utc_timestamp(epoch: Column) -> Column:
    """Epoch seconds (double, fraction dropped) as a UTC `timestamp_ntz`."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", epoch.cast("bigint"), start)


def utc_text(epoch: Column) -> Column:
    """Epoch seconds as `yyyy-MM-dd HH:mm:ss` in UTC."""
    return utc_timestamp(epoch).cast("string")


def local_timestamp(utc: Column, zone: str = NEW_YORK) -> Column:
    """UTC text or `timestamp_ntz` as local time in `zone`, DST included."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc.cast("timestamp_ntz"))
