"""Date and time parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: layout of one check-in time.
CHECKIN_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_time(c: Column, layout: str = CHECKIN_FORMAT) -> Column:
    """Text to timestamp after trimming; malformed text gives NULL."""
    return F.try_to_timestamp(F.trim(c), F.lit(layout))


def hour(c: Column) -> Column:
    return F.date_format(c, "HH")


def month_no(c: Column) -> Column:
    return F.date_format(c, "MM")


def month_name(c: Column) -> Column:
    return F.date_format(c, "MMM")


def weekday_no(c: Column) -> Column:
    """Monday is 1, Sunday is 7."""
    return F.weekday(c) + 1


def weekday_name(c: Column) -> Column:
    return F.date_format(c, "E")
