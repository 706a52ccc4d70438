"""Times in messages are local digits; tables hold instants."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The zone of the message times, and the zone name of the medication feed.
LOCAL_ZONE = "US/Central"
MEDICATION_ZONE = "CST"
# How many digits a time may have.
LENGTHS = (8, 12, 14)


def instant_sql(digits: str, zone: str) -> str:
    """SQL for local digits in ``zone`` as an instant, NULL where they are no time.

    The zone is part of the text that is cast, so the session's zone does not matter.
    """

    def pair(start: int) -> str:
        two = f"substring({digits}, {start}, 2)"
        return two if start < min(LENGTHS) else f"rpad({two}, 2, '0')"

    text = (
        f"concat(substring({digits}, 1, 4), '-', substring({digits}, 5, 2), '-', substring({digits}, 7, 2), "
        f"' ', {pair(9)}, ':', {pair(11)}, ':', {pair(13)}, ' {zone}')"
    )
    known = f"length({digits}) IN ({', '.join(map(str, LENGTHS))}) AND trim(LEADING '0123456789' FROM {digits}) = ''"
    return f"try_cast(CASE WHEN {known} THEN {text} END AS timestamp)"


def utc_instant_sql(digits: str) -> str:
    """SQL for 14 digits in UTC as an instant, NULL where they are no time.

    Only the day is read as text; UTC has no clock changes, so the rest is counted in seconds. Reading a text with a zone
    would look up the zone for every value.
    """
    # Behind a one, 14 digits are a number of 15; what is no digit leaves fewer or no number.
    number = f"try_cast(concat('1', {digits}) AS bigint)"
    hour, minute, second = f"{number} div 10000 % 100", f"{number} div 100 % 100", f"{number} % 100"
    day = f"concat(substring({digits}, 1, 4), '-', substring({digits}, 5, 2), '-', substring({digits}, 7, 2))"
    known = f"length({digits}) = 14 AND {number} >= {10**14} AND {hour} < 24 AND {minute} < 60 AND {second} < 60"
    seconds = f"unix_date(try_cast({day} AS date)) * 86400L + {hour} * 3600 + {minute} * 60 + {second}"
    return f"CASE WHEN {known} THEN timestamp_seconds({seconds}) END"


def parse_local(df: DataFrame, columns: Iterable[str], zone: str = LOCAL_ZONE) -> DataFrame:
    """Turn text columns of local digits in ``zone`` into instants.

    ``yyyyMMdd``, ``yyyyMMddHHmm`` and ``yyyyMMddHHmmss`` are read, anything else is NULL. The
    hour that autumn repeats reads as its second (standard time) pass; the cast takes the
    first, so one hour is added where both look alike.

    A frame function and not an expression: the two steps are projections over plain columns.
    """
    columns = list(columns)

    def standard(c: str) -> str:
        later = f"{c} + INTERVAL 1 HOUR"
        same = f"from_utc_timestamp({c}, '{zone}') = from_utc_timestamp({later}, '{zone}')"
        return f"CASE WHEN {same} THEN {later} ELSE {c} END"

    first = df.withColumns({c: F.expr(instant_sql(f"`{c}`", zone)) for c in columns})
    return first.withColumns({c: F.expr(standard(f"`{c}`")) for c in columns})


def parse_shifted(column: str, zone: str = MEDICATION_ZONE) -> Column:
    """A column of 14 digits read as UTC and then moved to the wall clock of ``zone``."""
    return F.expr(f"from_utc_timestamp({utc_instant_sql(f'`{column}`')}, '{zone}')")


def local_text(instant: Column, zone: str = LOCAL_ZONE) -> Column:
    """Wall clock of ``zone`` with its offset, as in ``2024-01-15 09:30:00-06:00``."""
    local = F.from_utc_timestamp(instant, zone)
    minutes = F.timestamp_diff("MINUTE", instant, local)
    sign = F.when(minutes < 0, "-").otherwise("+")
    offset = F.format_string("%02d:%02d", F.floor(F.abs(minutes) / 60), F.abs(minutes) % 60)
    return F.concat(local.cast("string"), sign, offset)


def shift_timestamps(df: DataFrame, zone: str = LOCAL_ZONE, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Move every timestamp column from UTC to the wall clock of ``zone``."""
    return df.withColumns(
        {
            f.name: F.from_utc_timestamp(f.name, zone)
            for f in df.schema
            if isinstance(f.dataType, T.TimestampType) and f.name not in ignore
        }
    )
