"""Local times, UTC times and what they mean at a given moment (``as_of`` is always a parameter)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchmill.fixed_values import DEFAULT_ZONE, LOCAL_TIME_PATTERN, ZONE_ABBREVIATIONS, ZONE_SUFFIX_PATTERN
from matchmill.functions.text import lookup
from matchmill.operators.sides import round_half_up


def parse_local(text: Column) -> Column:
    """``MM/dd/yyyy HH:mm`` with or without a zone suffix; unreadable text gives NULL."""
    bare = F.regexp_replace(text, ZONE_SUFFIX_PATTERN, "")
    iso = F.regexp_replace(bare, LOCAL_TIME_PATTERN, "$3-$1-$2 $4:00")
    return F.when(bare.rlike(LOCAL_TIME_PATTERN), iso.try_cast("timestamp_ntz"))


def with_zone(text: Column, zone: Column) -> Column:
    """Append the zone's abbreviation; unknown zones count as the default zone."""
    default = F.lit(ZONE_ABBREVIATIONS[DEFAULT_ZONE])
    return F.concat_ws(" ", text, lookup(zone, ZONE_ABBREVIATIONS, default))


def to_utc(local: Column, hours_west: Column) -> Column:
    return local + F.make_dt_interval(F.lit(0), hours_west, F.lit(0), F.lit(0))


def zone_to_utc(local: Column, zone: Column) -> Column:
    """The same from a zone id such as ``America/Chicago``, daylight saving included."""
    return F.convert_timezone(zone, F.lit("UTC"), local)


#: By how much clocks are set back, in minutes: half an hour in some places.
TURNS = (60, 30)


def zone_instant(local: Column, zone: Column, later: bool = False) -> Column:
    """The UTC time of a local time in a zone, for every local time there is or is not.

    A time that clocks skip counts as if they had not been set yet, so 02:30 in a gap of an hour is 03:30. Of a time that occurs twice the
    earlier counts, or the later. An unknown zone is an error, NULL gives NULL.
    """
    first = zone_to_utc(local, zone)
    if not later:
        return first
    out = first
    for minutes in reversed(TURNS):
        after = first + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes), F.lit(0))
        out = F.when(F.convert_timezone(F.lit("UTC"), zone, after) == local, after).otherwise(out)
    return out


def local_time_kind(local: Column, zone: Column) -> Column:
    """``gap`` for a local time that clocks skip, ``twice`` for one that occurs twice, else ``once``: by going to UTC and back."""
    first, last = zone_instant(local, zone), zone_instant(local, zone, later=True)
    back = F.convert_timezone(F.lit("UTC"), zone, first)
    return F.when(back != local, "gap").when(first != last, "twice").when(local.isNotNull(), "once")


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def status_at(start: Column, finished: Column, as_of: Column, live_hours: int = 3, late: str = "Finished") -> Column:
    """Finished, Live (started at most ``live_hours`` ago), Upcoming, or ``late`` for an overdue item."""
    return (
        F.when(finished, F.lit("Finished"))
        .when(is_live(start, finished, as_of, live_hours), F.lit("Live"))
        .when(~finished & (start > as_of), F.lit("Upcoming"))
        .otherwise(F.lit(late))
    )


def is_live(start: Column, finished: Column, as_of: Column, live_hours: int = 3) -> Column:
    earliest = as_of - F.make_dt_interval(F.lit(0), F.lit(live_hours), F.lit(0), F.lit(0))
    return F.coalesce(~finished & start.between(earliest, as_of), F.lit(False))


def hours_until(start: Column, as_of: Column) -> Column:
    """Hours to a future start, one decimal; NULL once it has passed."""
    hours = seconds_between(as_of, start).cast("double") / 3600.0
    return F.when(start > as_of, round_half_up(hours, 1))


def minutes_elapsed(start: Column, finished: Column, as_of: Column) -> Column:
    """Whole minutes since an unfinished item started; NULL otherwise."""
    minutes = seconds_between(start, as_of).cast("double") / 60.0
    return F.when(~finished & (start <= as_of), F.floor(minutes + 0.5).cast("double"))


def parse_instant(text: Column) -> Column:
    """A UTC instant from ``yyyy-MM-dd HH:mm:ss`` (taken as UTC) or from ISO text with a zone."""
    sign, colon = F.substring(text, -6, 1), F.substring(text, -3, 1)
    zoned = F.endswith(F.upper(text), F.lit("Z")) | (sign.isin("+", "-") & (colon == ":"))
    instant = F.convert_timezone(F.current_timezone(), F.lit("UTC"), text.try_cast("timestamp").cast("timestamp_ntz"))
    return F.when(zoned, instant).otherwise(text.try_cast("timestamp_ntz"))


def short_label(instant: Column) -> Column:
    """``1 July 26 20:00 UTC``."""
    return F.concat(F.date_format(instant, "d MMMM yy HH:mm"), F.lit(" UTC"))


def delta_label(instant: Column, as_of: Column) -> Column:
    """``in 1d 2h 3m`` or ``2h 5m ago``; zero days and hours are left out."""
    minutes = F.floor(seconds_between(as_of, instant).cast("double") / 60.0 + 0.5).cast("long")
    size = F.abs(minutes)
    days, hours, rest = F.floor(size / 1440), F.floor(size % 1440 / 60), size % 60
    parts = F.concat_ws(
        " ",
        F.when(days > 0, F.concat(days.cast("string"), F.lit("d"))),
        F.when(hours > 0, F.concat(hours.cast("string"), F.lit("h"))),
        F.concat(rest.cast("string"), F.lit("m")),
    )
    return F.when(minutes >= 0, F.concat(F.lit("in "), parts)).when(minutes < 0, F.concat(parts, F.lit(" ago")))
