"""Dates, clocks, paths and compass sectors."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

OPEN_END = "9999-01-01"
_SHAPES = {"y": r"\d", "M": r"\d", "d": r"\d", "H": r"\d", "m": r"\d", "s": r"\d"}


def _parse(text: Column, fmt: str) -> Column:
    """Null for text that does not fit; the shape is tested first, as a failed parse is costly."""
    shape = "".join(_SHAPES.get(letter, letter) for letter in re.sub(r"(?<![a-zA-Z])([Md])(?![a-zA-Z])", r"\1?\1", fmt))
    parsed = F.try_to_timestamp(text, F.lit(fmt))
    if not re.fullmatch(r"[yMdHms\-/: ]*", fmt):
        return parsed
    return F.when(text.rlike(f"^{shape}$"), parsed)

_GAME_DATE = r"gid_(\d+)_(\d+)_(\d+)_"
_GAME_ID = r"(gid_\d+_\d+_\d+_[^/]*)"


def path_game_id(path: Column) -> Column:
    """Game directory name found in a file path, null when there is none."""
    return F.nullif(F.regexp_extract(path, _GAME_ID, 1), F.lit(""))


def path_game_date(path: Column) -> Column:
    """Date encoded in the game directory name, null when there is none or it is no date."""
    parts = [F.regexp_extract(path, _GAME_DATE, i) for i in (1, 2, 3)]
    return F.try_to_date(F.concat_ws("-", *parts), "yyyy-M-d")


def path_day(path: Column) -> Column:
    """Date of a ``year_YYYY/month_MM/day_DD`` directory; day 00 is no date and gives null."""
    part = r"year_(\d+)/month_(\d+)/day_(\d+)"
    return F.try_to_date(F.concat_ws("-", *[F.regexp_extract(path, part, i) for i in (1, 2, 3)]), "yyyy-M-d")


def day_path(day: Column) -> Column:
    """Directory of a date in the landing area."""
    return F.date_format(day, "'year_'yyyy/'month_'MM/'day_'dd")


def clock_12h(day: Column, clock: Column, ampm: Column, default: str = "19:00") -> Column:
    """Timestamp from a date and a 12-hour clock; a clock without colon takes the default time.

    A clock that has a colon but cannot be read gives null, as a bad value should stay visible.
    """
    text = F.concat_ws(" ", day.cast("string"), clock, F.upper(ampm))
    fallback = F.to_timestamp_ntz(F.concat_ws(" ", day.cast("string"), F.lit(default)), F.lit("yyyy-MM-dd HH:mm"))
    parsed = F.try_to_timestamp(text, F.lit("yyyy-MM-dd h:mm a")).cast("timestamp_ntz")
    return F.when(clock.contains(":"), parsed).otherwise(fallback)


def zulu(text: Column) -> Column:
    """UTC clock time of an ISO string ending in Z; blank or unreadable gives null."""
    return F.try_to_timestamp(F.nullif(text, F.lit("")), F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")).cast("timestamp_ntz")


def eastern_to_utc(clock: Column) -> Column:
    """UTC clock time of a US Eastern clock time."""
    return F.to_utc_timestamp(clock.cast("timestamp"), "America/New_York").cast("timestamp_ntz")


def hour_of_clock(text: Column) -> Column:
    return F.split(text, ":").getItem(0).try_cast("int")


def parse_any(text: Column, formats: Sequence[str]) -> Column:
    """First format that reads the text decides."""
    return F.coalesce(*[_parse(text, f) for f in formats]).cast("timestamp_ntz")


def is_valid_date(text: Column, fmt: str) -> Column:
    return _parse(text, fmt).isNotNull()


def reformat_date(text: Column, in_fmt: str, out_fmt: str) -> Column:
    """Date text in another format; text that cannot be read is returned as it is."""
    return F.coalesce(F.date_format(_parse(text, in_fmt), out_fmt), text)


def boundary(text: Column) -> Column:
    """Start of a partial date (year, year-month or full date)."""
    return parse_any(text, ["yyyy", "yyyy-M", "yyyy-M-d"]).cast("date")


def boundary_parts(text: Column) -> Column:
    """How many parts (1 to 3) the partial date has, 0 when it is none."""
    chain = F
    for parts, fmt in enumerate(("yyyy", "yyyy-M", "yyyy-M-d"), start=1):
        chain = chain.when(_parse(text, fmt).isNotNull(), parts)
    return chain.otherwise(0)


def angle_between(a: Column, b: Column) -> Column:
    """Smallest angle between two bearings, 0 to 180 degrees."""
    return F.abs(F.pmod(a - b + F.lit(180), F.lit(360)) - F.lit(180))


def in_sector(bearing: Column, axis: Column, half_width: float = 55) -> Column:
    """Bearing lies within ``half_width`` degrees of the axis, across north as well."""
    return angle_between(bearing, axis) <= F.lit(half_width)


def in_opposite_sector(bearing: Column, axis: Column, half_width: float = 55) -> Column:
    return in_sector(bearing + F.lit(180), axis, half_width)


def normal_angle(bearing: Column) -> Column:
    return F.pmod(bearing, F.lit(360))
