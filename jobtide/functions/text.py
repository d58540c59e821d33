"""Small text rules: flags, numbers, sizes, times, log links."""

from __future__ import annotations

import posixpath

from pyspark.sql import Column, functions as F

from jobtide import fixed


def parse_flag(text: Column) -> Column:
    """true/yes and false/no in any case, a missing flag is false, the rest is an error."""
    lowered = F.lower(text)
    complaint = F.concat(F.lit("not a yes/no flag: "), text)
    return (
        F.when(text.isNull() | lowered.isin("false", "no"), F.lit(False))
        .when(lowered.isin("true", "yes"), F.lit(True))
        .otherwise(F.raise_error(complaint).cast("boolean"))
    )


def parse_position(text: Column) -> Column:
    """Whole number, or NULL for anything that is not one."""
    whole = text.rlike(r"^\s*[+-]?[0-9]+\s*$")
    return F.when(whole, F.trim(text).try_cast("bigint"))


def size_text(size: Column) -> Column:
    """Size with a binary unit and three significant digits."""
    value = size.cast("double")
    scaled = value
    unit = F.lit(fixed.SIZE_UNITS[0])
    for power in range(1, len(fixed.SIZE_UNITS)):
        # the next unit is taken only above 1024 of the present one
        above = value > float(1024**power)
        scaled = F.when(above, value / float(1024**power)).otherwise(scaled)
        unit = F.when(above, fixed.SIZE_UNITS[power]).otherwise(unit)
    digits = (
        F.when(scaled < 10, F.round(scaled, 2))
        .when(scaled < 100, F.round(scaled, 1))
        .when(scaled < 1000, F.round(scaled, 0))
        .when(scaled < 1024, F.round(scaled, -1))
        .otherwise(scaled)
    )
    shown = F.regexp_replace(digits.cast("string"), r"\.0$", "")
    return F.concat(shown, F.lit(" "), unit)


def iso_offset(moment: Column, zone: str = fixed.LOG_ZONE, with_zone: bool = False) -> Column:
    """ISO date-time with the offset of ``zone`` ('Z' for none), whatever the session zone is."""
    instant = moment.cast("timestamp")
    micros = F.unix_micros(instant)
    shifted = F.unix_micros(F.from_utc_timestamp(instant, zone))
    wall = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (shifted / F.lit(1000000)).cast("decimal(18,6)")
    )
    minutes = ((shifted - micros) / F.lit(60000000)).cast("int")
    sign = F.when(minutes < 0, "-").otherwise("+")
    offset = F.when(minutes == 0, F.lit("Z")).otherwise(
        F.concat(
            sign,
            F.lpad(F.floor(F.abs(minutes) / 60).cast("string"), 2, "0"),
            F.lit(":"),
            F.lpad((F.abs(minutes) % 60).cast("string"), 2, "0"),
        )
    )
    clock = F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    clock = F.regexp_replace(clock, r"\.?0+$", "")
    # a whole second has no fraction; put back zeros that belong to the seconds
    clock = F.when(F.pmod(micros, F.lit(1000000)) == 0, F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(clock)
    tail = [F.lit(f"[{zone}]")] if with_zone else []
    return F.concat(clock, offset, *tail)


def age_seconds(moment: Column, now: Column) -> Column:
    """Seconds since ``moment``; negative when it lies ahead."""
    return F.unix_timestamp(now) - F.unix_timestamp(moment)


def log_link(pointer: Column) -> Column:
    """Pointer text as a link: path prefix replaced everywhere, white space removed."""
    swapped = F.replace(pointer, F.lit(fixed.LOG_PATH_PREFIX), F.lit(fixed.LOG_URL_PREFIX))
    return F.regexp_replace(swapped, r"\p{javaWhitespace}+", "")


def normalise_path(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path."""
    segments = F.filter(F.split(path, "/"), lambda s: ~s.isin("", "."))
    resolved = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda kept, s: F.when(s == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))).otherwise(
            F.concat(kept, F.array(s))
        ),
    )
    return F.concat(F.lit("/"), F.array_join(resolved, "/"))


def in_base(path: Column, base: str) -> Column:
    """Does the path, once its dots are resolved, lie in the base folder?"""
    folder = posixpath.normpath(base).rstrip("/")
    resolved = normalise_path(path)
    return (resolved == folder) | resolved.startswith(folder + "/")
