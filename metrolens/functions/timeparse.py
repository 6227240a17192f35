"""Time conversions. All wall-clock values are TIMESTAMP_NTZ so results do not move
with the session zone; conversions that need a zone take it as an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# input/output formats.
FMT_DMY = "dd-MM-yyyy HH:mm:ss"      # air-quality readings
FMT_DT = "yyyyMMdd"                  # ping partitions
FMT_DAY = "yyyy-MM-dd"               # day keys
FMT_HMS = "HH:mm:ss"                 # time of day
SECONDS_PER_DAY = 86400


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ntz_from_epoch_ms(col, tz: str = "UTC") -> Column:
    """Epoch milliseconds -> wall-clock TIMESTAMP_NTZ in zone `tz` (ms kept)."""
    utc = F.timestamp_add("MILLISECOND", _c(col), _epoch())
    if tz.upper() == "UTC":
        return utc
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def epoch_ms(col) -> Column:
    """Wall-clock UTC TIMESTAMP_NTZ -> epoch milliseconds."""
    return F.timestamp_diff("MILLISECOND", _epoch(), _c(col))


def truncate_second(col) -> Column:
    """Drop sub-second digits of a TIMESTAMP_NTZ (zone-free; date_trunc would return
    a session-zone TIMESTAMP)."""
    c = _c(col)
    micros = F.timestamp_diff("MICROSECOND", _epoch(), c)
    return F.timestamp_add("MICROSECOND", -F.pmod(micros, F.lit(1000000)), c)


def truncate_hour(col) -> Column:
    c = _c(col)
    micros = F.timestamp_diff("MICROSECOND", _epoch(), c)
    return F.timestamp_add("MICROSECOND", -F.pmod(micros, F.lit(3600 * 1000000)), c)


def seconds_of_day(col) -> Column:
    c = _c(col)
    return F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def time_of_day(col) -> Column:
    return F.date_format(_c(col), FMT_HMS)


def dt_key(col) -> Column:
    return F.date_format(_c(col), FMT_DT)


def hr_key(col) -> Column:
    return F.lpad(F.hour(_c(col)).cast("string"), 2, "0")


def day_key(col) -> Column:
    return F.date_format(_c(col), FMT_DAY)


def parse_ntz(col, fmt: str | None = None) -> Column:
    """Lenient parse (NULL on malformed input, never an ANSI error) to TIMESTAMP_NTZ.

    The text is parsed as UTC and read back as UTC wall time, whatever the session's
    zone, so that no hour is moved or lost where that zone changes its clock."""
    if fmt is None:
        return _c(col).try_cast("timestamp_ntz")
    utc = F.try_to_timestamp(F.concat(_c(col), F.lit(" +0000")), F.lit(f"{fmt} xx"))
    return F.timestamp_add("MICROSECOND", F.unix_micros(utc), _epoch())


def restamp(col, date_str: str) -> Column:
    """Keep the time of day, replace the date with `date_str` (yyyy-MM-dd)."""
    return parse_ntz(F.concat(F.lit(date_str + " "), time_of_day(col)))


def hour_stamp(date_col, hour_col) -> Column:
    """Timestamp from a yyyy-MM-dd day and an hour number ('d h:00:00'; 1-digit hours parse)."""
    return parse_ntz(F.concat(_c(date_col), F.lit(" "), _c(hour_col).cast("string"), F.lit(":00:00")))


def dt_to_day(col) -> Column:
    """yyyyMMdd partition value -> yyyy-MM-dd day key (string slicing, no parse)."""
    c = _c(col)
    return F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))


# Fixed value: a timetable time entry that parses (hour of up to 9 digits, optionally
# signed and padded; minute and second 0..59 with one or two digits; parts after the
# third are not looked at).
HMS_PATTERN = r"^\s*[+-]?\d{1,9}\s*:[0-5]?\d:[0-5]?\d(:.*)?$"


def hms_valid(col) -> Column:
    return F.coalesce(_c(col).rlike(HMS_PATTERN), F.lit(False))


def hms_parts(col) -> tuple[Column, Column]:
    """(seconds of day, normalised text) of an entry that satisfies hms_valid.

    Hours of 24 and more fold with % 24; the text keeps the minute and second parts
    as written and zero-pads the folded hour."""
    parts = F.split(_c(col), ":")
    hh = F.pmod(F.try_element_at(parts, F.lit(1)).try_cast("int"), F.lit(24))
    mm = F.try_element_at(parts, F.lit(2))
    ss = F.try_element_at(parts, F.lit(3))
    secs = hh * 3600 + mm.try_cast("int") * 60 + ss.try_cast("int")
    text = F.concat(F.lpad(hh.cast("string"), 2, "0"), F.lit(":"), mm, F.lit(":"), ss)
    return secs, text
