"""Display-side labels and row keys, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# PM2.5 severity bands (upper bounds, exclusive) and their names.
BAND_GOOD_BELOW = 25.0
BAND_MEDIUM_BELOW = 50.0
BAND_GOOD = "green"
BAND_MEDIUM = "orange"
BAND_BAD = "red"

# Fixed value: label length before truncation, and the suffix appended.
LABEL_MAX = 15
LABEL_SUFFIX = "..."


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def severity_band(col) -> Column:
    c = _c(col)
    return (F.when(c.isNull(), F.lit(None).cast("string"))
            .when(c < BAND_GOOD_BELOW, F.lit(BAND_GOOD))
            .when(c < BAND_MEDIUM_BELOW, F.lit(BAND_MEDIUM))
            .otherwise(F.lit(BAND_BAD)))


def truncate_label(col, n: int = LABEL_MAX) -> Column:
    c = _c(col)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit(LABEL_SUFFIX))).otherwise(c)


def line_rowkey(dt, hour, line) -> Column:
    """'{dt}_{hour:02d}_{line}'"""
    return F.format_string("%s_%02d_%s", _c(dt), _c(hour).cast("int"), _c(line))


def hour_rowkey(dt, hour) -> Column:
    """'{dt}_{hour:02d}'"""
    return F.format_string("%s_%02d", _c(dt), _c(hour).cast("int"))


def station_day_rowkey(location, day) -> Column:
    """'{location}#{yyyy-MM-dd}'"""
    return F.concat(_c(location), F.lit("#"), _c(day))
