"""Great-circle distance and the spatial grid used for radius joins."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius used for haversine distances.
EARTH_RADIUS_KM = 6371.0
EARTH_RADIUS_M = EARTH_RADIUS_KM * 1000.0

_MARGIN = 1.0 + 1e-6


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Haversine distance in metres between two degree coordinates (one column expression)."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dlat = p2 - p1
    dlon = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    c = F.lit(2.0) * F.asin(F.least(F.sqrt(a), F.lit(1.0)))
    return c * F.lit(EARTH_RADIUS_KM) * F.lit(1000.0)


class Grid:
    """Equal-latitude bands; each band has its own longitude cell width.

    With k cells per radius, a band's cell width is 1/k of the widest longitude gap two
    points within `radius_m` can have when one of them lies in that band, so a point
    only needs the (2k+1)x(2k+1) cells around it (3x3 for k=1). The number of columns per band divides 360 exactly, which makes the
    antimeridian wrap (pmod) exact; near the poles a band collapses to one column.
    Everything is a per-row expression: no statistics pass over the data is needed.
    """

    def __init__(self, radius_m: float, cells_per_radius: int = 1):
        if radius_m <= 0 or cells_per_radius < 1:
            raise ValueError("radius_m must be positive and cells_per_radius >= 1")
        self.radius_m = float(radius_m)
        self.k = int(cells_per_radius)
        self.dlat_deg = math.degrees(self.radius_m / EARTH_RADIUS_M)
        self.cell_lat = self.dlat_deg * _MARGIN / self.k
        self.sin_half = math.sin(self.radius_m / (2 * EARTH_RADIUS_M))

    @property
    def offsets(self) -> list[int]:
        """Neighbour offsets: a point within the radius is at most k cells away per axis."""
        return list(range(-self.k, self.k + 1))

    def band(self, lat) -> Column:
        return F.floor(_c(lat) / F.lit(self.cell_lat)).cast("long")

    def columns(self, band: Column) -> Column:
        """Number of longitude cells in a band (>= 1)."""
        lo = F.abs(band * F.lit(self.cell_lat))
        hi = F.abs((band + F.lit(1)) * F.lit(self.cell_lat))
        psi = F.least(F.greatest(lo, hi) + F.lit(self.dlat_deg), F.lit(90.0))
        ratio = F.least(F.lit(self.sin_half) / F.cos(F.radians(psi)), F.lit(1.0))
        width = F.degrees(F.lit(2.0) * F.asin(ratio)) * F.lit(_MARGIN / self.k)
        return F.greatest(F.floor(F.lit(360.0) / width), F.lit(1)).cast("long")

    def column(self, lon, ncols: Column) -> Column:
        return F.pmod(F.floor((_c(lon) + F.lit(180.0)) * ncols / F.lit(360.0)).cast("long"), ncols)
