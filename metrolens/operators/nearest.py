"""Stops: id normalisation and the nearest-stop-within-radius match.

The nearest stop is found with an equi-join on grid cells instead of a cross join. Each
cell has the stops that can be nearest to a point in it. A cell with many of them is
split, and its parts have fewer, until they are few or the cells are tiny; so a point
meets a bounded number of stops however dense they are. The cells are made from the stops
alone, before any point is looked at. Stops that share one position are collapsed first
(the smallest id wins, which is also what the distance tie-break would pick).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metrolens.functions.geo import EARTH_RADIUS_M, Grid, haversine_m
from metrolens.functions.timeparse import time_of_day
from metrolens.operators.common import BROADCAST_MAX_BYTES, dedupe, fits, hash_prefixed

# Fixed value: default match radius in metres.
MAX_DISTANCE_METERS = 700.0
#: A cell with more targets is split; cells have sizes of radius / 2**level, the last about ten metres here.
MOST_CANDIDATES, LEVELS = 64, (0, 1, 3, 6)

STOP_COLUMNS = ["stop_zespol", "stop_slupek", "stop_name", "stop_lat", "stop_lon"]


def pad_short(col, width: int):
    """Left-pad with zeros to `width`; longer ids are kept whole (lpad alone would cut them)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def normalize_stops(stops: DataFrame) -> DataFrame:
    """stop_id 'group_post' -> (group, post); ids without '_' take the post from stop_code."""
    sid = F.col("stop_id")
    has_sep = sid.contains("_")
    parts = F.split(sid, "_")
    group = F.when(has_sep, F.try_element_at(parts, F.lit(1))).otherwise(sid)
    post = F.when(has_sep, F.try_element_at(parts, F.lit(2))).otherwise(F.col("stop_code"))
    return stops.select(
        pad_short(group, 4).alias("stop_zespol"),
        pad_short(post, 2).alias("stop_slupek"),
        F.col("stop_name"),
        F.col("stop_lat").cast("double").alias("stop_lat"),
        F.col("stop_lon").cast("double").alias("stop_lon"),
    )


def _valid_coords(lat, lon):
    return (F.col(lat).isNotNull() & F.col(lon).isNotNull()
            & F.col(lat).between(-90.0, 90.0) & F.col(lon).between(-180.0, 180.0))


def grid_targets(targets: DataFrame, grid: Grid, lat: str, lon: str) -> DataFrame:
    """Copy every target to the (band, cell) keys of the neighbourhood around it; nc is the
    number of cells in the band."""
    t = targets.withColumn("_band", F.explode(F.array(*[grid.band(lat) + F.lit(d) for d in grid.offsets])))
    t = t.withColumn("_nc", grid.columns(F.col("_band"))).withColumn("_cx", grid.column(lon, F.col("_nc")))
    cells = F.array_distinct(F.array(*[F.pmod(F.col("_cx") + F.lit(d), F.col("_nc")) for d in grid.offsets]))
    return t.withColumn("_cell", F.explode(cells)).drop("_cx")


def candidate_cells(targets: DataFrame, grid: Grid, lat: str, lon: str, most: int = MOST_CANDIDATES, levels: tuple = LEVELS) -> DataFrame:
    """(_band0, _cell0, _level, _band, _cell, target columns): for each cell one row for every target that is nearest to
    some point of it within the grid's radius, and perhaps for others.

    With d the distance of a target from the cell's centre and h that of its farthest corner, the
    nearest target of no point lies beyond least(d) + 2h, nor beyond the radius + h. A cell with more
    than `most` targets is split into the cells of the next of `levels` (of size radius / 2**level).
    It tells each part whether it holds a target: its least(d) is then h at most, so that rows
    beyond 3h are not even sorted. There is one shuffle, by the cell of level 0; everything after
    it is sorted within its tasks."""
    names = targets.columns
    cell = ["_band0", "_cell0", "_level", "_band", "_cell"]
    c = grid_targets(targets, grid, lat, lon)
    first = F.struct(F.col("_band").alias("_band0"), F.col("_cell").alias("_cell0"), F.lit(0).alias("_level"), "_band", "_cell", F.lit(False).alias("_held"))
    c = c.select("_nc", *names, F.inline(F.array(first))).repartition("_band0", "_cell0")
    together = Window.partitionBy(*cell)
    for level, finer in zip(levels, [*levels[1:], None]):
        c = _measured(c, grid, lat, lon)
        near = (F.col("_d") <= F.lit(grid.radius_m) + F.col("_h")) & (~F.col("_held") | (F.col("_d") <= F.col("_h") * 3))
        c = c.where(near).withColumn("_least", F.min("_d").over(together))
        c = c.where(F.col("_d") <= F.col("_least") + F.col("_h") * 2)
        if finer is not None:
            n = 1 << (finer - level)
            c = c.withColumns({"_n": F.count(F.lit(1)).over(together), "_parts": F.bit_or(_part_of(grid, lat, lon, finer, n)).over(together)})
            more = (F.col("_level") == level) & (F.col("_n") > most)
            parts = F.array(*[F.struct(F.lit(finer).alias("_level"), (F.col("_band") * n + i).alias("_band"), (F.col("_cell") * n + j).alias("_cell"), _holds(i * n + j, n).alias("_held"))
                              for i in range(n) for j in range(n)])
            c = c.select("_band0", "_cell0", "_nc", *names, F.inline(F.when(more, parts).otherwise(F.array(F.struct("_level", "_band", "_cell", "_held")))))
    return c.select(*cell, *names)


def _part_of(grid: Grid, lat: str, lon: str, finer: int, n: int) -> Column:
    """The bit of that of the n x n parts of the row's cell, cells of level `finer`, that the target lies in; null outside the cell."""
    scale = F.lit(1 << finer)
    band = F.floor(F.col(lat) / F.lit(grid.cell_lat) * scale).cast("long") - F.col("_band") * n
    column = F.pmod(F.floor((F.col(lon) + F.lit(180.0)) * F.col("_nc") / F.lit(360.0) * scale).cast("long"), F.col("_nc") * scale) - F.col("_cell") * n
    inside = band.between(0, n - 1) & column.between(0, n - 1)
    return F.when(inside, F.call_function("shiftleft", F.lit(1).cast("long"), (band * n + column).cast("int")))


def _holds(part: int, n: int) -> Column:
    """Whether a part is known to hold a target; a long tells it of up to 64 parts."""
    return F.coalesce(F.getbit("_parts", F.lit(part)) == 1, F.lit(False)) if n * n <= 64 else F.lit(False)


def _measured(cells: DataFrame, grid: Grid, lat: str, lon: str) -> DataFrame:
    """The rows with _d, the distance of the target from the centre of the cell, and _h, that of its farthest corner."""
    scale = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_level"))
    step = F.lit(grid.cell_lat) / scale
    low, high = F.greatest(F.col("_band") * step, F.lit(-90.0)), F.least((F.col("_band") + 1) * step, F.lit(90.0))
    width = F.lit(360.0) / (F.col("_nc") * scale)
    widest = F.when((low <= 0) & (high >= 0), F.lit(0.0)).otherwise(F.least(F.abs(low), F.abs(high)))  # the latitude where it is
    half = F.sqrt(F.pow(F.radians(high - low) / 4, 2) + F.pow(F.cos(F.radians(widest)) * F.radians(width) / 4, 2))
    h = F.asin(F.least(half, F.lit(1.0))) * F.lit(2 * EARTH_RADIUS_M) + F.lit(0.001)
    d = haversine_m((low + high) / 2, (F.col("_cell") + 0.5) * width - 180.0, lat, lon)
    return cells.select("*", F.inline(F.array(F.struct(h.alias("_h"), d.alias("_d")))))  # see candidate_pairs


def nearest_within(points: DataFrame, targets: DataFrame, key: list[str],
                   radius_m: float = MAX_DISTANCE_METERS, *,
                   point_lat: str = "lat", point_lon: str = "lon",
                   target_lat: str = "stop_lat", target_lon: str = "stop_lon",
                   target_order: list[str] | None = None,
                   distance_col: str = "distance_m",
                   broadcast_max_bytes: int = BROADCAST_MAX_BYTES, raw_col: str | None = None,
                   most: int = MOST_CANDIDATES, levels: tuple = LEVELS) -> DataFrame:
    """For each point (one row per `key`), the nearest target within `radius_m` metres.

    Equivalent to ranking every target by distance and keeping rank 1 if it is within
    the radius, once targets without coordinates are removed. Ties: distance rounded
    to 6 digits, then `target_order`. Points with no target in range are dropped.
    Output: point columns + target columns + distance_col (metres, rounded to 2), and
    `raw_col` with the distance as computed, if named: the match within a smaller radius
    is this match where raw_col is within it.
    """
    order = target_order or [c for c in targets.columns if c not in (target_lat, target_lon)]
    best = candidate_pairs(points, targets, radius_m, point_lat=point_lat, point_lon=point_lon, target_lat=target_lat,
                           target_lon=target_lon, order=order, broadcast_max_bytes=broadcast_max_bytes, most=most, levels=levels)
    dist = haversine_m(point_lat, point_lon, target_lat, target_lon)
    pairs = best.withColumn("_d", dist).where(F.col("_d") <= F.lit(float(radius_m)))
    w = (Window.partitionBy(*hash_prefixed(points, key))
               .orderBy(F.round("_d", 6), *[F.col(c).asc_nulls_last() for c in order]))
    best = pairs.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
    raw = {raw_col: F.col("_d")} if raw_col else {}
    return best.withColumns({distance_col: F.round("_d", 2), **raw}).drop("_rn", "_d")


def candidate_pairs(points: DataFrame, targets: DataFrame, radius_m: float, *, point_lat: str, point_lon: str, target_lat: str,
                    target_lon: str, order: list[str], broadcast_max_bytes: int, most: int = MOST_CANDIDATES, levels: tuple = LEVELS) -> DataFrame:
    """Every point with the targets of its cell.

    Cells that are sure to be small by the scan's statistics are broadcast (no job runs to
    decide it), and a point asks for its cell of every level. Otherwise both sides are shuffled: by
    the cell of level 0 to learn the levels there, then by the cell. AQE splits a skewed cell. Those
    joins say so by a hint: the planner does not count the copies that generators make, takes the cells
    to be as small as the file of targets and would broadcast them, millions of rows, through the driver."""
    grid = Grid(radius_m, 1)
    t = targets.where(_valid_coords(target_lat, target_lon))
    t = dedupe(t, keys=[target_lat, target_lon], order=[F.col(c).asc_nulls_last() for c in order])
    cells = candidate_cells(t, grid, target_lat, target_lon, most, levels)
    small = fits(targets, 2 * len(grid.offsets) ** 2, broadcast_max_bytes)

    def place(level, nc):
        scale = F.call_function("shiftleft", F.lit(1).cast("long"), level)
        x = (F.col(point_lon) + F.lit(180.0)) * nc / F.lit(360.0)
        return F.struct(level.alias("_level"), F.floor(F.col(point_lat) / F.lit(grid.cell_lat) * scale).cast("long").alias("_band"),
                        F.pmod(F.floor(x * scale).cast("long"), nc * scale).alias("_cell"))

    # Keys come out of generators: the optimizer does not look into those, and equalities of
    # such long expressions with their names would keep it busy for minutes.
    p = points.where(_valid_coords(point_lat, point_lon))
    nc = grid.columns(grid.band(point_lat))
    if small:
        p = p.select(*points.columns, F.inline(F.array(*[place(F.lit(x), nc) for x in levels])))
    else:
        first = F.struct(grid.band(point_lat).alias("_band0"), grid.column(point_lon, nc).alias("_cell0"), nc.alias("_nc"))
        p = p.select(*points.columns, F.inline(F.array(first))).join(
            cells.select("_band0", "_cell0", "_level").distinct().hint("merge"), ["_band0", "_cell0"])
        p = p.select(*points.columns, F.inline(F.array(place(F.col("_level"), F.col("_nc")))))
    cells = cells.drop("_band0", "_cell0")
    met = p.join(F.broadcast(cells) if small else cells.hint("merge"), ["_level", "_band", "_cell"])
    return met.select(*points.columns, *targets.columns)


def nearest_stop(pings: DataFrame, stops: DataFrame, radius_m: float = MAX_DISTANCE_METERS,
                 broadcast_max_bytes: int = BROADCAST_MAX_BYTES, raw_col: str | None = None) -> DataFrame:
    """Cleaned pings -> nearest normalised stop within the radius (one row per ping key)."""
    p = pings.select("line", "vehicle_number", "brigade", "lat", "lon", "event_ts",
                     time_of_day("event_ts").alias("time_str"),
                     *[c for c in ("dt", "hr") if c in pings.columns])
    m = nearest_within(p, stops.select(*STOP_COLUMNS), key=["line", "vehicle_number", "event_ts"],
                       radius_m=radius_m, target_order=["stop_zespol", "stop_slupek", "stop_name"],
                       broadcast_max_bytes=broadcast_max_bytes, raw_col=raw_col)
    return m.drop("stop_lat", "stop_lon")


def stop_line_pairs(matches: DataFrame) -> DataFrame:
    """Distinct (stop group, stop post, line) combinations that need a timetable."""
    return matches.select("stop_zespol", "stop_slupek", "line").distinct()
