"""DuckDB SQL twins of metrolens.sources.fixtures (same arithmetic, same edge rows).

Each entry is a CTE body over the pre-registered test-table views."""

from __future__ import annotations


def pad(expr: str, width: int) -> str:
    return f"(CASE WHEN length({expr}) < {width} THEN lpad({expr}, {width}, '0') ELSE {expr} END)"


def hms(sec: str) -> str:
    return (f"lpad(CAST(({sec}) // 3600 AS VARCHAR), 2, '0') || ':' || "
            f"lpad(CAST((({sec}) % 3600) // 60 AS VARCHAR), 2, '0') || ':' || "
            f"lpad(CAST(({sec}) % 60 AS VARCHAR), 2, '0')")


PINGS = """
SELECT event_type AS line, CAST(user_id AS VARCHAR) AS vehicle_number,
       CAST(user_id % 7 AS VARCHAR) AS brigade,
       52.0::DOUBLE + (event_id % 997) / 2000.0::DOUBLE AS lat,
       20.8::DOUBLE + (event_id % 1009) / 2000.0::DOUBLE AS lon,
       ts AS event_ts, event_id AS ingest_ms,
       strftime(ts, '%Y%m%d') AS dt, strftime(ts, '%H') AS hr
FROM events"""

RAW_PINGS = """
SELECT CASE WHEN event_id % 61 = 0 THEN 90.1::DOUBLE
            ELSE 52.0::DOUBLE + (event_id % 997) / 2000.0::DOUBLE END AS Lat,
       CASE WHEN event_id % 67 = 0 THEN -180.1::DOUBLE
            ELSE 20.8::DOUBLE + (event_id % 1009) / 2000.0::DOUBLE END AS Lon,
       CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 59 = 0 THEN ''
            ELSE CAST(user_id AS VARCHAR) END AS VehicleNumber,
       event_type AS Lines, CAST(user_id % 7 AS VARCHAR) AS Brigade,
       CASE WHEN event_id % 71 = 0 THEN NULL
            ELSE epoch_ms(date_trunc('hour', ts)) + (event_id % 7) * 100 END AS "Time",
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_id END AS ingest_time,
       strftime(ts + INTERVAL 10 MINUTE, '%Y%m%d') AS dt,
       CASE WHEN event_id % 89 = 0 THEN NULL ELSE strftime(ts + INTERVAL 10 MINUTE, '%H') END AS hr
FROM events"""

STOPS_RAW = """
SELECT CASE WHEN p_partkey % 2 = 0
            THEN CAST(p_partkey // 100 AS VARCHAR) || '_' || CAST(p_partkey % 100 AS VARCHAR)
            ELSE CAST(p_partkey // 100 AS VARCHAR) END AS stop_id,
       CASE WHEN p_partkey % 2 = 0 THEN NULL ELSE CAST(p_partkey % 100 AS VARCHAR) END AS stop_code,
       p_name AS stop_name,
       CASE WHEN p_partkey % 101 = 0 THEN NULL
            ELSE 52.0::DOUBLE + ((p_partkey * 37) % 997) / 2000.0::DOUBLE END AS stop_lat,
       20.8::DOUBLE + ((p_partkey * 101) % 1009) / 2000.0::DOUBLE AS stop_lon
FROM part"""

STOPS = f"""
SELECT {pad("CASE WHEN contains(stop_id, '_') THEN split_part(stop_id, '_', 1) ELSE stop_id END", 4)} AS stop_zespol,
       {pad("CASE WHEN contains(stop_id, '_') THEN split_part(stop_id, '_', 2) ELSE stop_code END", 2)} AS stop_slupek,
       stop_name, stop_lat, stop_lon
FROM stops_raw"""

TIMETABLE_BASE = f"""
SELECT {pad("CAST(l_partkey // 100 AS VARCHAR)", 4)} AS stop_zespol,
       {pad("CAST(l_partkey % 100 AS VARCHAR)", 2)} AS stop_slupek,
       CASE l_linenumber % 5 WHEN 0 THEN 'click' WHEN 1 THEN 'error' WHEN 2 THEN 'purchase'
            WHEN 3 THEN 'signup' ELSE 'view' END AS line,
       (l_orderkey * 613 + l_linenumber * 7919) % 90000 AS sec_raw,
       l_orderkey * 8 + l_linenumber AS pos,
       l_orderkey, l_linenumber, l_suppkey,
       CASE WHEN l_linenumber = 7 THEN '' ELSE 'dir-' || CAST(l_suppkey % 4 AS VARCHAR) END AS direction
FROM lineitem"""

TIMETABLE = f"""
SELECT stop_zespol, stop_slupek, line, pos,
       CASE WHEN l_orderkey % 211 = 0 THEN '8h' WHEN l_orderkey % 223 = 0 THEN ''
            ELSE {hms("sec_raw")} END AS time_text,
       direction
FROM tt_base"""

# Independent parse of 'H:M:S' entries: hour folded % 24, minute/second 0..59.
def parsed_from(src: str) -> str:
    return TIMETABLE_PARSED.replace("FROM timetable))", f"FROM {src}))").replace("line, pos, direction", "line, feed_id, pos, direction")


TIMETABLE_PARSED = """
SELECT stop_zespol, stop_slupek, line, pos, direction,
       ((h % 24) + 24) % 24 * 3600 + m * 60 + s AS sec,
       lpad(CAST(((h % 24) + 24) % 24 AS VARCHAR), 2, '0') || ':' || p[2] || ':' || p[3] AS scheduled_time
FROM (SELECT *, TRY_CAST(p[1] AS INTEGER) AS h, TRY_CAST(p[2] AS INTEGER) AS m,
             TRY_CAST(p[3] AS INTEGER) AS s
      FROM (SELECT *, string_split(time_text, ':') AS p FROM timetable))
WHERE len(p) = 3 AND h IS NOT NULL AND m BETWEEN 0 AND 59 AND s BETWEEN 0 AND 59"""

WEATHER = """
SELECT epoch_ms(ts) - epoch_ms(ts) % 600000 AS event_time,
       CAST(user_id AS INTEGER) AS weather_id,
       event_type AS weather_main,
       event_type || ' observed' AS weather_desc,
       value - 20.0::DOUBLE + (event_id % 977) / 31337.0::DOUBLE AS temp,
       value - 22.5::DOUBLE + (event_id % 499) / 17389.0::DOUBLE AS feels_like,
       CAST(980 + event_id % 60 AS INTEGER) AS pressure,
       CAST(event_id % 100 AS INTEGER) AS humidity,
       CASE WHEN event_id % 103 <> 0 THEN (event_id % 200) / 10.0::DOUBLE + (event_id % 83) / 29989.0::DOUBLE END AS wind_speed,
       CASE WHEN event_id % 3 = 0 THEN value / 137.0::DOUBLE END AS rain_1h,
       CASE WHEN event_id % 7 = 0 THEN value / 211.0::DOUBLE WHEN event_id % 7 = 1 THEN 0.0::DOUBLE END AS snow_1h,
       strftime(ts, '%Y-%m-%d') AS dt
FROM events"""

AIR = """
SELECT user_id % 10 AS location_id,
       'Station ' || CAST(user_id % 10 AS VARCHAR) || CASE WHEN user_id % 2 = 0 THEN ' Centrum' ELSE '' END AS location_name,
       52.2::DOUBLE + (user_id % 10) / 100.0::DOUBLE AS latitude,
       21.0::DOUBLE + (user_id % 10) / 50.0::DOUBLE AS longitude,
       CASE WHEN event_id % 17 = 0 THEN 'co' WHEN event_type = 'click' THEN 'pm25' WHEN event_type = 'error' THEN 'pm10'
            WHEN event_type = 'purchase' THEN 'no2'
            WHEN event_type = 'signup' THEN CASE WHEN user_id % 10 = 9 THEN 'so2' ELSE 'o3' END
            ELSE 'temperature' END AS parameter,
       CASE WHEN event_id % 97 = 0 THEN 'n/a' ELSE strftime(ts, '%d-%m-%Y %H:00:00') END AS datetimelocal,
       CASE WHEN event_id % 101 <> 0 THEN value + (event_id % 613) / 7919.0::DOUBLE END AS value,
       strftime(ts, '%Y-%m-%d') AS date
FROM events"""

# Haversine in SQL, same formula as metrolens.functions.geo.haversine_m.
def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (f"(2.0 * asin(least(sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + "
            f"cos(radians({lat1})) * cos(radians({lat2})) * "
            f"pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)), 1.0)) * 6371.0 * 1000.0)")


# Brute-force nearest stop: every stop inside a lat/lon box that contains the 700 m
# circle for the fixture's latitudes (52.0-52.5), exact distance, rank 1 per ping.
NEAREST_PAIRS = f"""
SELECT p.line, p.vehicle_number, p.brigade, p.lat, p.lon, p.event_ts, p.dt, p.hr,
       strftime(p.event_ts, '%H:%M:%S') AS time_str,
       s.stop_zespol, s.stop_slupek, s.stop_name,
       {haversine_sql("p.lat", "p.lon", "s.stop_lat", "s.stop_lon")} AS d
FROM pings p JOIN stops s
  ON s.stop_lat BETWEEN p.lat - 0.0064 AND p.lat + 0.0064
 AND s.stop_lon BETWEEN p.lon - 0.0110 AND p.lon + 0.0110
WHERE s.stop_lat IS NOT NULL AND s.stop_lon IS NOT NULL"""

NEAREST = """
SELECT line, vehicle_number, brigade, lat, lon, event_ts, dt, hr, time_str,
       stop_zespol, stop_slupek, stop_name, round(d, 2) AS distance_m
FROM (SELECT *, row_number() OVER (PARTITION BY line, vehicle_number, event_ts
                                   ORDER BY round(d, 6), stop_zespol, stop_slupek, stop_name) AS rn
      FROM nearest_pairs WHERE d <= 700.0)
WHERE rn = 1"""

# Brute-force nearest departure: all departures of the (stop, line), min (|diff|, pos).
DEPARTED = """
SELECT line, vehicle_number, brigade, lat, lon, event_ts, dt, hr, time_str,
       stop_zespol, stop_slupek, stop_name, distance_m,
       CAST((200 * diff + 60) // 120 AS DOUBLE) / 100.0 AS time_diff_minutes,
       scheduled_time, direction
FROM (SELECT n.*, d.pos, d.scheduled_time, d.direction,
             abs(hour(n.event_ts) * 3600 + minute(n.event_ts) * 60 + second(n.event_ts) - d.sec) AS diff,
             row_number() OVER (PARTITION BY n.line, n.vehicle_number, n.event_ts
                                ORDER BY abs(hour(n.event_ts) * 3600 + minute(n.event_ts) * 60
                                             + second(n.event_ts) - d.sec), d.pos) AS rn
      FROM nearest n JOIN tt_parsed d
        ON n.stop_zespol = d.stop_zespol AND n.stop_slupek = d.stop_slupek AND n.line = d.line)
WHERE rn = 1"""

SUMMARY = """
SELECT line, dt, CAST(hr AS INTEGER) AS hour,
       CAST((2 * sum(c) + count(*)) // (2 * count(*)) AS DOUBLE) / 100.0 AS avg_time_diff_minutes,
       count(*) AS measurement_count,
       CAST(sum(c) AS DOUBLE) / 100.0 AS total_time_diff
FROM (SELECT *, CAST(round(time_diff_minutes * 100) AS BIGINT) AS c FROM departed)
GROUP BY line, dt, hr"""

FEED_ITEMS = f"""
SELECT stop_zespol, stop_slupek, line, pos AS feed_id, 0 AS pos, {hms("sec_raw")} AS time_text, direction FROM tt_base
UNION ALL
SELECT stop_zespol, stop_slupek, line, pos AS feed_id, 1 AS pos, {hms("(sec_raw + 1800) % 90000")} AS time_text,
       '' AS direction FROM tt_base
UNION ALL
SELECT stop_zespol, stop_slupek, line, pos AS feed_id, 3 + i AS pos, {hms("((sec_raw + i * 7) % 90000)")} AS time_text,
       '' AS direction FROM tt_base, generate_series(0, 1099) AS g(i) WHERE l_orderkey % 997 = 0 AND l_linenumber = 1"""

CLEAN_STD = """
SELECT Lines AS line, VehicleNumber AS vehicle_number, Brigade AS brigade, Lat AS lat, Lon AS lon,
       date_trunc('second', make_timestamp("Time" * 1000)) AS event_ts, ingest_time AS ingest_ms,
       dt AS src_dt, hr AS src_hr
FROM raw_pings"""

CLEAN_VALID = """
SELECT line, vehicle_number, brigade, lat, lon, event_ts, ingest_ms,
       strftime(event_ts, '%Y%m%d') AS dt, strftime(event_ts, '%H') AS hr
FROM clean_std
WHERE src_dt IS NOT NULL AND src_hr IS NOT NULL
  AND vehicle_number IS NOT NULL AND length(vehicle_number) > 0
  AND lat IS NOT NULL AND lon IS NOT NULL AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180
  AND event_ts IS NOT NULL"""

CLEANED = """
SELECT line, vehicle_number, brigade, lat, lon, event_ts, ingest_ms, dt, hr
FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_number, event_ts
        ORDER BY ingest_ms DESC NULLS LAST, line ASC NULLS LAST, brigade ASC NULLS LAST,
                 lat ASC NULLS LAST, lon ASC NULLS LAST, ingest_ms ASC NULLS LAST,
                 dt ASC NULLS LAST, hr ASC NULLS LAST) AS rn
      FROM clean_valid)
WHERE rn = 1"""

CTES = {
    "feed_items": FEED_ITEMS,
    "feed_parsed": parsed_from("feed_items"),
    "clean_std": CLEAN_STD,
    "clean_valid": CLEAN_VALID,
    "cleaned": CLEANED,
    "pings": PINGS,
    "raw_pings": RAW_PINGS,
    "stops_raw": STOPS_RAW,
    "stops": STOPS,
    "tt_base": TIMETABLE_BASE,
    "timetable": TIMETABLE,
    "tt_parsed": TIMETABLE_PARSED,
    "weather": WEATHER,
    "air": AIR,
    "nearest_pairs": NEAREST_PAIRS,
    "nearest": NEAREST,
    "departed": DEPARTED,
    "summary": SUMMARY,
}

# Dependencies between the CTEs above (so each query only carries what it uses).
DEPENDS = {
    "feed_items": ["tt_base"],
    "feed_parsed": ["feed_items"],
    "clean_std": ["raw_pings"],
    "clean_valid": ["clean_std"],
    "cleaned": ["clean_valid"],
    "stops": ["stops_raw"],
    "timetable": ["tt_base"],
    "tt_parsed": ["timetable"],
    "nearest_pairs": ["pings", "stops"],
    "nearest": ["nearest_pairs"],
    "departed": ["nearest", "tt_parsed"],
    "summary": ["departed"],
}


def with_ctes(body: str, *names: str, extra_ctes: dict | None = None) -> str:
    """Prefix `body` with the named fixture CTEs (and their dependencies, in order)."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in DEPENDS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    if not order and not extra_ctes:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in order)
    extra = ",\n".join(f"{n} AS ({q.strip()})" for n, q in (extra_ctes or {}).items())
    if extra:
        ctes = ctes + ",\n" + extra
    return f"WITH {ctes}\n{body.strip()}"


def chain_ctes(radius_m: float, suffix: str) -> dict:
    """The nearest-stop -> departure -> summary chain at another radius, as extra CTEs."""
    r = repr(float(radius_m))
    return {
        f"nearest{suffix}": NEAREST.replace("nearest_pairs WHERE d <= 700.0", f"nearest_pairs WHERE d <= {r}"),
        f"departed{suffix}": DEPARTED.replace("FROM nearest n JOIN", f"FROM nearest{suffix} n JOIN"),
        f"summary{suffix}": SUMMARY.replace("FROM departed)", f"FROM departed{suffix})"),
    }
