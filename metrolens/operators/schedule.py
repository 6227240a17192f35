"""Timetables: feed payload -> rows, and the nearest-departure (two-sided as-of) match.

nearest_departure never pairs every ping with every departure of its (stop, line). The
timetable becomes one row per (stop, line) with its distinct departure seconds in order,
at most 86,400 of them, whatever the data volume. Pings meet that row in one equi-join
and find the departures around their second by halving the list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metrolens.functions.numeric import half_up_div
from metrolens.functions.timeparse import SECONDS_PER_DAY, hms_parts, hms_valid, seconds_of_day

TIMETABLE_KEY = ["stop_zespol", "stop_slupek", "line"]

# Fixed value: the punctuality limit in minutes.
PUNCTUAL_LIMIT_MIN = 3.0

# Feed payload: {"result": [[{"key": .., "value": ..}, ...], ...]}; per departure the
# time is the last item's value and the direction the second-last item's value, so the
# keys are not parsed.
PAYLOAD_SCHEMA = T.StructType([
    T.StructField("result", T.ArrayType(T.ArrayType(T.StructType([T.StructField("value", T.StringType())])))),
])


def timetable_explode(df: DataFrame, payload: str = "payload", keys: list[str] | None = None,
                      pos_base: str | None = None) -> DataFrame:
    """One row per departure in a JSON feed payload column.

    Output: keys..., pos, time_text, direction. Empty departure lists are skipped;
    a one-item list has no direction (''). `pos` is the position in its payload (used as
    the tie-break, first entry wins); with `pos_base`, the payload's own position, that
    column is kept as feed_id and orders entries before `pos`."""
    keys = list(keys or TIMETABLE_KEY)
    parsed = df.select(*keys, *([pos_base] if pos_base else []),
                       F.from_json(F.col(payload), PAYLOAD_SCHEMA).alias("_p"))
    items = parsed.select(*keys, *([pos_base] if pos_base else []),
                          F.posexplode(F.col("_p.result")).alias("_i", "_item"))
    n = F.size("_item")
    last = F.try_element_at(F.col("_item"), n)
    second_last = F.when(n > 1, F.try_element_at(F.col("_item"), n - 1))
    feed = [F.col(pos_base).cast("long").alias("feed_id")] if pos_base else []
    return (items.where(n > 0)
                 .select(*keys, *feed, F.col("_i").cast("long").alias("pos"),
                         last["value"].alias("time_text"),
                         F.coalesce(second_last["value"], F.lit("")).alias("direction")))


def _position(tt: DataFrame) -> list[str]:
    """The columns that order the entries of a timetable."""
    return [c for c in ("feed_id", "pos") if c in tt.columns]


def parse_timetable(tt: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys, [feed_id,] pos, time_text, direction) -> (keys, [feed_id,] pos, sec, scheduled_time, direction).

    Unparsable or empty times are dropped (they are skipped entries)."""
    keys = list(keys or TIMETABLE_KEY)
    # Validate the raw text first: a cheap predicate that can be pushed to the scan
    # (filtering on the parsed value would be pushed down with the parse inlined).
    sec, text = hms_parts("time_text")
    return (tt.where(hms_valid("time_text"))
              .select(*keys, *_position(tt), sec.alias("sec"), text.alias("scheduled_time"),
                      F.coalesce(F.col("direction"), F.lit("")).alias("direction")))


def departure_lists(departures: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, deps): the distinct departure seconds of each key in order, as structs (sec, pos,
    scheduled_time, direction) of the first entry in feed order of each second."""
    per_sec = (departures.groupBy(*keys, "sec")
                         .agg(F.min(F.struct("pos", "scheduled_time", "direction")).alias("_d")))
    return per_sec.groupBy(*keys).agg(F.sort_array(F.collect_list(
        F.struct("sec", F.col("_d.pos").alias("pos"), F.col("_d.scheduled_time").alias("scheduled_time"),
                 F.col("_d.direction").alias("direction")))).alias("deps"))


def up_to(deps: Column, second: Column) -> Column:
    """How many of the ordered departures leave at or before `second`: the range of possible answers is
    halved as often as the binary digits of the list's length say."""
    def halve(a, _):
        mid = F.call_function("div", a["lo"] + a["hi"], F.lit(2)).cast("int")
        before = F.get(deps, mid)["sec"] <= second
        return F.when(a["lo"] >= a["hi"], a).otherwise(
            F.struct(F.when(before, mid + 1).otherwise(a["lo"]).alias("lo"), F.when(before, a["hi"]).otherwise(mid).alias("hi")))

    whole = F.struct(F.lit(0).alias("lo"), F.size(deps).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.length(F.bin(F.size(deps)))), whole, halve)["lo"]


def nearest_of(deps: Column, second: Column, n: Column, wrap: bool = False) -> Column:
    """The departure nearest to `second`, as a struct (diff, pos, scheduled_time, direction); `n` of the ordered list
    leave at or before it. Ties: smaller time difference, then smaller feed position."""
    around = [F.get(deps, n - 1), F.get(deps, n)]
    if wrap:  # around midnight
        around += [F.get(deps, F.lit(0)), F.get(deps, F.size(deps) - 1)]

    def candidate(d):
        diff = F.abs(second - d["sec"])
        if wrap:
            diff = F.least(diff, F.lit(SECONDS_PER_DAY) - diff)
        return F.struct(diff.alias("diff"), d["pos"].alias("pos"), d["scheduled_time"].alias("scheduled_time"),
                        d["direction"].alias("direction"))

    return F.array_min(F.transform(F.array_compact(F.array(*around)), candidate))


def nearest_departure(matches: DataFrame, timetable: DataFrame, on: list[str] | None = None,
                      wrap: bool = False, keep_unmatched: bool = False) -> DataFrame:
    """Attach the nearest scheduled departure to each matched ping.

    matches: rows with `on` keys and event_ts. timetable: (on..., pos, time_text,
    direction) raw entries. Adds time_diff_minutes (rounded to 2), scheduled_time,
    direction; pings without any parsable departure are dropped, or have NULLs there with
    `keep_unmatched`. By default the time difference does not wrap at midnight (23:58 vs
    00:02 is 1436 minutes); wrap=True measures around the clock. Nothing runs before an
    action, and a hot key on the pings' side is a skewed join that Spark splits.
    """
    keys = list(on or TIMETABLE_KEY)
    deps = parse_timetable(timetable, keys)
    if "feed_id" in deps.columns:
        deps = deps.withColumn("pos", F.struct("feed_id", "pos")).drop("feed_id")
    # The hash makes the lists arrive by a shuffle of the join's own, without which a
    # skewed join is not split.
    lists = departure_lists(deps, keys).select(*[F.col(k).alias(f"_{k}") for k in keys], F.xxhash64(*keys).alias("_lh"), "deps")
    on_keys = F.xxhash64(*[matches[k] for k in keys]) == lists["_lh"]
    for k in keys:
        on_keys = on_keys & (matches[k] == lists[f"_{k}"])
    joined = matches.join(lists, on_keys, "left" if keep_unmatched else "inner").withColumn("_t", seconds_of_day("event_ts"))
    if not keep_unmatched:
        joined = joined.where(F.col("_t").isNotNull())
    joined = joined.withColumn("_n", up_to(F.col("deps"), F.col("_t")))
    joined = joined.withColumn("_best", nearest_of(F.col("deps"), F.col("_t"), F.col("_n"), wrap))
    # minutes = seconds / 60 rounded HALF_UP to 2 digits, on integers (seconds*100/60 never ties)
    cents = half_up_div(F.col("_best.diff").cast("long") * F.lit(100), F.lit(60))
    return (joined.withColumn("time_diff_minutes", cents.cast("double") / F.lit(100.0))
                  .withColumn("scheduled_time", F.col("_best.scheduled_time"))
                  .withColumn("direction", F.col("_best.direction"))
                  .drop("_t", "_n", "_best", "_lh", "deps", *[f"_{k}" for k in keys]))


def punctuality(df: DataFrame, limit_min: float = PUNCTUAL_LIMIT_MIN) -> DataFrame:
    """is_punctual: difference <= limit; is_far_from_timetable: difference > limit."""
    d = F.col("time_diff_minutes")
    return df.withColumn("is_punctual", d <= F.lit(limit_min)).withColumn(
        "is_far_from_timetable", d > F.lit(limit_min))
