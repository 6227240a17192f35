import json

from pyspark.sql import functions as F

from metrolens.operators.schedule import nearest_departure, parse_timetable, punctuality, timetable_explode

MATCH = "stop_zespol string, stop_slupek string, line string, vehicle_number string, event_ts timestamp_ntz"
TT = "stop_zespol string, stop_slupek string, line string, pos long, time_text string, direction string"


def _matches(spark, times):
    data = [("0001", "01", "L1", f"v{i}", None) for i in range(len(times))]
    df = spark.createDataFrame(data, MATCH)
    ts = F.element_at(F.array(*[F.lit(t) for t in times]),
                      (F.regexp_extract("vehicle_number", r"(\d+)", 1).cast("int") + 1)).cast("timestamp_ntz")
    return df.withColumn("event_ts", ts)


def _tt(spark, entries):
    return spark.createDataFrame([("0001", "01", "L1", i, t, d) for i, (t, d) in enumerate(entries)], TT)


def _run(spark, times, entries, wrap=False):
    out = nearest_departure(_matches(spark, times), _tt(spark, entries), wrap=wrap)
    return {r["vehicle_number"]: (r["time_diff_minutes"], r["scheduled_time"], r["direction"]) for r in out.collect()}


def test_nearest_departure_basic_and_skips(spark):
    got = _run(spark, ["2026-01-10 08:10:00"],
               [("8h", "x"), ("", "y"), ("08:00:00", "A"), ("08:30:00", "B"), ("08:12:30", "C")])
    assert got == {"v0": (2.5, "08:12:30", "C")}


def test_equal_distance_first_feed_entry_wins(spark):
    got = _run(spark, ["2026-01-10 08:10:00"], [("08:15:00", "later"), ("08:05:00", "earlier")])
    assert got["v0"][2] == "later"
    got = _run(spark, ["2026-01-10 08:10:00"], [("08:05:00", "earlier"), ("08:15:00", "later")])
    assert got["v0"][2] == "earlier"


def test_hour_24_folds(spark):
    got = _run(spark, ["2026-01-10 00:06:00"], [("24:05:00", "N")])
    assert got["v0"] == (1.0, "00:05:00", "N")


def test_midnight_no_wrap_default_and_wrap_option(spark):
    got = _run(spark, ["2026-01-10 23:58:00"], [("00:02:00", "N")])
    assert got["v0"][0] == 1436.0
    got = _run(spark, ["2026-01-10 23:58:00"], [("00:02:00", "N"), ("12:00:00", "M")], wrap=True)
    assert got["v0"][0] == 4.0


def test_no_parsable_departure_drops_ping(spark):
    assert _run(spark, ["2026-01-10 08:00:00"], [("8h", "x"), ("", "y")]) == {}


def test_many_pings_same_second_and_minutes_rounding(spark):
    got = _run(spark, ["2026-01-10 08:00:01", "2026-01-10 08:00:01", "2026-01-10 07:59:58"],
               [("08:00:00", "A")])
    assert got == {"v0": (0.02, "08:00:00", "A"), "v1": (0.02, "08:00:00", "A"), "v2": (0.03, "08:00:00", "A")}


def test_punctuality_flags(spark):
    df = spark.createDataFrame([(3.0,), (3.01,), (0.0,)], "time_diff_minutes double")
    out = [(r[1], r[2]) for r in punctuality(df).collect()]
    assert out == [(True, False), (False, True), (True, False)]


def test_timetable_explode_payload(spark):
    payload = json.dumps({"result": [
        [{"key": "brygada", "value": "1"}, {"key": "kierunek", "value": "Centrum"}, {"key": "czas", "value": "05:12:00"}],
        [],
        [{"key": "czas", "value": "24:05:00"}],
        [{"key": "kierunek", "value": "X"}, {"key": "czas", "value": ""}],
    ]})
    df = spark.createDataFrame([("0001", "01", "L1", payload)], "stop_zespol string, stop_slupek string, line string, payload string")
    raw = timetable_explode(df, "payload").orderBy("pos").collect()
    assert [(r["pos"], r["time_text"], r["direction"]) for r in raw] == [(0, "05:12:00", "Centrum"), (2, "24:05:00", ""), (3, "", "X")]
    parsed = parse_timetable(timetable_explode(df, "payload")).orderBy("pos").collect()
    assert [(r["sec"], r["scheduled_time"]) for r in parsed] == [(5 * 3600 + 12 * 60, "05:12:00"), (300, "00:05:00")]


def test_hot_key_is_resolved_per_second_not_per_pair(spark):
    """One (stop, line) with many pings and many departures: the answer must equal the
    brute-force minimum; the plan never pairs pings with departures."""
    import random

    rnd = random.Random(11)
    secs = sorted(rnd.sample(range(0, 86400), 300))
    entries = [(f"{s // 3600:02d}:{s % 3600 // 60:02d}:{s % 60:02d}", f"d{s}") for s in secs]
    ping_secs = [rnd.randrange(0, 86400) for _ in range(500)]
    times = [f"2026-01-10 {p // 3600:02d}:{p % 3600 // 60:02d}:{p % 60:02d}" for p in ping_secs]
    got = _run(spark, times, entries)
    for i, p in enumerate(ping_secs):
        best = min((abs(p - s), j) for j, s in enumerate(secs))
        want = round(best[0] / 60 + 1e-9, 2)
        assert abs(got[f"v{i}"][0] - want) < 1e-9, (p, got[f"v{i}"], best)


def test_parts_after_the_third_are_not_looked_at(spark):
    got = _run(spark, ["2026-01-10 08:10:00"], [("08:09:00:59", "A"), ("08:00:00:", "B"), ("08:10", "two"), ("08:10:00x", "bad")])
    assert got == {"v0": (1.0, "08:09:00", "A")}


def test_nothing_runs_while_the_query_is_built(spark):
    from tests.test_keyed import jobs_of

    df, built = jobs_of(spark, lambda: nearest_departure(_matches(spark, ["2026-01-10 08:00:01"]), _tt(spark, [("08:00:00", "A")])))
    assert built == 0 and df.count() == 1


def test_pings_without_a_departure_can_stay(spark):
    times = ["2026-01-10 08:00:01"]
    df = nearest_departure(_matches(spark, times), _tt(spark, [("8h", "A")]), keep_unmatched=True)
    assert [(r["vehicle_number"], r["time_diff_minutes"]) for r in df.collect()] == [("v0", None)]
    none = _matches(spark, times).withColumn("event_ts", F.lit(None).cast("timestamp_ntz"))
    assert nearest_departure(none, _tt(spark, [("08:00:00", "A")])).count() == 0
    assert nearest_departure(none, _tt(spark, [("08:00:00", "A")]), keep_unmatched=True).first()["time_diff_minutes"] is None


def test_every_second_of_odd_lists(spark):
    for secs in ([5], [5, 5, 9], [0, 86399], list(range(0, 86400, 4001))):
        entries = [(f"{s // 3600:02d}:{s % 3600 // 60:02d}:{s % 60:02d}", f"d{i}") for i, s in enumerate(secs)]
        asked = [0, 4, 5, 6, 7, 8, 9, 10, 4000, 4001, 43200, 86398, 86399]
        got = _run(spark, [f"2026-01-10 {p // 3600:02d}:{p % 3600 // 60:02d}:{p % 60:02d}" for p in asked], entries)
        for i, p in enumerate(asked):
            diff, j = min((abs(p - s), j) for j, s in enumerate(secs))
            assert got[f"v{i}"][2] == f"d{j}"
