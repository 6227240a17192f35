"""Property tests: averages against rational arithmetic, pivot against the long
form, upsert idempotence, keyed cells round trip."""

from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from metrolens.functions.numeric import rounded_avg
from metrolens.operators import air
from metrolens.operators.keyed import to_cells, upsert_cells

cents = st.integers(min_value=-50000, max_value=50000)


values = st.floats(min_value=-1000, max_value=1000, allow_nan=False, width=64)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(values, min_size=1, max_size=12), min_size=1, max_size=6))
def test_average_is_of_the_values_as_they_are(spark, groups):
    df = spark.createDataFrame([(g, v) for g, vals in enumerate(groups) for v in vals], "g int, v double")
    got = {r["g"]: (r["two"], r["six"]) for r in df.groupBy("g").agg(rounded_avg("v").alias("two"), rounded_avg("v", 6).alias("six")).collect()}
    for g, vals in enumerate(groups):
        exact = float(sum(map(Fraction, vals)) / len(vals))
        assert abs(got[g][0] - exact) <= 0.005 + 1e-9 and abs(got[g][1] - exact) <= 0.5e-6 + 1e-9


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["S1", "S2", "S3"]), st.integers(0, 3),
                          st.sampled_from(["pm10", "pm25", "no2"]), cents), min_size=1, max_size=40))
def test_pivot_equals_long_form(spark, readings):
    data = [(0, s, 52.0, 21.0, p, f"0{d + 1}-12-2025 0{h}:00:00", abs(c) / 100.0, "x")
            for i, (s, d, p, c) in enumerate(readings) for h in [i % 10]]
    schema = ("location_id long, location_name string, latitude double, longitude double, parameter string, "
              "datetimelocal string, value double, date string")
    df = spark.createDataFrame(data, schema)
    wide = air.pivot_daily(df, "2025-12-01", ["no2", "pm10", "pm25"])
    long_ = (wide.select("location_name", "day", F.expr("stack(3, 'no2', no2, 'pm10', pm10, 'pm25', pm25) AS (parameter, v)"))
                 .where("v IS NOT NULL"))
    r = air.readings_since(df, "2025-12-01", dedupe_keys=["location_name", "datetimelocal", "parameter"], whole_row=False)
    direct = (r.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
               .groupBy("location_name", "day", "parameter").agg(rounded_avg("value", 2).alias("v")))
    assert sorted(map(tuple, long_.collect())) == sorted(map(tuple, direct.select("location_name", "day", "parameter", "v").collect()))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.one_of(st.none(), st.integers(0, 9))), min_size=1, max_size=10),
       st.lists(st.tuples(st.sampled_from(["a", "b", "d"]), st.one_of(st.none(), st.integers(0, 9))), min_size=1, max_size=10))
def test_upsert_is_last_write_per_cell_and_idempotent(spark, first, second):
    f1 = spark.createDataFrame(list(dict(first).items()), "k string, v int")
    f2 = spark.createDataFrame(list(dict(second).items()), "k string, v int")
    c1 = to_cells(f1, F.col("k"), {"cf": ["v"]}, version=1)
    c2 = to_cells(f2, F.col("k"), {"cf": ["v"]}, version=2)
    up = upsert_cells(c1, c2)
    expect = {k: str(v) for k, v in dict(first).items() if v is not None}
    expect.update({k: str(v) for k, v in dict(second).items() if v is not None})
    assert {r["rowkey"]: r["value"] for r in up.collect()} == expect
    again = upsert_cells(up, c2)
    assert sorted(map(tuple, again.select("rowkey", "value").collect())) == sorted(map(tuple, up.select("rowkey", "value").collect()))
