"""Driver contract: entry() runs, queries() and oracle_sql() agree, and a sample of
queries matches DuckDB on the smallest test tables."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

FAST = ["weather_hourly", "weather_by_condition", "precip_stats", "weather_gauges", "restamp_report",
        "dedupe_by_key", "bus_clean", "latest_per_key", "quality_counts", "aq_station_avg", "aq_pivot",
        "aq_corr_matrix", "box_stats", "pm_bands", "sensor_means", "aq_cells", "timetable_explode",
        "line_delay_summary", "keyed_scan", "city_report", "keyed_get", "keyed_upsert", "top_lines", "stops_csv",
        "summary_text_table", "clean_table", "air_rotated", "aq_keyed_reload", "aq_series_stored", "weather_keyed", "nearest_stop", "nearest_departure"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["line", "dt", "hour", "avg_time_diff_minutes", "measurement_count", "total_time_diff"]
    assert df.count() > 0


def test_every_query_has_oracle():
    """Every query of the library itself; those of the training-data operators that SQL
    cannot express are held against brute force in their own tests."""
    own = set(E.queries()) - set(E.LLM_QUERIES)
    assert set(E.oracle_sql()) - set(E.LLM_ORACLE) == own
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(own) >= 40


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ["part", "lineitem", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)

    def norm(v):
        return ("~",) if v is None else (str(round(v, 9)) if isinstance(v, float) else str(v),)

    got = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
    idx = [rel.columns.index(c) for c in cols]
    want = sorted(tuple(norm(r[i]) for i in idx) for r in rel.fetchall())
    assert got == want
