"""Skew probe: a third of all pings at one position on one line (one hot stop, one hot
(stop, line) key), run through the whole bus chain with the event log on, then report
per stage the largest task's share of the stage's records. usage:
python tools/skew_probe.py [sf_dir] [event_log_dir]"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="skew-")
    from pyspark.sql import functions as F

    from metrolens.operators.delays import line_delay_summary
    from metrolens.operators.nearest import nearest_stop, normalize_stops
    from metrolens.operators.schedule import nearest_departure
    from metrolens.session import build_session
    from metrolens.sources import fixtures as fx

    spark = build_session(extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                 "spark.eventLog.compress": "false"})
    hot = (F.col("ingest_ms") % 3) == 0
    pings = (fx.pings(spark, sf_dir)
               .withColumn("lat", F.when(hot, F.lit(52.25)).otherwise(F.col("lat")))
               .withColumn("lon", F.when(hot, F.lit(21.05)).otherwise(F.col("lon")))
               .withColumn("line", F.when(hot, F.lit("click")).otherwise(F.col("line"))))
    t0 = time.time()
    matched = nearest_stop(pings, normalize_stops(fx.stops(spark, sf_dir)))
    out = line_delay_summary(nearest_departure(matched, fx.timetable(spark, sf_dir)))
    rows = out.count()
    hot_count = out.agg(F.max("measurement_count")).first()[0]
    took = time.time() - t0
    spark.stop()

    stages = {}
    for f in glob.glob(os.path.join(log_dir, "**", "events*"), recursive=True):
        for line in open(f):
            e = json.loads(line)
            if e.get("Event") != "SparkListenerTaskEnd" or "Task Metrics" not in e:
                continue
            m = e["Task Metrics"]
            rec = (m.get("Input Metrics", {}).get("Records Read", 0)
                   + m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0))
            stages.setdefault(e["Stage ID"], []).append(rec)
    print(f"summary rows {rows}, hottest (dt, hour, line) count {hot_count}, {took:.1f}s")
    print("stage  tasks  records  max-task-share")
    for sid, recs in sorted(stages.items()):
        tot = sum(recs)
        if tot >= 50000 and len(recs) > 1:
            print(f"{sid:5d} {len(recs):6d} {tot:8d}  {max(recs) / tot:.2f}")


if __name__ == "__main__":
    main()
