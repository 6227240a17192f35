"""WARC: records read back, revisits, global order by loser tree, odd rows."""

import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from metrolens.llm import warc

SCHEMA = "page_id long, url string, html string, captured string, file string"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(rows, min_bytes=0):
    first = {}
    for i, _, h, *_ in rows:
        if i is not None and len((h or "").encode()) >= min_bytes:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h, *_ in rows:
        f = first.get(h or "")
        revisit = i is not None and f is not None and f < i
        out.append((i, len((h or "").encode()), digest(h), "revisit" if revisit else "response", f if revisit else None))
    return sorted(out, key=str)


def got(df):
    return sorted([tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in df.collect()], key=str)


def pages():
    rng = random.Random(4)
    rows = [(i, f"http://{rng.choice('abc')}.Example.com:80/{rng.randrange(5)}?q={rng.randrange(3)}#f", f"<p>{rng.randrange(40)} é 日</p>\r\n\r\nWARC/1.1\r\n", "x", "y") for i in range(200)]
    rows += [(500 + i, "https://hot.example.org/", "same", None, None) for i in range(80)]
    return rows + [(900, None, None, None, None), (901, "", "", None, None), (902, "not a url\r\nX: y", "z" * 300000, None, None), (903, "http://x", "q", None, None), (903, "http://x", "q", None, None),
                   (None, "http://x/y", "q", None, None)]


def test_records_round_trip(spark):
    rows = pages()
    out = warc.query(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert got(out) == expected(rows)
    assert out.where("NOT intact").count() == 0


def test_small_payloads_are_always_responses(spark, tmpdir_path):
    rows = pages()
    path = f"{tmpdir_path}/w"
    warc.write_archives(spark.createDataFrame(rows, SCHEMA), path, F.timestamp_seconds(F.lit(0)), min_bytes=5)
    assert got(warc.index_runs(spark, path)) == expected(rows, 5)


def test_offsets_lead_to_the_records(spark, tmpdir_path):
    path = f"{tmpdir_path}/w"
    warc.write_archives(spark.createDataFrame(pages(), SCHEMA), path, F.timestamp_seconds(F.col("page_id")), records_per_file=40, compression="none")
    entries = warc.index_runs(spark, path).collect()
    assert len({e["file"] for e in entries}) > 5
    for e in entries[::7]:
        with open(e["file"].removeprefix("file:"), "rb") as f:
            f.seek(e["offset"])
            data = f.read(e["length"])
        (_, _, headers, _), = warc.parse_records(data)
        assert headers["WARC-Payload-Digest"] == "sha1:" + e["payload_digest"]


def test_histories_come_in_global_order(spark):
    runs = warc.query(spark.createDataFrame(pages(), SCHEMA))
    rows = [(r["url_key"], r["captured"], r["page_id"] is not None, r["page_id"] or 0) for r in runs.collect()]
    assert rows == sorted(rows)


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree_merges(k):
    rng = random.Random(k)
    runs = [sorted((rng.randrange(20),) for _ in range(rng.randrange(0, 12))) for _ in range(k)]
    assert list(warc.loser_tree(runs, lambda r: r)) == sorted(x for r in runs for x in r)


def test_url_keys():
    assert warc.url_key("http://WWW.Example.com/a?b#c") == "com,example,www)/a?b"
    assert warc.url_key("https://user@example.com:8080") == "com,example:8080)/"
    assert warc.url_key("no url") == "no url"


def test_empty_table(spark):
    assert warc.query(spark.createDataFrame([], SCHEMA)).count() == 0
