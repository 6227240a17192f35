"""WARC archives with revisit records, and capture histories by external index merge.

Pages are written as WARC/1.1 records through Spark's writer, equal payloads once. Reading
the archives back gives index runs, each sorted by URL key and time; a k-way loser tree
merges the runs of each key range, so captures come out in global order."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolens.llm.common import shuffle_tasks, stage
from metrolens.session import staging_path

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Fixed values of the WARC/1.1 standard.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"


def base32(hex_digest: Column) -> Column:
    """A 40-digit hex digest as 32 base32 characters."""
    parts = []
    for i in range(4):
        number = F.conv(F.substring(hex_digest, 10 * i + 1, 10), 16, 10).cast("long")
        parts += [F.substring(F.lit(BASE32), F.shiftright(number, 5 * j).bitwiseAND(F.lit(31)).cast("int") + 1, F.lit(1)) for j in range(7, -1, -1)]
    return F.concat(*parts)


def _record(kind: Column, refers_to: Column) -> Column:
    """The record of a page as text, from its columns page_id, url, captured, digest and html."""
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length("html"), F.lit(END))
    body = F.concat(http, F.when(kind == "response", F.col("html")).otherwise(F.lit("")))
    revisit = F.concat(F.lit(f"WARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: <urn:page:"), refers_to.cast("string"), F.lit(">\r\n"))
    return F.concat(
        F.lit(f"{VERSION}\r\nWARC-Type: "), kind, F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Date: "), F.coalesce(F.date_format("captured", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("1970-01-01T00:00:00Z")),
        F.lit("\r\nWARC-Target-URI: "), F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), "[\\r\\n]", "%0A"),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(kind == "response", F.lit("\r\n")).otherwise(F.concat(F.lit("\r\n"), revisit)),
        F.lit("Content-Length: "), F.octet_length(body), F.lit(END), body)


def write_archives(pages: DataFrame, path: str, captured: Column, page_id: str = "page_id", url: str = "url", html: str = "html",
                   min_bytes: int = 0, records_per_file: int = 4096, compression: str = "gzip") -> None:
    """Write a record per row of `pages` to archives under `path`. Of rows with equal payloads
    of at least `min_bytes` bytes the one with the smallest page_id is the response and
    the others are revisits of it.

    `compression` is that of a whole archive; with "none" the offsets of the index are
    places in the file, else in what it decompresses to. Null html is an empty payload,
    a null capture time is the start of 1970. Rows without an id are responses; rows that repeat the
    response's id are responses too. Copies are counted together before they are
    shuffled. An empty table gives archives without records; other columns play no part."""
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), captured.alias("captured"),
                        body.alias("html"), F.sha1(body.cast("binary")).alias("sha1"))
    marks = stage(rows.select("page_id", "sha1", F.octet_length("html").alias("bytes")), "digests")
    firsts = (marks.where((F.col("bytes") >= min_bytes) & F.col("page_id").isNotNull()).groupBy(F.col("sha1").alias("_sha1"))
                   .agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).where(F.col("first") < F.col("last")))
    revisits = (marks.where(F.col("bytes") >= min_bytes).join(firsts, F.col("sha1") == F.col("_sha1")).where(F.col("page_id") > F.col("first"))
                     .select(F.col("page_id").alias("_id"), "_sha1", "first").distinct())
    joined = rows.join(revisits, (F.col("page_id") == F.col("_id")) & (F.col("sha1") == F.col("_sha1")), "left")
    kind = F.when(F.col("first").isNull(), F.lit("response")).otherwise(F.lit("revisit"))
    text = joined.withColumn("digest", base32(F.col("sha1"))).select(_record(kind, F.col("first")).alias("value"))
    # a record ends with two line ends, which is what the writer puts after every row
    text.write.option("lineSep", END).option("maxRecordsPerFile", records_per_file).option("compression", compression).text(path)


def parse_records(data: bytes) -> Iterator[tuple[int, int, dict, bytes]]:
    """(offset, length, headers, block) of the records of an archive, by their Content-Length."""
    at = 0
    while at < len(data):
        end = data.index(END.encode(), at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if lines[0] != VERSION:
            raise ValueError(f"no record at byte {at}")
        headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        start = end + len(END)
        stop = start + int(headers["Content-Length"])
        yield at, stop + len(END) - at, headers, data[start:stop]
        at = stop + len(END)


def url_key(url: str) -> str:
    """The sort key of a URL: host labels from the top, then the path, without scheme and case of the host."""
    m = re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)([^#]*)", url)
    if not m:
        return url
    host = m[1].rpartition("@")[2].lower()
    name, _, port = host.partition(":")
    return ",".join(reversed(name.split("."))) + (f":{port}" if port else "") + ")" + (m[2] or "/")


INDEX = ("run long, url_key string, captured string, page_id long, file string, offset long, length long, record_type string, "
         "payload_bytes long, payload_digest string, refers_to long, intact boolean")


def index_runs(spark: SparkSession, path: str) -> DataFrame:
    """The index of the archives under `path`: a sorted run for each task that reads them.
    intact: a response's payload has the length and digest that its headers state."""
    from pyspark import TaskContext

    names = [c.split()[0] for c in INDEX.split(", ")]

    def page(urn: str | None):
        digits = re.fullmatch(r"<urn:page:(-?[0-9]+)>", urn or "")
        return int(digits[1]) if digits else None

    def entries(name: str, data: bytes):
        for offset, length, headers, block in parse_records(data):
            http, _, payload = block.partition(END.encode())
            size = int(re.search(rb"Content-Length: ([0-9]+)", http)[1])
            digest, kind = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"]
            intact = kind != "response" or (len(payload) == size and base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest)
            yield (url_key(headers["WARC-Target-URI"]), headers["WARC-Date"], page(headers["WARC-Record-ID"]), name, offset, length,
                   kind, size, digest, page(headers.get("WARC-Refers-To")), intact)

    def run(batches):
        task, rows = TaskContext.get().partitionId(), []
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = data.as_py()
                rows += entries(name, gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data)
        rows.sort(key=_order)
        for i in range(0, len(rows), 8192):
            cols = [[task] * len(rows[i:i + 8192]), *zip(*rows[i:i + 8192])]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES)], names=names)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, INDEX)


_TYPES = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(),
          pa.int64(), pa.bool_()]


def _order(row: tuple) -> tuple:
    """URL key, time, page id (none first), file, offset."""
    return row[0], row[1], row[2] is not None, row[2] or 0, row[3], row[4]


def loser_tree(runs: list[list[tuple]], key) -> Iterator[tuple]:
    """Merge sorted runs: each inner node holds the loser of its match, so the next row costs one match per level."""
    k = len(runs)
    ends = (1,)  # sorts behind every (0, key)
    at = [0] * k
    head = [(0, key(r[0])) if r else ends for r in runs]
    tree = [-1] * max(1, k)

    def play(leaf: int) -> int:
        winner, node = leaf, (leaf + k) // 2
        while node:
            if tree[node] < 0:
                tree[node] = winner
                return -1
            if (head[tree[node]], tree[node]) < (head[winner], winner):
                tree[node], winner = winner, tree[node]
            node //= 2
        return winner

    winner = 0
    for leaf in range(k):
        winner = play(leaf) if k > 1 else 0
    while k and head[winner] != ends:
        run = runs[winner]
        yield run[at[winner]]
        at[winner] += 1
        head[winner] = (0, key(run[at[winner]])) if at[winner] < len(run) else ends
        winner = play(winner) if k > 1 else 0


def merge_runs(runs: DataFrame) -> DataFrame:
    """`runs`(INDEX) in global order of URL key, time and page id: partitions are key ranges in
    order, and each merges its slices of all runs. A URL with many captures is spread
    over ranges by time and page id."""
    names = runs.columns
    ranges = runs.repartitionByRange(shuffle_tasks(runs.sparkSession), "url_key", "captured", F.col("page_id").asc_nulls_first(), "file", "offset")

    def run(batches):
        slices: dict[int, list] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                slices.setdefault(row[0], []).append(row[1:])
        for part in slices.values():
            part.sort(key=_order)  # rows of a run arrive in pieces; sorted ones cost one pass
        out: list = []
        for row in loser_tree(list(slices.values()), _order):
            out.append(row)
            if len(out) == 8192:
                yield _batch(out, names[1:])
                out = []
        if out:
            yield _batch(out, names[1:])

    return ranges.mapInArrow(run, INDEX.partition(", ")[2])


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES[1:])], names=names)


def query(pages: DataFrame) -> DataFrame:
    """A row per page, from the archives. `pages` has no capture times: page n counts as captured n seconds into 2024."""
    spark, path = pages.sparkSession, staging_path(pages.sparkSession, "warc")
    captured = F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(31622400)))
    write_archives(pages, path, captured)
    merged = merge_runs(stage(index_runs(spark, path), "runs"))
    return merged.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "offset", "length", "intact")
