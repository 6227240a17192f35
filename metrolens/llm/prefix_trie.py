"""The trie of conversation prefixes, built as a burst trie.

Conversations are suffix containers under trie heads. A container with too many turns
bursts: what all its suffixes share becomes a trunk of nodes, and the next turn's id sends
each suffix to a container of its own. A container that is small enough is sorted and swept
into nodes by one task. Sums over subtrees then go up from containers to the trunks above.

A suffix has at most `stretch` turns; a longer conversation goes on under a new head, which
is named by a hash of everything above it. Equal suffixes under one head are one entry with
a count from the start, so copies never fill a container."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metrolens.llm.common import shuffle_tasks, stage

#: Turns of the suffixes that one container holds at most, and turns of a suffix.
CAPACITY = 1 << 13
STRETCH = 1 << 10
#: Conversation ids of a run of this many numbers are joined before they are hashed.
RUN_IDS = 1 << 12
#: Heads that burst are broadcast up to this many rows.
FEW = 10_000
NOTHING = hashlib.sha256(b"").hexdigest()

_NODE = ["depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_SWEPT = ("cid string, parent string, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
          "saved_tokens long, ends_sha256 string")
_SUMS = ["n_children", "n_leaves", "saved_tokens"]


def turns_of(table: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, pos (from 1), tid (a 128-bit hash of role and text, which names the turn), size (code points)
    of every turn, by turn (null first), then by tid.

    The rows are sorted over all tasks by conversation and turn, so that no conversation is
    numbered in one task: each task numbers its own rows, and of a conversation that began
    in an earlier task the rows before are added (one number for each task)."""
    spark = table.sparkSession
    who, said = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = table.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"),
        F.md5(F.concat(F.length(who).cast("string"), F.lit(":"), who, said)).alias("tid"), F.length(said).cast("long").alias("size"))

    def number(batches):
        from pyspark import TaskContext

        part, last, done = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            conv = batch.column(0).to_numpy()
            if not len(conv):
                continue
            begins = np.flatnonzero(np.append(conv[0] != last, conv[1:] != conv[:-1]))
            nth = np.arange(1, len(conv) + 1)
            before = np.zeros(len(conv), np.int64)
            before[begins] = np.diff(np.append(0, begins))
            nth -= np.cumsum(before)
            if not len(begins) or begins[0]:
                nth[:begins[0] if len(begins) else None] += done
            last, done = conv[-1], int(nth[-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nth), *batch.columns[2:], pa.array(np.full(len(conv), part, np.int32))],
                                             names=["conv", "nth", "tid", "size", "part"])

    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("tid")]
    dealt = rows.repartitionByRange(shuffle_tasks(spark), *order).sortWithinPartitions(*order)
    numbered = stage(dealt.mapInArrow(number, "conv long, nth long, tid string, size long, part int"), "turns")
    ledger = numbered.groupBy("part").agg(F.min("conv").alias("first"), F.max(F.struct("conv", "nth")).alias("last")).orderBy("part").collect()
    carried, conv, so_far = [], None, 0  # one row for each task
    for r in ledger:
        begun = so_far if r["first"] == conv else 0
        if begun:
            carried.append((r["part"], r["first"], begun))
        conv, so_far = r["last"]["conv"], r["last"]["nth"] + (begun if r["last"]["conv"] == r["first"] else 0)
    offsets = spark.createDataFrame(carried, "part int, conv long, begun long")
    return (numbered.join(F.broadcast(offsets), ["part", "conv"], "left")
            .select("conv", (F.col("nth") + F.coalesce("begun", F.lit(0))).alias("pos"), "tid", "size"))


def rebuilt_turns(turns: DataFrame, block: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations): conversation c becomes the first h turns of conversation c - c % `block` (all if it
    has fewer, none if there is no such one), then its own turns after its first h; h = crc32(c in decimal) % `heads`.
    conversations has conv and m, the number of its turns then, which may be 0."""
    h = F.crc32(F.col("conv").cast("string")) % heads
    first = (turns.where((F.col("conv") % block == 0) & (F.col("pos") < heads)).groupBy(F.col("conv").alias("base"))
             .agg(F.sort_array(F.collect_list(F.struct("pos", "tid", "size"))).alias("head")))
    convs = (turns.groupBy("conv").agg(F.max("pos").alias("own")).withColumns({"h": h, "base": F.col("conv") - F.col("conv") % block})
             .join(first, "base", "left")
             .withColumn("k", F.least("h", F.coalesce(F.size("head"), F.lit(0)).cast("long")))
             .withColumn("m", F.col("k") + F.greatest(F.col("own") - F.col("h"), F.lit(0))))
    convs = stage(convs.select("conv", "h", "k", "m", F.when(F.col("k") > 0, F.slice("head", F.lit(1), F.col("k").cast("int"))).alias("head")), "conversations")
    front = convs.where("k > 0").select("conv", "m", F.inline("head"))
    own = (turns.join(convs.select("conv", "h", "k", "m"), "conv").where("pos > h")
           .select("conv", "m", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "tid", "size"))
    return front.unionByName(own), convs.select("conv", "m")


def joined_hashes(members: DataFrame) -> DataFrame:
    """(key, ends): SHA-256 of the conv ids of each key, in ascending order, comma-joined.

    Ids of one run of numbers are joined first, in parallel; the pieces of a key are hashed one after the
    other as they come, and are never held together."""
    pieces = members.groupBy("key", F.floor(F.col("conv") / F.lit(float(RUN_IDS))).alias("run")).agg(
        F.array_join(F.sort_array(F.collect_list("conv")), ",").alias("ids"))

    def run(batches):
        last, state = None, None
        for batch in batches:
            out = []
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if key == last:
                    state.update(b"," + ids.encode())
                    continue
                if state is not None:
                    out.append((last, state.hexdigest()))
                last, state = key, hashlib.sha256(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], names=["key", "ends"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last]), pa.array([state.hexdigest()])], names=["key", "ends"])

    return (pieces.repartition(shuffle_tasks(members.sparkSession), "key").sortWithinPartitions("key", "run")
            .select("key", "run", "ids").mapInArrow(run, "key string, ends string"))


def _entries(turns: DataFrame, convs: DataFrame, stretch: int) -> tuple[DataFrame, DataFrame]:
    """(entries, ends of the empty conversations). An entry is a distinct suffix under a head: seg, head, ids, sizes,
    n (conversations), conv (the least), ends (hash of those that end here), nxt (the head under which others go on)."""
    at = F.col("pos") - 1
    made = (turns.groupBy("conv", F.floor(at / stretch).alias("seg"))
            .agg(F.sort_array(F.collect_list(F.struct(at.alias("at"), "tid", "size"))).alias("t"), F.max("m").alias("m"))
            .select("conv", "seg", "m", F.col("t.tid").alias("ids"), F.col("t.size").alias("sizes"))
            .withColumn("digest", F.md5(F.array_join("ids", ""))))
    made = stage(made, "suffixes")
    short = made.where(F.col("m") <= stretch).withColumns({"head": F.lit(""), "nxt": F.lit(None).cast("string")})
    some = made.where(F.col("m") > stretch)
    upto = Window.partitionBy("conv").orderBy("seg")

    def name(window):  # a sum of hashes of the stretches so far, over 128 bits
        sums = [F.sum(F.xxhash64(F.lit(k), "seg", "digest").cast("decimal(38,0)")).over(window).cast("string") for k in (1, 2)]
        return F.concat_ws("_", *sums)

    heads = (some.select("conv", "seg", "m", "digest")
             .withColumns({"head": F.when(F.col("seg") > 0, name(upto.rowsBetween(Window.unboundedPreceding, -1))).otherwise(F.lit("")),
                           "nxt": F.when((F.col("seg") + 1) * stretch < F.col("m"), name(upto.rowsBetween(Window.unboundedPreceding, 0)))})
             .select("conv", "seg", "head", "nxt"))
    whole = short.unionByName(some.join(heads, ["conv", "seg"]))
    key = F.concat_ws("|", "seg", "head", "digest")
    ends = joined_hashes(whole.where("nxt IS NULL").select(key.alias("key"), "conv")
                         .unionByName(convs.where("m = 0").select(F.lit("").alias("key"), "conv")))
    ends = stage(ends, "ends")
    entries = (whole.groupBy("seg", "head", "digest", "ids", "sizes")
               .agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv"), F.max("nxt").alias("nxt"), F.count_if(F.col("nxt").isNull()).alias("n_end"))
               .withColumn("key", F.when(F.col("n_end") > 0, key)).join(ends, "key", "left")
               .select("seg", "head", "ids", "sizes", "n", "conv", "nxt", "ends"))
    return stage(entries, "entries"), ends.where("key = ''").select("ends")


def _burst(rows: DataFrame, capacity: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """(containers that need no bursting, round by round; trunks, round by round). rows: cid, parent, seg, depth, up, ids,
    sizes, n, conv, nxt, ends. A trunk is a container that burst: its shared ids' sizes, its number of conversations, and what
    ends or goes on at its last node."""
    small, trunks = [], []
    while True:
        big = (rows.groupBy("cid").agg(F.sum(F.size("ids") + 1).alias("turns"), F.count(F.lit(1)).alias("k"))
               .where((F.col("turns") > capacity) & (F.col("k") > 1)).select("cid"))
        big = stage(big, "bursting")
        n = big.count()
        if not n:
            return [*small, rows], trunks
        few = F.broadcast(big) if n <= FEW else big
        small.append(rows.join(few, "cid", "left_anti"))
        inside = rows.join(few, "cid")
        ends = inside.groupBy("cid", "parent", "seg", "depth", "up").agg(
            F.min(F.struct("ids", "sizes")).alias("lo"), F.max("ids").alias("hi"), F.sum("n").alias("n"), F.min("conv").alias("conv"))
        same = F.zip_with("lo.ids", "hi", lambda a, b: F.coalesce(a == b, F.lit(False)))
        differ = F.array_position(same, False)
        shared = F.when(differ > 0, differ - 1).otherwise(F.size("lo.ids")).cast("int")
        bounds = stage(ends.withColumn("shared", shared).select(
            "cid", "parent", "seg", "depth", "up", "n", "conv", "shared", F.slice("lo.sizes", F.lit(1), F.col("shared")).alias("sizes")), "trunks")
        b = bounds.select("cid", "shared", F.col("conv").alias("least"))
        cut = inside.join(F.broadcast(b) if n <= FEW else b, "cid")
        here = cut.where(F.size("ids") == F.col("shared")).select("cid", "nxt", "ends")  # one entry of a container at most
        trunks.append(stage(bounds.join(here, "cid", "left"), "trunks"))
        rest = F.col("shared") + 1
        rows = stage(cut.where(F.size("ids") > F.col("shared")).select(
            F.md5(F.concat_ws("|", "cid", F.element_at("ids", rest))).alias("cid"), F.col("cid").alias("parent"), "seg",
            (F.col("depth") + F.col("shared")).alias("depth"), F.when(F.col("shared") > 0, F.col("least")).otherwise(F.col("up")).alias("up"),
            F.slice("ids", rest, F.size("ids")).alias("ids"), F.slice("sizes", rest, F.size("sizes")).alias("sizes"), "n", "conv", "nxt", "ends"), "containers")


def sweep(entries: list[tuple], depth: int, up: int) -> tuple[list[list], tuple[int, int, int]]:
    """(columns of the nodes, (children, leaves, saved) of the head) of one container. entries: (ids, sizes, n, conv, ends, children,
    leaves, saved) sorted by ids; the last three are of what goes on below the entry."""
    above, level, convs, size = [], [], [], []
    n, children, leaves, saved, ends = [], [], [], [], []
    path: list[int] = []  # the open node of each level
    head, last = [0, 0, 0], ()

    def close(upto: int) -> None:
        while len(path) > upto:
            i = path.pop()
            leaves[i] = leaves[i] or 1
            saved[i] += (n[i] - 1) * size[i]
            if path:
                p = path[-1]
                n[p] += n[i]
                convs[p] = min(convs[p], convs[i])
                children[p] += 1
                leaves[p] += leaves[i]
                saved[p] += saved[i]
            else:
                head[0] += 1
                head[1] += leaves[i]
                head[2] += saved[i]

    for ids, sizes, m, conv, end, kids, below, more in entries:
        same = 0
        while same < len(last) and ids[same] == last[same]:
            same += 1
        close(same)
        for j in range(same, len(ids)):
            above.append(path[-1] if path else -1)
            path.append(len(level))
            level.append(depth + j + 1)
            convs.append(conv)
            size.append(sizes[j])
            for column in (n, children, leaves, saved):
                column.append(0)
            ends.append(NOTHING)
        i = path[-1]
        n[i], children[i], leaves[i], saved[i] = m, kids, below, more
        if end is not None:
            ends[i] = end
        last = ids
    close(0)
    parents = [convs[p] if p >= 0 else up for p in above]
    return [level, convs, parents, n, children, leaves, saved, ends], tuple(head)


def _sweep_all(rows: DataFrame) -> DataFrame:
    """The nodes of whole containers, and for each container a row of depth -1 with its sums."""
    types = [pa.string(), pa.string(), *[pa.int64()] * 7, pa.string()]
    names = ["cid", "parent", *_NODE]
    columns = ["cid", "parent", "depth", "up", "ids", "sizes", "n", "conv", "ends", "kids", "below", "more"]

    def run(batches):
        now, held, out = None, [], [[] for _ in names]

        def finish():
            (cid, parent, depth, up), entries = now, held
            cols, sums = sweep(entries, depth, up)
            k = len(cols[0])
            for to, more in zip(out, [[cid] * (k + 1), [parent] * (k + 1), *([*c, x] for c, x in zip(cols, [-1, None, None, None, *sums, None]))]):
                to.extend(more)

        def send():
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)
            for c in out:
                c.clear()
            return batch

        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                for row in zip(*(c.to_pylist() for c in batch.slice(a, 1024).columns)):
                    if now is None or row[0] != now[0]:
                        if now is not None:
                            finish()
                            if len(out[0]) > 20_000:
                                yield send()
                        now, held = row[:4], []
                    held.append(row[4:])
        if now is not None:
            finish()
        yield send()

    return (rows.repartition(shuffle_tasks(rows.sparkSession), "cid").sortWithinPartitions("cid", "ids").select(*columns).mapInArrow(run, _SWEPT))


def _up_the_trunks(trunks: DataFrame, sums: DataFrame, below: DataFrame) -> DataFrame:
    """The nodes of trunks, and their sums (depth -1), from the sums of the containers that hang on them."""
    kids = sums.groupBy(F.col("parent").alias("cid")).agg(*[F.sum(c).alias(c) for c in _SUMS])
    more = below.select(F.col("cid").alias("nxt"), *[F.col(c).alias(f"b_{c}") for c in _SUMS])
    t = trunks.join(kids, "cid").join(more, "nxt", "left")
    t = t.withColumns({c: F.col(c) + F.coalesce(f"b_{c}", F.lit(0)) for c in _SUMS})
    paid = (F.col("n") - 1)

    def left(j):  # code points of the trunk from its node j (from 0) on
        return F.aggregate(F.slice("sizes", j + 1, F.col("shared")), F.lit(0).cast("long"), lambda a, x: a + x)

    chain = (t.where("shared > 0").withColumn("j", F.explode(F.sequence(F.lit(0), F.col("shared") - 1)))
             .select("cid", "parent", (F.col("depth") + F.col("j") + 1).alias("depth"), F.col("conv").alias("conv_id"),
                     F.when(F.col("j") == 0, F.col("up")).otherwise(F.col("conv")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
                     F.when(F.col("j") == F.col("shared") - 1, F.col("n_children")).otherwise(F.lit(1)).cast("long").alias("n_children"), "n_leaves",
                     (F.col("saved_tokens") + paid * left(F.col("j"))).alias("saved_tokens"),
                     F.when(F.col("j") == F.col("shared") - 1, F.col("ends")).alias("ends_sha256")))
    none = F.lit(None).cast("long")
    own = t.select("cid", "parent", F.lit(-1).cast("long").alias("depth"), none.alias("conv_id"), none.alias("parent_conv_id"), none.alias("n_convs"),
                   F.when(F.col("shared") > 0, F.lit(1)).otherwise(F.col("n_children")).cast("long").alias("n_children"), "n_leaves",
                   (F.col("saved_tokens") + paid * left(F.lit(0))).alias("saved_tokens"), F.lit(None).cast("string").alias("ends_sha256"))
    return stage(chain.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING))).unionByName(own), "trunk-nodes")


def prefix_trie(turns: DataFrame, convs: DataFrame, capacity: int = CAPACITY, stretch: int = STRETCH) -> DataFrame:
    """One row for each distinct sequence of first turns, from the empty one (depth 0): conv_id (the least of the
    conversations that begin with it), depth, parent_conv_id (its parent's conv_id), n_convs, n_children, n_leaves
    (nodes without children at it or below), saved_tokens (over it and what is below, a node's conversations but one times the
    code points of its last turn) and ends_sha256 (SHA-256 of the ids of the conversations that end there, ascending, comma-joined).

    turns: conv, pos (from 1, without gaps), tid, size, m (the conversation's turns); convs: conv, m of every conversation,
    those without turns too. No conversations give no rows. Memory of a task is bounded by `capacity` and `stretch` turns."""
    entries, empty = _entries(turns, convs, stretch)
    everything = convs.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    root = everything.first()["conv_id"]
    deepest = entries.agg(F.max("seg")).first()[0] or 0
    cid = F.concat_ws("|", "seg", "head")
    rows = entries.withColumns({"cid": cid, "parent": F.lit(None).cast("string"), "depth": F.col("seg") * stretch, "up": F.lit(root).cast("long"),
                                "nxt": F.when(F.col("nxt").isNotNull(), F.concat_ws("|", F.col("seg") + 1, "nxt"))})
    order = ["cid", "parent", "seg", "depth", "up", "ids", "sizes", "n", "conv", "nxt", "ends"]
    rows = rows.select(*order)
    if deepest:  # the node above a later stretch is the entry that goes on there
        above = rows.where("nxt IS NOT NULL").select(F.col("nxt").alias("cid"), F.col("conv").alias("over"))
        rows = stage(rows.join(above, "cid", "left").withColumn("up", F.coalesce("over", "up")).select(*order), "containers")
    small, trunks = _burst(rows, capacity)
    below = entries.sparkSession.createDataFrame([], "cid string, n_children long, n_leaves long, saved_tokens long")
    nodes = []
    for seg in range(deepest, -1, -1):
        more = below.select(F.col("cid").alias("nxt"), *[F.col(c).alias(x) for c, x in zip(_SUMS, ("kids", "below", "more"))])
        full = None
        for part in small:
            part = part.where(F.col("seg") == seg)
            full = part if full is None else full.unionByName(part)
        full = full.join(more, "nxt", "left").withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("kids", "below", "more")})
        made = [stage(_sweep_all(full), "swept")]
        sums = made[0].where("depth < 0")
        for t in reversed(trunks):
            up = _up_the_trunks(t.where(F.col("seg") == seg), sums, below)
            made.append(up)
            sums = sums.unionByName(up.where("depth < 0"))
        nodes += [x.where("depth >= 0").select(*_NODE) for x in made]
        below = stage(sums.where("parent IS NULL").select("cid", *_SUMS), "below")
    top = everything.where("n_convs > 0").join(below, F.lit(True), "left").join(empty, F.lit(True), "left").select(
        F.lit(0).cast("long").alias("depth"), "conv_id", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"), F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"), F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256"))
    for x in nodes:
        top = top.unionByName(x)
    return top.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def query(conversations: DataFrame) -> DataFrame:
    turns, convs = rebuilt_turns(turns_of(conversations))
    return prefix_trie(turns, convs)


ORACLE = """
WITH turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos,
         {'r': coalesce(role, ''), 't': coalesce(text, '')} AS x
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list(x ORDER BY pos) AS seq FROM turns GROUP BY c),
h AS (
  SELECT c, seq, c - c % 100 AS base,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: ord(s)::BIGINT)),
           lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)::BIGINT[]), lambda v, k: xor(v >> 1, 3988292384::BIGINT * (v & 1)))), 4294967295::BIGINT) % 6 AS h
  FROM own),
rebuilt AS (
  SELECT h.c, list_concat(coalesce(own.seq, [])[1:h.h], h.seq[h.h + 1:]) AS seq FROM h LEFT JOIN own ON own.c = h.base),
prefixes AS (SELECT c, seq, d, seq[1:d] AS p FROM (SELECT c, seq, unnest(range(0, len(seq) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT d, p, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE len(seq) = d), '')) AS ends_sha256
  FROM prefixes GROUP BY d, p),
kids AS (SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
below AS (
  SELECT k AS d, n.p[1:k] AS p, sum((n_convs - 1) * coalesce(length(n.p[n.d].t), 0)) AS saved, count(*) FILTER (WHERE kids.n IS NULL) AS leaves
  FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM nodes) n LEFT JOIN kids ON kids.d = n.d AND kids.p = n.p GROUP BY 1, 2)
SELECT n.conv_id, n.d AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0) AS n_children, below.leaves AS n_leaves,
       CAST(below.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below ON below.d = n.d AND below.p = n.p LEFT JOIN kids ON kids.d = n.d AND kids.p = n.p
LEFT JOIN nodes up ON up.d = n.d - 1 AND up.p = n.p[1:n.d - 1]
"""
