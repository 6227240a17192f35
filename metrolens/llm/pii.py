"""Personal data by bootstrapped contextual extraction.

The base patterns of each kind find seed entities. The words around seeds and around
every other identifier-like string are lexical patterns; patterns and instances form a
graph, and confidence flows from seeds to patterns to instances, round by round. Patterns of
high confidence then add the identifiers in their slots that the base patterns miss.
Everything is DataFrame expressions: each text is read once, in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metrolens.llm.common import stage

KINDS = ("email", "ip", "card", "phone")

#: The base patterns, leftmost and non-overlapping. They match what the plain forms match
#: (in natural order: [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+ ; four numbers with
#: dots ; digits with single spaces or hyphens between them ; + and digits), written without
#: backtracking, so that a long run of one kind of character takes linear time.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
_IP = rf"\A{_PART}(?:\.{_PART}){{3}}\z"
#: An identifier-like string: a token with a digit, @ or (at), and tokens with a digit that follow by single spaces.
_MARK = r"(?:[0-9@]|(?i:\(at\)|\[at\]))"
CANDIDATE = rf"(?<!\S)\S*{_MARK}\S*+(?: \S*[0-9]\S*+)*+"
_OPENING = r"""\A(?:["'<\[{=:]|\((?![0-9]{1,4}\)))*+"""
_CLOSING = r"""[.,;:!?)"'>\]}]*\z"""
#: What an added identifier of each kind looks like.
SHAPES = {
    "email": r"\A[A-Za-z0-9._%+-]{2,64}(?:@|\(at\)|\[at\])[A-Za-z0-9-]{2,64}(?:(?:\.|\(dot\)|\[dot\])[A-Za-z0-9-]{2,64})*\z",
    "ip": r"\A(?:[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?:[:/][0-9]{1,5})?|(?:[0-9A-Fa-f]{0,4}:){3,7}[0-9A-Fa-f]{0,4})\z",
    "card": r"\A[0-9](?:[ -]?[0-9]){12,18}\z",
    "phone": r"\A\(?[0-9](?:[ ().-]{0,2}[0-9]){6,14}\z",
}
#: Runs of tokens that have a kind's shape. Of several from one token on the shortest with the digits of a full
#: number (card 16, phone 10), so that no number after it is taken in, or else the longest; and single tokens.
_RUN_END = r"""(?<![.,;:!?)"'>\]}])(?=[.,;:!?)"'>\]}]*(?:\s|\z))"""
RUNS = [rf"""(?i)(?<![^\s"'<\[\]{{}}=:(),;/|])(?:{r}){_RUN_END}""" for r in (
    SHAPES["email"][2:-2], SHAPES["ip"][2:-2],
    rf"[0-9](?:[ -]?[0-9]){{15,18}}?{_RUN_END}|[0-9](?:[ -]?[0-9]){{12,14}}",
    rf"\(?[0-9](?:[ ().-]{{0,2}}[0-9]){{9,14}}?{_RUN_END}|\(?[0-9](?:[ ().-]{{0,2}}[0-9]){{6,8}}",
    r"[0-9](?:-?[0-9]){12,18}", r"\(?[0-9](?:[().-]{0,2}[0-9]){6,14}")]
CONTEXT = 80  # code points of text on each side that patterns are taken from


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = _digits(value)
    if kind == "ip":
        return F.rlike(value, F.lit(_IP))
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _valid_span(kind: str):
    return lambda s: _valid(kind, s["value"])


def _of_kind(i: int):
    return lambda s: s["kind"] == i


def located(df: DataFrame, text: str, pattern: str, out: str) -> DataFrame:
    """`df` with `out`: the matches of `pattern` as (start, end, value), in code points. The pieces
    between the matches give their places; they are only cut if there is a match."""
    found, gaps = f"_m_{out}", f"_g_{out}"
    empty = F.expr("CAST(array() AS array<struct<start:long,end:long,value:string>>)")
    df = df.withColumn(found, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    df = df.withColumn(gaps, F.when(F.size(found) > 0, F.split(text, pattern, -1)))

    def add(acc: Column, i: Column) -> Column:
        start = acc["at"] + F.length(F.get(gaps, i))
        end = start + F.length(F.get(found, i))
        return F.struct(end.cast("long").alias("at"), F.concat(acc["all"], F.array(F.struct(
            start.cast("long").alias("start"), end.cast("long").alias("end"), F.get(found, i).alias("value")))).alias("all"))

    first = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("all"))
    spans = F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), first, add, lambda acc: acc["all"])
    return df.withColumn(out, F.when(F.size(found) > 0, spans).otherwise(empty)).drop(found, gaps)


def _context(text: str, span: Column) -> Column:
    """The lexical patterns of a span: its two words before, and a word on either side, without case."""
    left = F.substring(F.col(text), F.greatest(F.lit(1), span["start"].cast("int") + 1 - CONTEXT), F.least(F.lit(CONTEXT), span["start"].cast("int")))
    right = F.substring(F.col(text), span["end"].cast("int") + 1, F.lit(CONTEXT))
    before = F.regexp_extract_all(F.lower(left), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    one, two = F.coalesce(F.try_element_at(before, F.lit(-1)), F.lit("^")), F.coalesce(F.try_element_at(before, F.lit(-2)), F.lit("^"))
    after = F.regexp_extract(F.lower(right), r"\A[\x20\x09-\x0D]*([^\x20\x09-\x0D]*)", 1)
    return F.array(F.concat(F.lit("l "), two, F.lit(" "), one), F.concat(F.lit("m "), one, F.lit(" _ "), after))


def _masked(text: str, base: str) -> Column:
    """The text with line feeds in place of the base spans."""
    def add(acc: Column, b: Column) -> Column:
        kept = F.substring(F.col(text), acc["at"] + 1, F.greatest(F.lit(0), b["start"].cast("int") - acc["at"]))
        gap = F.greatest(F.lit(0), b["end"].cast("int") - F.greatest(acc["at"], b["start"].cast("int")))
        return F.struct(F.greatest(acc["at"], b["end"].cast("int")).alias("at"), F.concat(acc["out"], kept, F.repeat(F.lit("\n"), gap)).alias("out"))

    spans = F.array_sort(F.transform(base, lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"))))
    masked = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), add,
                         lambda acc: F.concat(acc["out"], F.substring(F.col(text), acc["at"] + 1, F.length(text))))
    return F.when(F.size(base) > 0, masked).otherwise(F.col(text))


def find_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` without the text, with `base` (kind index, start, end, value, patterns of every valid
    match of the base patterns) and `others` (the same for identifier-like strings, or their
    parts, that overlap none; kind index null). `others` may overlap each other."""
    df = docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    for kind in KINDS:
        df = located(df, "_text", BASE[kind], f"_{kind}")
        df = df.withColumn(f"_{kind}", F.filter(f"_{kind}", _valid_span(kind)))

    def instance(kind: int | None):
        return lambda s: F.struct(F.lit(kind).cast("int").alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                                  s["value"].alias("value"), _context("_text", s).alias("patterns"))

    def trimmed(s: Column) -> Column:
        value = F.regexp_replace(s["value"], _OPENING, "")
        start = s["start"] + F.length(s["value"]) - F.length(value)
        core = F.regexp_replace(value, _CLOSING, "")
        return F.struct(start.alias("start"), (start + F.length(core)).alias("end"), core.alias("value"))

    base = F.concat(*[F.transform(f"_{k}", instance(i)) for i, k in enumerate(KINDS)])
    df = df.withColumn("base", base)
    df = df.withColumn("_masked", _masked("_text", "base"))
    df = located(df, "_masked", CANDIDATE, "_candidates")
    for i, pattern in enumerate(RUNS):
        df = located(df, "_masked", pattern, f"_run{i}")
    df = df.withColumn("_runs", F.array_distinct(F.concat(*[f"_run{i}" for i in range(len(RUNS))])))
    rest = F.filter(F.transform("_candidates", trimmed), lambda s: (s["end"] > s["start"]) & ~F.exists(
        "_runs", lambda r: (r["start"] < s["end"]) & (r["end"] > s["start"])))
    return df.withColumn("others", F.transform(F.concat("_runs", rest), instance(None))).drop(
        text, "_text", "_masked", "_candidates", "_runs", *[f"_run{i}" for i in range(len(RUNS))], *[f"_{k}" for k in KINDS])


def score_patterns(instances: DataFrame, rounds: int = 3, support: int = 3, threshold: float = 0.8) -> DataFrame:
    """(pattern, kind) of high confidence. instances: (kind, value, patterns).

    The graph's edges are the different (pattern, value) pairs. A seed value has confidence
    1 in its kind. A pattern's score for a kind is the confidence its values have, over
    their number and one; it counts from `support` values on. A value that is not a
    seed and has a kind's shape gets the noisy-or of its patterns' scores. Scores are
    recomputed `rounds` times; each round is written to the shared folder."""
    edges = stage(instances.select(F.explode("patterns").alias("pattern"), F.lower("value").alias("value"), "kind")
                           .groupBy("pattern", "value").agg(F.max("kind").alias("kind")), "edges")
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    sure = edges.where(F.col("kind").isNotNull()).select("pattern", "value", "kind", F.lit(1.0).alias("confidence"))
    shaped = edges.where(F.col("kind").isNull()).select("pattern", "value", F.explode(F.array(*[
        F.struct(F.lit(i).alias("kind"), F.rlike("value", F.lit("(?i)" + SHAPES[k])).alias("fits")) for i, k in enumerate(KINDS)])).alias("as"))
    shaped = stage(shaped.where("as.fits").select("pattern", "value", "as.kind"), "shaped")
    told = sure
    for _ in range(rounds):
        scores = stage(told.groupBy("pattern", "kind").agg(F.sum("confidence").alias("sum")).where(F.col("sum") >= support)
                           .join(sizes, "pattern").select("pattern", "kind", (F.col("sum") / (F.col("n") + 1)).alias("score")), "scores")
        guessed = (shaped.join(scores, ["pattern", "kind"]).groupBy("value", "kind")
                         .agg((1 - F.exp(F.sum(F.log1p(-F.col("score"))))).alias("confidence")))
        told = sure.unionByName(shaped.join(guessed, ["value", "kind"]).select("pattern", "value", "kind", "confidence"))
    return scores.where(F.col("score") >= threshold).select("pattern", "kind")


def extract(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rounds: int = 3, support: int = 3, threshold: float = 0.8) -> DataFrame:
    """A row per row of `docs`: doc_id, base (array of kind index, start, end in code points) and added
    (the same, found by context). Kinds by index: email, ip, card, phone.

    Null text counts as empty and has no spans; whole texts are read; rows that repeat come
    back as often, with equal spans. Without seeds nothing is added. Added spans overlap no
    base span and no other added span: of those that do, the one that begins first stays. An empty table gives an empty result; other columns play no part."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("row"))
    found = stage(find_spans(rows), "spans")
    instances = found.select("row", F.explode(F.concat("base", "others")).alias("i")).select("row", "i.*")
    strong = score_patterns(instances, rounds, support, threshold)
    open_ = instances.where(F.col("kind").isNull()).select("row", "start", "end", "value", F.explode("patterns").alias("pattern"))
    fits = F.coalesce(*[F.when(F.col("as") == i, F.rlike("value", F.lit("(?i)" + SHAPES[k]))) for i, k in enumerate(KINDS)])
    added = (open_.join(strong.withColumnRenamed("kind", "as"), "pattern").where(fits)
                  .groupBy("row", "start", "end").agg(F.min("as").alias("kind"))
                  .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("added")))
    none = F.expr("CAST(array() AS array<struct<kind:int,start:long,end:long>>)")

    def apart(acc: Column, s: Column) -> Column:
        last = F.coalesce(F.try_element_at(acc, F.lit(-1))["end"], F.lit(0))
        return F.when(s["start"] >= last, F.concat(acc, F.array(F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))).otherwise(acc)

    added = added.withColumn("added", F.aggregate("added", none, apart))
    return found.join(added, "row", "left").select(
        F.col("doc_id").alias(doc_id), F.transform("base", lambda b: F.struct(b["kind"].alias("kind"), b["start"].alias("start"), b["end"].alias("end"))).alias("base"),
        F.coalesce("added", none).alias("added"))


def span_text(spans: Column) -> Column:
    """kind:start:end of all spans by kind, then start, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def query(docs: DataFrame) -> DataFrame:
    found = extract(docs)
    counts = [F.size(F.filter("base", _of_kind(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        span_text(F.concat("base", "added")).alias("spans"))
