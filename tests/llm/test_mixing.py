"""Mixing: targets by water-filling, exact budgets, epochs, hot source, odd rows."""

import pytest
from pyspark.sql import functions as F

from metrolens.llm import mixing
from metrolens.llm.common import prefix_sums

SCHEMA = "doc_id long, text string, source string, target string"


def level_targets(sizes, weights, cap=3.0):
    """Share the total by weight again and again until no target is above its limit."""
    total, full = sum(sizes), set()
    while True:
        left = total - sum(cap * sizes[i] for i in full)
        weight = sum(w for i, w in enumerate(weights) if i not in full)
        share = [cap * s if i in full else left * w / weight for i, (s, w) in enumerate(zip(sizes, weights))]
        over = {i for i in range(len(sizes)) if i not in full and share[i] > cap * sizes[i]}
        if not over:
            return share
        full |= over


@pytest.mark.parametrize("sizes", [[100, 100, 100], [1, 1000, 5], [10, 0, 3, 500, 7, 7, 2000], [5]])
def test_targets(spark, sizes):
    weights = [1 + i % 3 for i in range(len(sizes))]
    df = spark.createDataFrame([(str(i), w, s) for i, (w, s) in enumerate(zip(weights, sizes))], "source string, weight int, source_size long")
    got = [r["target"] for r in mixing.targets(df, sum(sizes)).orderBy("source").collect()]
    assert got == pytest.approx(level_targets(sizes, weights))
    assert sum(got) == pytest.approx(sum(sizes))


def rows():
    out = [(i, "w " * (i % 7), "hot", "t") for i in range(300)]
    out += [(1000 + i, " ".join(f"a{j}" for j in range(i % 5)), f"s{i % 4}", None) for i in range(100)]
    return out + [(5000, None, None, None), (5001, "a b\tc\x0bd\x1ce", None, None), (None, "null id", "s1", None), (5002, "dup row", "s2", None), (5002, "dup row", "s2", None),
                  (5003, "long " * 50000, "s3", None)]


def test_budgets_are_met_and_reruns_agree(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    a = mixing.mix(df).toPandas()
    b = mixing.mix(df.repartition(7)).toPandas()
    assert len(a) == len(rows())
    key = ["key", "key2", "taken"]
    assert a[key].sort_values(key).values.tolist() == b[key].sort_values(key).values.tolist()
    assert (a.taken <= 3 * a["size"]).all() and (a.taken >= 0).all()
    for _, g in a.groupby(a.source.fillna("~")):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 0.51
        assert g.source_size.iloc[0] == g["size"].sum()
    assert a[a.doc_id == 5001]["size"].tolist() == [4]


def test_mixed_documents_carry_the_words_taken(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    plan = mixing.mix(df).groupBy("source").agg(F.sum("taken").alias("taken"))
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    words = out.groupBy("source").agg(F.sum(mixing.words("text")).alias("words"))
    both = plan.join(words, plan.source.eqNullSafe(words.source), "left").collect()
    assert all((r["words"] or 0) == r["taken"] for r in both)


def test_prefix_sums_match_a_running_sum(spark):
    df = spark.range(2000).select(F.xxhash64("id").alias("key"), "id", (F.col("id") % 5).alias("v"), (F.col("id") % 3 == 0).alias("g"))
    out = prefix_sums(df, ["g"], "key", [F.col("id")], "v", "before", "total", rows_per_slice=50).toPandas()
    out["u"] = out.key.astype("uint64")
    for _, g in out.groupby("g"):
        g = g.sort_values("u")
        assert (g.before == g.v.cumsum() - g.v).all() and (g.total == g.v.sum()).all()


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(df).count() == 0 and mixing.mixed_documents(df).count() == 0


def test_taken_equals_brute_force(spark):
    """Whole epochs and a cut, walked through document by document in the order of the keys."""
    docs = [r for r in rows() if r[0] != 5002]
    got = mixing.mix(spark.createDataFrame(docs, SCHEMA).repartition(7)).collect()
    for source in {r["source"] for r in got}:
        mine = sorted((r for r in got if r["source"] == source), key=lambda r: (r["key"] % 2 ** 64, r["key2"]))
        total = sum(r["size"] for r in mine)
        assert {r["source_size"] for r in mine} == {total}
        left = round(mine[0]["target"])
        taken = [0] * len(mine)
        while left and total:
            for i, r in enumerate(mine):
                some = min(left, r["size"])
                taken[i] += some
                left -= some
        assert [r["taken"] for r in mine] == taken
