"""The blocked joins find exactly what comparing every pair finds."""

import random

import pytest
from pyspark.sql import functions as F

from tidewire.functions.text import likeness
from tidewire.operators import similarity

RNG = random.Random(7)


def variants(n: int) -> list[str]:
    base = ["".join(RNG.choices("abcdeあいう", k=RNG.randint(1, 30))) for _ in range(n)]
    out = set(base)
    for title in base:
        chars = list(title)
        for _ in range(RNG.randint(1, 3)):
            chars[RNG.randrange(len(chars))] = RNG.choice("abcdeあいう")
        out.add("".join(chars))
        out.add(title[: max(1, len(title) - 2)])
    return sorted(out)


@pytest.mark.parametrize("threshold", [0.72, 0.78, 0.86])
def test_similar_pairs_equal_brute_force(spark, threshold):
    titles = variants(40)
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    pairs = similarity.similar_pairs(df.withColumnRenamed("t", "a"), df.withColumnRenamed("t", "b"), "a", "b", threshold)
    got = {(r["a"], r["b"]) for r in pairs.collect()}
    assert got == {(a, b) for a in titles for b in titles if likeness(a, b) >= threshold}


def test_jaccard_pairs_equal_brute_force(spark):
    titles = variants(40)

    def grams(s):
        return {s[i:i + 2] for i in range(max(1, len(s) - 1))}

    df = spark.createDataFrame([(t,) for t in titles], "t string")
    got = {(r["left_title"], r["right_title"]) for r in similarity.jaccard_pairs(df, "t", 0.5).collect()}
    assert got == {
        (a, b) for a in titles for b in titles if a < b and len(grams(a) & grams(b)) / len(grams(a) | grams(b)) >= 0.5
    }


def test_no_nested_loop_join(spark):
    df = spark.createDataFrame([("abc",)], "t string")
    plan = similarity.similar_pairs(df.withColumnRenamed("t", "a"), df.withColumnRenamed("t", "b"), "a", "b", 0.8)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_pairs_do_not_depend_on_the_table_of_frequent_bigrams_or_on_blocks(spark, monkeypatch):
    titles = variants(40)
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    want = {(a, b) for a in titles for b in titles if likeness(a, b) >= 0.78}
    blocks = similarity.in_blocks
    for most, block in ((0, 3), (7, 1)):
        monkeypatch.setattr(similarity, "frequent_bigrams", lambda rows, title, most=most: dict(list({"ab": 9, "de": 4, "あい": 30, "cc": 1}.items())[:most]))
        monkeypatch.setattr(similarity, "in_blocks", lambda a, b, keys, block=block: blocks(a, b, keys, block))
        pairs = similarity.similar_pairs(df.withColumnRenamed("t", "a"), df.withColumnRenamed("t", "b"), "a", "b", 0.78)
        assert {(r["a"], r["b"]) for r in pairs.collect()} == want


def test_a_bigram_in_half_the_titles_is_split(spark):
    block = 50
    rows = spark.range(2000).select(F.when(F.col("id") % 2 == 0, "szz").otherwise(F.concat(F.lit("s"), F.col("id"))).alias("token"), F.col("id").alias("l__row"))
    other = rows.withColumnRenamed("l__row", "r__row").filter("r__row % 3 = 0")
    a, b = similarity.in_blocks(rows, other, ["token"], block)
    keys = ["token", "a_block", "b_block"]
    assert max(side.groupBy(*keys).count().agg(F.max("count")).first()[0] for side in (a, b)) <= 2 * block
    met = a.join(b, keys).select("l__row", "r__row")
    assert met.count() == met.distinct().count() == rows.join(other, "token").count()


def test_frequent_bigrams_are_counted_once_a_title(spark):
    df = spark.createDataFrame([("abab",), ("abc",), ("x",), ("bc",)], "t string")
    assert similarity.frequent_bigrams(df, "t") == {"ab": 2, "bc": 2, "ba": 1, "x": 1}
    assert similarity.frequent_bigrams(df, "t", 1) == {"ab": 2}
