"""The index finds what a scan finds, and reads the buckets of its grams only."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidewire.operators import search_index, viewer


@pytest.fixture(scope="module")
def articles(spark):
    rng = random.Random(4)
    words = ["tide", "wire", "harbour", "ab", "Ａbc", "東京", "港", "x"] + ["".join(rng.choices("abcde", k=rng.randint(1, 6))) for _ in range(40)]
    rows = [(n, " ".join(rng.choices(words, k=rng.randint(0, 12))) if n % 9 else "", "x") for n in range(300)]
    return spark.createDataFrame([*rows, (1000, None, "y"), (1001, "harbour " * 4000, "z")], "id long, title string, number string")


def test_searches_equal_a_scan(spark, articles, tmp_path):
    rows = articles.drop("number")
    index = search_index.build_index(rows, F.col("title"), str(tmp_path), buckets=16, block=32)
    for query in ("tide wire", "harbour", "港", "東京 港", "abc", "a", "", "  ", "zzz", "ab zzz", "tide tid", "ＡＢＣ x", "har bour"):
        want = sorted(r.id for r in viewer.search(rows, query, haystack=F.col("title")).collect())
        got = index.search(query)
        assert sorted(r.id for r in got.collect()) == want, query
        assert got.columns == ["id", "title"]


def test_a_search_reads_few_files_and_lists_are_bounded(spark, articles, tmp_path):
    index = search_index.build_index(articles.drop("number"), F.col("title"), str(tmp_path), buckets=16, block=32)
    every = len(index.postings.inputFiles())
    pruned = index.read(["ti"])
    scanned = pruned._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert "bucket" in scanned.metadata().apply("PartitionFilters")
    assert pruned.select(F.input_file_name()).distinct().count() < every
    assert index.postings.agg(F.max("n")).first()[0] <= 32
    lists = index.postings.select("gram", F.explode(search_index.numbers(F.col("first"), F.col("steps"))).alias("number"))
    held = index.rows.select("number", "haystack")
    wrong = lists.join(held, "number").filter(~F.contains("haystack", F.col("gram")))
    assert wrong.count() == 0


def test_terms_inside_others_are_left_out():
    assert search_index.terms_of("Tide  TI de x") == ["tide", "x"]
