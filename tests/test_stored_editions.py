"""Stored documents of several generations, broken and missing ones; metrics observed in the job; the floor of successful feeds."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidewire.operators import sinks, viewer
from tidewire.sources import archive, payloads


def write(spark, folder, lines):
    spark.createDataFrame(lines, "edition_id string, value string").write.mode("overwrite").partitionBy("edition_id").text(folder)


def test_generations_and_broken_documents_are_read(spark, tmp_path):
    folder = str(tmp_path)
    write(spark, folder, [
        ("e3", '{"edition": {"id": "e3"}, "articles": [{"id": "a", "title": "New", "importance": 4}, {"id": "b", "headline": "Old", "priority": "9"}]}'),
        ("e2", '{"edition": {"id": "e2"}, "articles": [{"id": "c", "ti'), ("e2", "not json"), ("e2", '{"edition": {"id": "e2"}}'),
        ("e1", '{"edition": {"id": "e1"}, "articles": [], "later": {"field": 1}}'), ("e0", '{"edition": {"id": "e0"}, "articles": [{"id": "z"}]}'),
    ])
    assert archive.stored_ids(spark, folder) == ["e3", "e2", "e1", "e0"]
    documents = archive.read_editions(spark, folder, 3)
    assert {r.edition_id for r in documents.collect()} == {"e1", "e2", "e3"}
    rows = viewer.normalize_articles(archive.article_rows(documents))
    assert {(r.id, r.title, r.importance) for r in rows.collect()} == {("a", "New", 4), ("b", "Old", 5)}
    index = spark.createDataFrame([("e3",), ("e2",), ("e1",), ("missing",)], "edition_id string")
    found = {r.edition_id: (r.articles, r.documents, r.broken) for r in archive.with_documents(index, documents).collect()}
    assert found == {"e3": (2, 1, 0), "e2": (0, 0, 3), "e1": (0, 1, 0), "missing": (0, 0, 0)}


def test_only_the_partitions_of_the_newest_editions_are_read(spark, tmp_path):
    write(spark, str(tmp_path), [(f"e{n:02}", f'{{"edition": {{"id": "e{n:02}"}}, "articles": []}}') for n in range(30)])
    documents = archive.read_editions(spark, str(tmp_path))
    assert documents.select("edition_id").distinct().count() == 12
    assert documents.select(F.input_file_name(), "broken", "articles").distinct().count() == 12


def test_an_empty_folder_has_no_editions(spark, tmp_path):
    (tmp_path / "readme").write_text("nothing")
    assert archive.read_editions(spark, str(tmp_path)).count() == 0


def test_metrics_are_observed_while_rows_are_written(spark, tmp_path):
    rows, seen = sinks.observed(spark.range(7), "rows", n=F.count("*"), most=F.max("id"))
    others, more = sinks.observed(spark.range(3).filter("id > 5"), "others", kept=F.count("*"), last=F.max("id"))
    for n, df in enumerate((rows, others)):
        df.write.parquet(f"{tmp_path}/{n}")
    assert sinks.run_summary(spark, seen, more).first().asDict() == {"n": 7, "most": 6, "kept": 0, "last": None}


@pytest.mark.parametrize(("good", "passes"), [(0, False), (2, False), (3, True), (9, True)])
def test_a_run_under_a_quarter_of_good_feeds_fails_in_the_job(spark, tmp_path, good, passes):
    outcome = spark.createDataFrame([(f"f{n}", n < good) for n in range(9)], "feed_id string, ok boolean")
    rows = payloads.behind_floor(spark.range(5), outcome)
    if passes:
        assert rows.count() == 5
    else:
        with pytest.raises(Exception, match=f"only {good} of 9 feeds succeeded, 3 are needed"):
            rows.write.parquet(f"{tmp_path}/out")
