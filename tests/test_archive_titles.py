"""Key points of stored articles that repeat the title."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire.functions.profiles import LATIN
from tidewire.sources import archive


def test_a_title_without_kept_letters_is_still_its_own_repeat(spark):
    rows = spark.createDataFrame([("Üß", ["Üß", "point src0"]), ("Plain title", ["Plain title", "point src1"])], "title string, points array<string>")
    found = archive.unlike_title(rows, "points", "points", "title")
    assert sorted(r.points for r in found.collect()) == [["point src0"], ["point src1"]]


def test_context_has_no_title_among_its_points(spark):
    article = """named_struct('title', 'Üß', 'category', '国内', 'importance', 4, 'sourceCount', 1, 'facts', cast(null as array<string>), 'impactPoints', cast(null as array<string>),
        'watchPoints', cast(null as array<string>), 'background', '', 'publishedAt', '2024-01-25T10:40:00+09:00', 'sources', array(named_struct('name', 's', 'publisherId', 's', 'url',
        cast(null as string), 'links', array(named_struct('title', 'Üß', 'url', 'https://s.example.org/1', 'publishedAt', '2024-01-25T10:40:00+09:00', 'isContinuation', false,
        'originEditionId', '')), 'publishedAt', cast(null as string), 'keyPoints', array('Üß', 'point s'), 'type', '', 'isPrimary', false)))"""
    editions = spark.range(1).select(F.expr("named_struct('id', 'e')").alias("edition"), F.array(F.expr(article)).alias("articles"))
    assert [r.description for r in archive.archive_context(editions, LATIN).collect()] == ["point s"]
