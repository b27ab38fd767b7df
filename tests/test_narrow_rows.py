"""Context and drafts carry the columns that are read, and whole texts join few rows late."""

from pyspark.sql import functions as F

from tidewire.functions.profiles import LATIN
from tidewire.operators import clusters, drafts
from tidewire.operators.dedup import first_per_key
from tidewire.operators.windows import rolling_context
from tidewire.plans import edition_run
from tidewire.session import cut_lineage
from tidewire.sources import tables

SMALL = "/root/testdata/sf0.001"


def plain_context(candidates, fresh, archive, limit):
    """The context with whole rows all the way."""
    rows = rolling_context(candidates.drop("edition_id")).select(*edition_run.EVIDENCE)
    rows = rows.join(fresh.select("edition_id", "url").distinct(), ["edition_id", "url"], "left_anti").withColumn("side", F.lit(0))
    rows = rows.unionByName(archive.select(*edition_run.EVIDENCE).withColumn("side", F.lit(1)))
    best = first_per_key(rows, ["edition_id", "url"], (F.desc(F.length("description")), F.col("side"), F.col("ord")))
    return first_per_key(best, ["edition_id"], (F.col("side"), F.col("ord")), limit).drop("side")


def test_context_joins_texts_to_the_rows_it_keeps(spark):
    rows = tables.with_edition(tables.candidates(spark, SMALL)).withColumn("url", F.concat(F.lit("u"), F.col("ord") % 150))
    fresh = rows.filter("ord % 3 = 0")
    editions = rolling_context(rows.drop("edition_id")).select("edition_id").distinct()
    old = rows.filter("ord < 40").drop("edition_id").withColumns({"url": F.concat(F.lit("u"), F.col("ord") * 5), "description": F.concat("description", F.lit(" old"))})
    archive = cut_lineage(old.crossJoin(editions))
    for limit in (5, 100):
        got = edition_run.context_for(rows, fresh, archive, limit)
        assert "Generate" not in got._jdf.queryExecution().optimizedPlan().toString()
        wanted = plain_context(rows, fresh, archive, limit).collect()
        rows_of = [sorted((tuple(r[c] for c in edition_run.EVIDENCE) for r in part), key=repr) for part in (got.collect(), wanted)]
        assert rows_of[0] == rows_of[1]
    assert any(r["description"].endswith(" old") for r in wanted)


def test_drafts_read_the_columns_they_name(spark):
    rows = tables.with_edition(tables.candidates(spark, SMALL))
    pool = edition_run.edition_pool(rows, edition_run.context_for(rows, rows), LATIN)[1]
    narrow = pool.select("lead_order", *drafts.DRAFTED_FROM)
    assert not {"description", "safe_description", "classified", "wide_description"} & set(narrow.columns)
    events = clusters.cluster_rows(clusters.feature_clusters(narrow), drafts.EDITED, drafts.FEATURE_FIELDS)
    whole = clusters.cluster_rows(clusters.feature_clusters(pool), drafts.EDITED)
    shown = lambda df: sorted(map(repr, drafts.feature_drafts(df, LATIN).collect()))
    assert shown(events) == shown(whole) != []
