"""From candidates to gated editions: many editions in one pass, or a catch-up that folds over windows."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewire.functions import slots
from tidewire.functions.profiles import CATCHUP_LIMIT, CONTEXT_LIMIT, JAPANESE, MAX_CANDIDATES, Profile
from tidewire.operators import articles as art
from tidewire.operators import gates
from tidewire.operators.clusters import described, lead_ordered
from tidewire.operators.dedup import filter_seen, first_per_key, forget_edition, merge_evidence, prune_stories, remember
from tidewire.operators.drafts import DRAFTED_FROM, build_drafts, edited
from tidewire.operators.selection import limit_candidates
from tidewire.operators.windows import assign_windows, missing_windows, rolling_context
from tidewire.plans import publication
from tidewire.session import cut_lineage
from tidewire.sources.state import commit_state, load_state

EVIDENCE = (
    "edition_id id title description url source_name publisher_id category published_at priority primary_source "
    "context_only origin_edition_id ord"
).split()
TEXTS = ["title", "description"]


class GateFailure(RuntimeError):
    """An edition broke a quality gate; nothing was published."""


def context_for(candidates: DataFrame, fresh: DataFrame, archive: DataFrame | None = None, limit: int = CONTEXT_LIMIT) -> DataFrame:
    """Up to 24 context rows per edition: the previous 24 hours of candidates, then the archive, without fresh URLs."""
    narrow = candidates.withColumn("__chars", F.length("description")).drop("edition_id", *TEXTS)
    earlier = rolling_context(narrow).join(fresh.select("edition_id", "url").distinct(), ["edition_id", "url"], "left_anti")
    rows = earlier.select("__chars", F.lit(0).alias("__side"), *[c for c in EVIDENCE if c not in TEXTS])
    if archive is not None:
        rows = rows.unionByName(archive.select(F.length("description").alias("__chars"), F.lit(1).alias("__side"), *[c for c in EVIDENCE if c not in TEXTS]))
    # the first row seen of a URL gives its place, the one with the longer text gives its content
    best = first_per_key(rows, ["edition_id", "url"], (F.desc("__chars"), F.col("__side"), F.col("ord")))
    kept = cut_lineage(first_per_key(best, ["edition_id"], (F.col("__side"), F.col("ord")), limit).drop("__chars"))
    # a candidate is context of up to four editions: its texts join the few rows that were kept, not all of them
    own = ["url", "ord", "published_at"]
    found = kept.filter("__side = 0").join(candidates.select(*own, *TEXTS), own).select(*EVIDENCE)
    if archive is None:
        return found
    own = ["edition_id", "url", "ord"]
    return found.unionByName(kept.filter("__side = 1").join(archive.select(*own, *TEXTS), own).select(*EVIDENCE))


def edition_pool(fresh: DataFrame, context: DataFrame, profile: Profile = JAPANESE) -> tuple[DataFrame, DataFrame]:
    """Limited, described and edited rows: (fresh, fresh with context up to 24), each with `pos` and `lead_order`."""
    chosen = limit_candidates(fresh, profile)
    extra = limit_candidates(context, profile).join(chosen.select("edition_id", "url"), ["edition_id", "url"], "left_anti")
    counted = chosen.groupBy("edition_id").agg(F.count("*").cast("int").alias("__n"))
    extra = extra.withColumn("pos", (F.col("pos") + MAX_CANDIDATES).cast("int")).join(counted, "edition_id", "left")
    room = MAX_CANDIDATES - F.coalesce("__n", F.lit(0))
    extra = extra.withColumn("__k", F.row_number().over(_by_edition("pos"))).filter(F.col("__k") <= room).drop("__k", "__n")
    # written before the long chain of text steps, which is then planned over a plain scan
    pool = cut_lineage(chosen.unionByName(extra, allowMissingColumns=True))
    rows = edited(described(pool, profile, None), profile)
    return lead_ordered(rows.filter(F.col("pos") < MAX_CANDIDATES)), lead_ordered(rows)


def _by_edition(order: str):
    return Window.partitionBy("edition_id").orderBy(order)


def edition_articles(
    fresh: DataFrame, context: DataFrame, generated_at: Column, profile: Profile = JAPANESE
) -> DataFrame:
    """Articles of every edition in `fresh` (candidates with `edition_id`), in one pass over all editions.

    The limited pool (at most 48 rows per edition) feeds several joins, so it is checkpointed once instead of
    being worked out again for each of them.
    """
    context = cut_lineage(context)  # at most 24 rows per edition, read three times below
    pool = cut_lineage(edition_pool(fresh, context, profile)[1].select("lead_order", *DRAFTED_FROM))
    own = lead_ordered(pool.filter(F.col("pos") < MAX_CANDIDATES).drop("lead_order"))
    drafts = cut_lineage(build_drafts(own, pool, profile))
    # only the URLs the drafts cite have to be merged
    cited = drafts.select("edition_id", F.explode("candidate_ids").alias("id")).join(pool.select("edition_id", "id", "url"), ["edition_id", "id"])
    cited = cited.select("edition_id", "url").distinct()
    sides = [side.select(*EVIDENCE).join(cited, ["edition_id", "url"], "left_semi") for side in (fresh, context)]
    evidence = cut_lineage(merge_evidence(*sides, ("edition_id", "url")))  # read for sources and for measures
    return art.build_articles(drafts, evidence, generated_at, profile)


def violations(articles: DataFrame, edition_ids: DataFrame, profile: Profile = JAPANESE) -> DataFrame:
    return gates.source_mix_violations(articles, edition_ids).unionByName(gates.feature_violations(articles, profile))


@dataclass
class CatchUp:
    """Publish every missing window in order; nothing is visible until all of them pass the gates and the audit."""

    spark: SparkSession
    folder: str
    profile: Profile = JAPANESE
    limit: int = CATCHUP_LIMIT

    def run(self, candidates: DataFrame, now: dt.datetime, force: bool = False) -> list[str]:
        """`now` is naive UTC. Returns the ids of the published editions, oldest first.

        Window n sees what window n-1 published, so the loop runs over at most `limit` windows; each is one job
        over that window's rows. The stories written so far are checkpointed, which cuts the lineage.
        """
        stories, mark = load_state(self.spark, self.folder)
        stories = prune_stories(stories, F.lit(now).cast("timestamp_ntz"))
        windows = self._windows(None if force or mark is None else mark["last_end"], now)
        assigned = assign_windows(candidates)
        done: list[tuple] = []
        for edition_id, start, end in windows:
            here = assigned.filter(F.col("edition_id") == edition_id)
            if force:
                stories = forget_edition(stories, F.lit(edition_id))
            fresh = filter_seen(here, stories)
            lo, hi = slots.utc(F.lit(end - dt.timedelta(hours=24)).cast("timestamp_ntz")), slots.utc(F.lit(start).cast("timestamp_ntz"))
            near = candidates.filter((F.col("published_at") >= lo) & (F.col("published_at") < hi))
            context = context_for(near, fresh).filter(F.col("edition_id") == edition_id)
            found = cut_lineage(edition_articles(fresh, context, F.lit(now).cast("timestamp_ntz"), self.profile))
            broken = violations(found, self.spark.createDataFrame([(edition_id,)], "edition_id string"), self.profile).limit(20).collect()
            if broken:
                raise GateFailure("; ".join(f"{r['edition_id']}: {r['violation']}" for r in broken))
            last = stories.agg(F.coalesce(F.max("seq"), F.lit(0)) + 1).scalar()
            stories = cut_lineage(stories.unionByName(remember(found, F.lit(edition_id), last)))
            done.append((edition_id, start, end, found))
        if not done:
            return []
        number = publication.next_commit(mark)
        publication.stage([self._documents(*d) for d in done], self.folder, number)
        publication.checked(self.spark, self.folder, number)
        commit_state(self.spark, self.folder, stories, done[-1][2], done[-1][0])
        return [d[0] for d in done]

    def _documents(self, edition_id: str, start: dt.datetime, end: dt.datetime, found: DataFrame) -> DataFrame:
        window = self.spark.createDataFrame([(edition_id, start, end)], "edition_id string, window_start timestamp_ntz, window_end timestamp_ntz")
        return art.editions(found, window)

    def _windows(self, mark, now: dt.datetime) -> list[tuple]:
        """(edition_id, start, end) of the windows to process: one row in, at most `limit` rows out."""
        row = self.spark.createDataFrame([(mark, now)], "mark timestamp_ntz, now timestamp_ntz")
        row = row.withColumn("target", slots.last_completed_end(F.col("now")))
        out = missing_windows(row, "mark", "target", self.limit).orderBy("run_order")
        return [(r["edition_id"], r["window_start"], r["window_end"]) for r in out.collect()]
