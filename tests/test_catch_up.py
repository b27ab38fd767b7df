"""The ordered run over missing windows: publication, history and idempotence; and the gate in front of it."""

import datetime as dt

import pytest

from tests.test_operators import candidates
from tidewire.operators import gates
from tidewire.plans import edition_run, publication
from tidewire.plans.edition_run import CatchUp
from tidewire.sources import state

NOW = dt.datetime(2026, 8, 15, 9, 30)  # 18:30 on the Japanese clock
TOPICS = "首相が会見で方針を説明 動物園でパンダが誕生 新しい橋が開通した 大学が研究成果を公表 市場で魚の初競り".split()


def news(spark, publishers=("a", "b")):
    rows = []
    for n, topic in enumerate(TOPICS):
        body = f"{topic}ことが分かった。詳しい内容を{n}つの点で説明した。今後も続報の予定だ。"
        rows.append((f"n{n}", topic, body, publishers[n % len(publishers)], "国内", 200 + n * 20, 3, False))
        rows.append((f"r{n}", topic, body, publishers[n % len(publishers)], "国内", 400 + n * 20, 3, False))
    return candidates(spark, rows).drop("edition_id")


def test_catch_up_publishes_once(spark, tmp_path):
    folder = str(tmp_path)
    first_end = dt.datetime(2026, 8, 15, 12)
    state.commit_state(spark, folder, state.empty_stories(spark), first_end, "2026-08-15-12")
    run = CatchUp(spark, folder)
    assert run.run(news(spark), NOW) == ["2026-08-15-18"]
    stories, mark = state.load_state(spark, folder)
    assert mark["last_edition"] == "2026-08-15-18"
    urls = {u for s in stories.collect() for u in s["urls"]}
    assert urls and all("/n" in u or "/r" in u for u in urls)
    edition = spark.read.json(f"{folder}/editions").first()
    assert edition["edition"]["id"] == "2026-08-15-18" and edition["stats"]["articleCount"] == len(edition["articles"])
    published = {r.edition_id: len(r.articles) for r in publication.published_editions(spark, folder).collect()}
    assert published == {"2026-08-15-18": len(edition["articles"])}
    assert run.run(news(spark), NOW) == []


def first_mark(spark, folder):
    state.commit_state(spark, folder, state.empty_stories(spark), dt.datetime(2026, 8, 15, 12), "2026-08-15-12")


@pytest.mark.parametrize("step", ["checked", "commit_state"])
def test_a_run_killed_between_the_steps_leaves_nothing_visible_and_is_repeated_whole(spark, tmp_path, monkeypatch, step):
    folder, items = str(tmp_path), news(spark)
    first_mark(spark, folder)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(publication if step == "checked" else edition_run, step, killed)
        with pytest.raises(KeyboardInterrupt):
            CatchUp(spark, folder).run(items, NOW)
    assert publication.published_editions(spark, folder).count() == 0 and state.load_state(spark, folder)[1]["commit"] == 1
    assert CatchUp(spark, folder).run(items, NOW) == ["2026-08-15-18"]
    (edition,) = publication.published_editions(spark, folder).collect()
    assert edition.commit == 2 and len(edition.articles) > 0
    if step == "checked":  # forced regeneration forgets the edition's own stories and replaces it
        stories = state.load_state(spark, folder)[0].count()
        assert CatchUp(spark, folder, limit=1).run(items, NOW, force=True) == ["2026-08-15-18"]
        (again,) = publication.published_editions(spark, folder).collect()
        assert again.commit == 3 and len(again.articles) == len(edition.articles) and state.load_state(spark, folder)[0].count() == stories


def test_the_audit_compares_what_was_written_with_the_manifest(spark, tmp_path):
    folder = str(tmp_path)
    rows = [("e1", ["a", "b"]), ("e2", []), ("e3", ["c"])]
    editions = spark.createDataFrame(rows, "edition_id string, articles array<string>")
    publication.stage([editions.filter("edition_id = 'e9'"), editions], folder, 1)
    assert publication.audit(spark, folder, 1).count() == 0
    publication.stage([editions], folder, 1)  # a replay
    assert publication.audit(spark, folder, 1).count() == 0
    spark.createDataFrame([("e1", 3), ("e2", 0), ("e4", 1)], publication.MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifests/commit=1")
    found = {r.edition_id: r.problem for r in publication.audit(spark, folder, 1).collect()}
    assert found == {"e1": "articles are missing", "e3": "not in the manifest", "e4": "0 documents"}
    with pytest.raises(publication.AuditFailure):
        publication.checked(spark, folder, 1)
    assert publication.published_editions(spark, folder).count() == 0  # no pointer


def test_gate_names_single_secondary_publishers(spark):
    sources = "array<struct<publisherId: string, name: string, isPrimary: boolean>>"
    rows = [("e1", [("a", "A", False)]), ("e2", [("a", "A", True)]), ("e3", [("a", "A", False), ("b", "B", False)])]
    articles = spark.createDataFrame(rows, f"edition_id string, sources {sources}")
    editions = spark.createDataFrame([("e1",), ("e2",), ("e3",), ("e4",)], "edition_id string")
    found = {r["edition_id"]: r["violation"] for r in gates.source_mix_violations(articles, editions).collect()}
    assert found == {"e1": "single secondary publisher", "e4": "no sourced articles"}
