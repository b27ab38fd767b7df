"""Texts of bulletins go through the markup reader only where they hold markup, and a bulletin is taken apart once."""

from __future__ import annotations

from tidewire.functions import markup
from tidewire.plans import queries

XML = "<Report><Head><Title>{}</Title><EventID> e1 </EventID></Head><Body><MaxInt/><Item><Kind><Name>k</Name></Kind></Item></Body></Report>"


def test_plain_texts_need_no_reader(monkeypatch):
    with_markup = markup.bulletin_parts(XML.format("a &lt;b&gt;bold&lt;/b&gt; &amp;amp; c"))
    calls = []
    monkeypatch.setattr(markup, "text_of_markup", lambda v: calls.append(v) or v)
    plain = markup.bulletin_parts(XML.format("plain  title"))
    assert calls == []
    assert plain["head_title"] == "plain  title" and plain["event_id"] == "e1" and plain["max_intensity"] == ""
    assert with_markup["head_title"] == "a  bold  & c"


def test_linked_bulletins_read_documents_taken_apart_before(spark):
    plan = queries.linked_bulletins(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "parsed_bulletin" not in plan
