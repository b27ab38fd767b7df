"""The plain cut of titles, next to the one that closes brackets."""

from __future__ import annotations

import pytest

from tidewire.functions import text

TITLES = {
    "Threreed ther than ththlyou that +1 (251) 555 0100 and more": ("Threreed ther than ththlyou that +1 (25…", "Threreed ther than ththlyou that +1 (2…)"),
    "a) stray closer in a title that is longer than forty": ("a) stray closer in a title that is long…", "a…"),
    "short (open": ("short (open", "short (open…)"),
    "A whole sentence here! And then what follows it": ("A whole sentence here!…", "A whole sentence here!…"),
    "plain and longer than forty characters, - and on": ("plain and longer than forty characters…", "plain and longer than forty characters…"),
}


@pytest.mark.parametrize("close", [False, True])
def test_titles_are_cut_with_and_without_closing(spark, close):
    rows = spark.createDataFrame([(t,) for t in TITLES], "title string")
    got = {r.title: r.cut for r in text.clip_title(rows, "cut", rows["title"], 40, close=close).collect()}
    assert got == {t: both[close] for t, both in TITLES.items()}
