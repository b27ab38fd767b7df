"""Differencing meets every page: landmarks guard its result and do not take its place."""

from __future__ import annotations

from tidewire.llm import page_text


def test_pages_with_articles_are_paired_and_aligned_too(spark, monkeypatch):
    rows = [(i, f"https://h/news/{i}", f"<nav>Menu</nav><p>Top</p><article><p>Own {i}</p><p>Quoted</p></article><p>Bottom {i}</p>") for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = []
    plain = page_text.shared_with_neighbour
    monkeypatch.setattr(page_text, "shared_with_neighbour", lambda lines: found.append(plain(lines)) or found[-1])
    out = {r.page_id: r.text for r in page_text.main_text(pages).collect()}
    assert out == {i: f"Own {i}\n\nQuoted" for i in range(6)}  # the quoted line is shared and stays, the last is not and goes
    assert [r.gone for r in found[0].collect()] == [[1]] * 6


def test_copies_of_an_article_are_passed_over():
    pages = [
        {"lines": [1, 10, 11, 12, 9], "kinds": [2, 1, 1, 1, 0], "sizes": [90, 9, 9, 9, 5]},
        {"lines": [1, 20, 21, 22, 9], "kinds": [2, 1, 1, 1, 0], "sizes": [90, 9, 9, 9, 5]},
        {"lines": [1, 10, 11, 12, 8], "kinds": [2, 1, 1, 1, 0], "sizes": [90, 9, 9, 9, 5]},
    ]
    stretch = page_text.Stretch(pages)
    assert stretch.before(pages[2], 1) == 1  # a long menu makes no copies
    assert stretch.before(pages[2], 0) == -1
    nothing = {"lines": [1], "kinds": [2], "sizes": [90]}
    assert stretch.before(nothing, 2) == -1
