"""Marks around and inside articles: reader comments stay out, words of a class inside an article do not take its text."""

from tidewire.llm.page_text import ARTICLE, AROUND, page_lines


def test_articles_in_comments_after_the_article_stay_out():
    page = "<article><p>body</p></article><div class='comments'><article>reader</article></div>"
    assert page_lines(page) == [("body", ARTICLE), ("reader", AROUND)]


def test_what_was_left_open_before_the_first_article_ends_there():
    assert page_lines("<nav><ul><li>menu<article><p>one</p></article>") == [("menu", AROUND), ("one", ARTICLE)]


def test_only_whole_names_speak_inside_an_article():
    page = "<article><p class='related-work'>a</p><p id='notice-period'>b</p><div class='advert'>c</div><div class='social-policy'>d</div></article>"
    assert page_lines(page) == [("a", ARTICLE), ("b", ARTICLE), ("c", AROUND), ("d", ARTICLE)]
    assert page_lines("<div class='ad-banner'>x</div><article>y</article>") == [("x", AROUND), ("y", ARTICLE)]
