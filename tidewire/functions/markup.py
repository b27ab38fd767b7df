"""Raw parts of official pages and bulletins.

The two parsers below only take a document apart; which parts are kept, how they are compared, composed and
clipped is expressed on the resulting columns in `operators.enrich`.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql.pandas.types import from_arrow_type

from tidewire.functions.text import TEXTS, arrow, each, text_of_markup

# fixed values: elements of a page that never carry its article, void elements, and paragraph-like elements
IGNORED = frozenset((
    "aside", "audio", "button", "canvas", "footer", "form", "header", "iframe", "nav", "noscript", "script", "style",
    "svg", "template", "video",
))
VOID = frozenset((
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
))
BLOCKS = frozenset((
    "p", "li", "td", "dd", "dt",
))
SCOPES = ("root", "article", "main")


class PageReader(HTMLParser):
    """Texts of paragraph-like elements inside a named root, an article or a main element."""

    def __init__(self, root_ids: frozenset[str]):
        super().__init__(convert_charrefs=True)
        self.root_ids = root_ids
        self.path: list[tuple[str, frozenset[str]]] = []
        self.inside: Counter[str] = Counter()
        self.nested = 0
        self.scope = ""
        self.words: list[str] = []
        self.found: dict[str, list[str]] = {scope: [] for scope in SCOPES}

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            return
        marks = {tag} & {"article", "main"}
        if dict(attrs).get("id") in self.root_ids:
            marks.add("root")
        if tag in IGNORED:
            marks.add("ignored")
        self.path.append((tag, frozenset(marks)))
        self.inside.update(marks)
        scope = next((s for s in SCOPES if self.inside[s]), "")
        if tag in BLOCKS and scope and not self.inside["ignored"]:
            if not self.nested:
                self.scope, self.words = scope, []
            self.nested += 1

    def handle_startendtag(self, tag, attrs):
        """A self-closing element opens nothing."""

    def handle_data(self, data):
        if self.nested and not self.inside["ignored"]:
            self.words.append(data)

    def handle_endtag(self, tag):
        if tag in BLOCKS and self.nested:
            self.nested -= 1
            if not self.nested:
                block = " ".join(" ".join(self.words).split())
                if block:
                    self.found[self.scope].append(block)
        if any(name == tag for name, _ in self.path):
            while True:
                name, marks = self.path.pop()
                self.inside.subtract(marks)
                if name == tag:
                    break

    def blocks(self) -> list[str]:
        return next((self.found[s] for s in SCOPES if self.found[s]), [])


def page_blocks(page: str, root_ids: list[str] | None) -> list[str]:
    reader = PageReader(frozenset(root_ids or ()))
    reader.feed(page)
    reader.close()
    return reader.blocks()


@arrow(TEXTS)
def html_blocks(pages: pa.Array, root_ids: pa.Array) -> pa.Array:
    rows = zip(pages.to_pylist(), root_ids.to_pylist())
    return pa.array([None if p is None else page_blocks(p, ids) for p, ids in rows], pa.list_(pa.string()))


def content(node: ET.Element | None) -> str:
    if node is None:
        return ""
    found = " ".join(node.itertext())
    return (text_of_markup(found) if "<" in found or "&" in found else found).strip()  # only markup needs the reader


def first(node: ET.Element, path: str) -> str:
    return next((value for value in map(content, node.iterfind(path)) if value), "")


def note(node: ET.Element | None) -> str:
    return "" if node is None else node.get("description", "")


def bulletin_item(item: ET.Element, tsunami: bool) -> dict:
    height = item.find(".//{*}TsunamiHeight")
    return {
        "kinds": [first(kind, ".//{*}Name") for kind in item.iterfind(".//{*}Kind")],
        "areas": [first(area, ".//{*}Name") for area in item.iterfind(".//{*}Area")],
        "height": note(height) or content(height),
        "arrival": content(item.find(".//{*}ArrivalTime")),
        "condition": content(item.find(".//{*}Condition")),
        "tsunami": tsunami,
    }


def bulletin_parts(xml: str) -> dict | None:
    """Named parts of a bulletin at any depth and in any namespace; null when it must not or cannot be read."""
    upper = xml.upper()
    if "<!DOCTYPE" in upper or "<!ENTITY" in upper:
        return None
    try:
        root = ET.fromstring(xml.encode("utf-8"))
    except ET.ParseError:
        return None
    magnitude = root.find(".//{*}Magnitude")
    waves = {id(item) for item in root.iterfind(".//{*}Tsunami//{*}Item")}
    return {
        "head_title": first(root, ".//{*}Head/{*}Title"),
        "control_title": first(root, ".//{*}Control/{*}Title"),
        "event_id": first(root, ".//{*}Head/{*}EventID"),
        "serial": first(root, ".//{*}Head/{*}Serial"),
        "origin_time": content(root.find(".//{*}OriginTime")),
        "hypocenter": first(root, ".//{*}Hypocenter//{*}Area//{*}Name"),
        "magnitude": content(magnitude),
        "magnitude_note": note(magnitude),
        "max_intensity": content(root.find(".//{*}MaxInt")),
        "headlines": [content(t) for t in root.iterfind(".//{*}Headline//{*}Text")],
        "texts": [content(t) for t in root.iterfind(".//{*}Text")],
        "items": [bulletin_item(item, id(item) in waves) for item in root.iterfind(".//{*}Item")],
    }


_ITEM_TYPE = pa.struct(
    [
        ("kinds", pa.list_(pa.string())),
        ("areas", pa.list_(pa.string())),
        ("height", pa.string()),
        ("arrival", pa.string()),
        ("condition", pa.string()),
        ("tsunami", pa.bool_()),
    ]
)
_PLAIN = "head_title control_title event_id serial origin_time hypocenter magnitude magnitude_note max_intensity".split()
_PARTS_TYPE = pa.struct(
    [(name, pa.string()) for name in _PLAIN]
    + [("headlines", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("items", pa.list_(_ITEM_TYPE))]
)


@arrow(from_arrow_type(_PARTS_TYPE))
def parsed_bulletin(documents: pa.Array) -> pa.Array:
    return each(documents, bulletin_parts, _PARTS_TYPE)
