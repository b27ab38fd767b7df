"""Text expressions.

Built-in expressions do the work. The few steps Spark has no built-in for (markup, NFKC, case folding,
bracket-aware segmentation, sequence ratio) are Arrow UDFs, and rows that do not need the step are sent
to Python as nulls, so plain text never pays for them.

Functions whose first argument is a DataFrame add one column (`out`). They materialise intermediate columns,
because Spark evaluates a repeated sub-expression again and cannot capture a Python UDF in a lambda.
"""

from __future__ import annotations

import html
import unicodedata
from difflib import SequenceMatcher
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions.profiles import BRACKETS, JAPANESE, ROLE_TAGS, Profile

SPACE = r"(?U)\s+"
#: Characters that NFKC, or NFKC and case folding, may change other than lower case does: all but ASCII and Latin-1 letters (but not ß, which folds).
COMPOSED, FOLDED = r"[\x80-\xBF\x{100}-\x{10FFFF}]", r"[\x80-\xBF\xDF\x{100}-\x{10FFFF}]"
NON_WORD = r"[^\p{L}\p{N}]+"
NON_TITLE = r"[^0-9a-z\u3040-\u30ff\u3400-\u9fff]+"
TITLE_SUFFIX = r"(?U)\s*[|｜:：\-—–]\s*[^|｜:：\-—–]{1,28}$"


def one_of(chars: str, other: bool = False) -> str:
    """A regex class of the characters, or of all others, as ascending ranges.

    Java asks the members of a class one after another, and takes about ten times as long for a negated class of several of them.
    """
    points = sorted({ord(ch) for ch in chars})
    if other:
        edges = [-1, *points, 0x110000]
        ranges = [(a + 1, b - 1) for a, b in zip(edges, edges[1:]) if b - a > 1]
    else:
        starts = [x for x in points if x - 1 not in points]
        ranges = list(zip(starts, [x for x in points if x + 1 not in points]))
    return "[" + "".join(f"\\x{{{a:x}}}" if a == b else f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges) + "]"


BRACKET_CHARS = "".join(BRACKETS) + "".join(BRACKETS.values())
BRACKET_CLASS, NOT_BRACKETS = one_of(BRACKET_CHARS), one_of(BRACKET_CHARS, other=True) + "+"
CLOSER_TO_OPENER = {closer: opener for opener, closer in BRACKETS.items()}
#: Runs of white space but single plain spaces, which may stay.
UNEVEN_SPACE = r"(?U)[\s&&[^ ]]\s*| \s+"


def any_of(patterns) -> str:
    """One Unicode-aware regex that finds any of the patterns."""
    return "(?U)" + "|".join(f"(?:{p})" for p in patterns)


def unicode_rx(pattern: str) -> str:
    return "(?U)" + pattern


def trimmed(c: Column) -> Column:
    """Unary on purpose: `transform` would hand the index to F.trim as the characters to strip."""
    return F.trim(c)


TEXT, TEXTS = T.StringType(), T.ArrayType(T.StringType())


def arrow(returns: T.DataType):
    """An Arrow UDF that is evaluated once.

    Marked nondeterministic, because the optimizer otherwise copies a Python step, with all it reads, into every
    expression that uses its result, and chained steps grow exponentially.
    """
    return lambda fn: F.arrow_udf(fn, returns).asNondeterministic()


#: Values of a batch that are Python objects at one time.
SLICE = 128


def each(values: pa.Array, fn, kind: pa.DataType) -> pa.Array:
    """The function on each value but nulls. Only a slice of a batch is held as Python objects at one time."""
    if values.null_count == len(values):
        return pa.nulls(len(values), kind)
    parts = (values.slice(at, SLICE).to_pylist() for at in range(0, len(values), SLICE))
    return pa.concat_arrays([pa.array([None if v is None else fn(v) for v in part], kind) for part in parts])


def once(df: DataFrame, out: str, c: Column) -> DataFrame:
    """Add a column that is worked out once for a row, however often later steps read it; the optimizer copies other expressions into each use."""
    return df.withColumn(f"__{out}_once", F.explode(F.array(c))).withColumn(out, F.col(f"__{out}_once")).drop(f"__{out}_once")


# ---- markup, normal forms ---------------------------------------------------------------------------

def text_of_markup(value: str) -> str:
    nodes: list[str] = []
    reader = HTMLParser(convert_charrefs=True)
    reader.handle_data = nodes.append
    reader.feed(value)
    reader.close()
    return html.unescape(" ".join(nodes))


def text_of_nested_markup(value: str) -> str:
    """Markup that was escaped inside markup is taken off as well."""
    plain = text_of_markup(value)
    while plain != value and ("<" in plain or "&" in plain):
        value, plain = plain, text_of_markup(plain)
    return plain


def tidy(value: str, limit: int) -> str:
    """The Python form of `squash`, for rows that go to Python anyway."""
    plain = text_of_nested_markup(value) if "<" in value or "&" in value else value
    plain = "".join(ch for ch in plain if ch in "\n\t" or unicodedata.category(ch)[0] != "C")
    return " ".join(plain.split())[:limit].rstrip()


def wide(value: str) -> str:
    return unicodedata.normalize("NFKC", value)


def fold(value: str) -> str:
    return wide(value).casefold()


@arrow(TEXT)
def _strip_markup(values: pa.Array) -> pa.Array:
    return each(values, text_of_markup, pa.string())


@arrow(TEXT)
def _strip_nested_markup(values: pa.Array) -> pa.Array:
    return each(values, text_of_nested_markup, pa.string())


@arrow(TEXT)
def _nfkc(values: pa.Array) -> pa.Array:
    return each(values, wide, pa.string())  # not pyarrow's utf8_normalize, whose NFKC leaves letters decomposed


@arrow(TEXT)
def _nfkc_fold(values: pa.Array) -> pa.Array:
    return each(values, fold, pa.string())


@arrow(TEXTS)
def _nfkc_items(values: pa.Array) -> pa.Array:
    return each(values, lambda items: [wide(v) for v in items], pa.list_(pa.string()))


@arrow(TEXTS)
def _nfkc_fold_items(values: pa.Array) -> pa.Array:
    return each(values, lambda items: [fold(v) for v in items], pa.list_(pa.string()))


@arrow(TEXT)
def _title_form(values: pa.Array) -> pa.Array:
    return each(values, lambda v: wide(tidy(v, 300)).lower(), pa.string())


@arrow(TEXT)
def _key_form(values: pa.Array) -> pa.Array:
    return each(values, lambda v: fold(tidy(v, 500)), pa.string())


# The *_of functions take the name of a materialised column, so several of them in one `withColumns` share one
# Python evaluation.

def _where(name: str, needed: Column) -> Column:
    return F.when(needed, F.col(name))


def nfkc_of(name: str) -> Column:
    return F.coalesce(_nfkc(_where(name, F.col(name).rlike(COMPOSED))), F.col(name))


def nfkc_fold_of(name: str) -> Column:
    return F.coalesce(_nfkc_fold(_where(name, F.col(name).rlike(FOLDED))), F.lower(name))


def nfkc_items_of(name: str) -> Column:
    needed = F.exists(name, lambda v: v.rlike(COMPOSED))
    return F.coalesce(_nfkc_items(_where(name, needed)), F.col(name))


def nfkc_fold_items_of(name: str) -> Column:
    needed = F.exists(name, lambda v: v.rlike(FOLDED))
    return F.coalesce(_nfkc_fold_items(_where(name, needed)), F.transform(name, lambda v: F.lower(v)))


def title_norm_of(name: str) -> Column:
    """Lower-case NFKC title without publisher suffix, reduced to digits, Latin letters, kana and kanji."""
    needed = F.col(name).rlike("[<&]|" + FOLDED)
    form = F.coalesce(_title_form(_where(name, needed)), F.lower(squash(F.coalesce(F.col(name), F.lit("")), 300)))
    return F.regexp_replace(F.regexp_replace(form, TITLE_SUFFIX, ""), NON_TITLE, "")


def point_key_of(name: str) -> Column:
    """Comparison key of a point: folded letters and digits only."""
    needed = F.col(name).rlike("[<&]|" + FOLDED)
    form = F.coalesce(_key_form(_where(name, needed)), F.lower(squash(F.coalesce(F.col(name), F.lit("")), 500)))
    return F.regexp_replace(form, NON_WORD, "")


def _step(df: DataFrame, out: str, c: Column, of) -> DataFrame:
    raw = f"__{out}_in"
    return df.withColumn(raw, c).withColumn(out, of(raw)).drop(raw)


def nfkc(df: DataFrame, out: str, c: Column) -> DataFrame:
    return _step(df, out, c, nfkc_of)


def nfkc_fold(df: DataFrame, out: str, c: Column) -> DataFrame:
    return _step(df, out, c, nfkc_fold_of)


def nfkc_items(df: DataFrame, out: str, c: Column) -> DataFrame:
    return _step(df, out, c, nfkc_items_of)


def nfkc_fold_items(df: DataFrame, out: str, c: Column) -> DataFrame:
    return _step(df, out, c, nfkc_fold_items_of)


def normalize_title(df: DataFrame, out: str, c: Column) -> DataFrame:
    return _step(df, out, c, title_norm_of)


def point_key(df: DataFrame, out: str, c: Column) -> DataFrame:
    return _step(df, out, c, point_key_of)


def squash(c: Column, limit: int | None = None) -> Column:
    """Drop control characters, collapse white space, clip to code points."""
    c = F.regexp_replace(c, r"[\p{C}&&[^\n\t]]", "")
    c = F.trim(F.regexp_replace(c, UNEVEN_SPACE, " "))
    return F.rtrim(F.substring(c, 1, limit)) if limit else c


def clean_text(df: DataFrame, out: str, c: Column, limit: int | None = 1200, nested: bool = False) -> DataFrame:
    """Text nodes of possible markup, entities decoded, one-line, at most `limit` code points."""
    raw = f"__{out}_raw"
    strip = _strip_nested_markup if nested else _strip_markup
    plain = F.coalesce(strip(F.when(F.col(raw).rlike("[<&]"), F.col(raw))), F.col(raw))
    return df.withColumn(raw, F.coalesce(c, F.lit(""))).withColumn(out, squash(plain, limit)).drop(raw)


# ---- predicates -------------------------------------------------------------------------------------

def readable(c: Column, profile: Profile = JAPANESE) -> Column:
    """Share of the profile's script among letters reaches the profile's threshold; letters are counted only where there are others than the script's."""
    script = F.length(F.regexp_replace(c, f"[^{profile.script}]+", ""))
    letters = F.length(F.regexp_replace(c, f"[^{profile.letters}]+", ""))
    others = profile.letters.replace(profile.script, "") if profile.script in profile.letters else f"{profile.letters}&&[^{profile.script}]"
    mixed = c.rlike(f"[{others}]") if others else F.lit(False)
    return F.coalesce(F.when(mixed, script / letters >= profile.script_share).otherwise(c.rlike(f"[{profile.letters}]")), F.lit(False))


def balanced(c: Column) -> Column:
    """All bracket pairs nest. The stack holds openers; an unmatched closer stays on it for good."""
    marks = F.filter(F.split(F.regexp_replace(c, NOT_BRACKETS, ""), ""), lambda ch: ch != "")
    closers = F.create_map(*[F.lit(x) for pair in CLOSER_TO_OPENER.items() for x in pair])

    def step(stack, ch):
        opener = F.element_at(closers, ch)
        return (
            F.when(opener.isNull(), F.concat(stack, ch))
            .when(F.substring(stack, -1, 1) == opener, stack.substr(F.lit(1), F.length(stack) - 1))
            .otherwise(F.concat(stack, F.lit("!")))
        )

    return F.aggregate(marks, F.lit(""), step) == ""


def truncated(c: Column, profile: Profile = JAPANESE) -> Column:
    """A sentence ends in a clipped stem."""
    return c.rlike(rf"(?U)(?:{'|'.join(profile.truncated_stems)})\s*[{profile.terminators}]")


# ---- whole sentences --------------------------------------------------------------------------------

def bracket_segments(text: str, terminators: str) -> list[str]:
    """Sentences that end outside every bracket; a closer without opener discards what led up to it."""
    found, start, open_pairs = [], 0, []
    for at, ch in enumerate(text):
        if ch in BRACKETS:
            open_pairs.append(ch)
        elif ch in CLOSER_TO_OPENER:
            if open_pairs and open_pairs[-1] == CLOSER_TO_OPENER[ch]:
                open_pairs.pop()
            else:
                start, open_pairs = at + 1, []
                continue
        if ch in terminators and not open_pairs:
            found.append(text[start:at + 1])
            start = at + 1
    if not open_pairs:
        found.append(text[start:])
    return [s for s in (part.strip() for part in found) if s]


def pieces(c: Column, profile: Profile = JAPANESE) -> Column:
    """Split after each terminator, trimmed, without empty items."""
    stops, others = one_of(profile.terminators), one_of(profile.terminators, other=True)
    parts = F.regexp_extract_all(c, F.lit(f"{others}*{stops}|{others}+"), F.lit(0))
    return F.filter(F.transform(parts, trimmed), lambda s: s != "")


def begun_pieces(c: Column, profile: Profile) -> Column:
    """Runs of other characters, each with the terminator after it; terminators that end nothing are left out."""
    return F.regexp_extract_all(c, F.lit(f"{one_of(profile.terminators, other=True)}+{one_of(profile.terminators)}?"), F.lit(0))


def ends_in_stop(c: Column, profile: Profile) -> Column:
    """A terminator is the last character, or the last before a line end; only the end of the text is searched."""
    return F.substring(c, -3, 3).rlike(one_of(profile.terminators) + "$")


def segments(df: DataFrame, out: str, c: Column, profile: Profile = JAPANESE) -> DataFrame:
    """Sentences of a text, never split inside brackets."""
    stops = profile.terminators

    @arrow(TEXTS)
    def by_brackets(values: pa.Array) -> pa.Array:
        return each(values, lambda v: bracket_segments(v, stops), pa.list_(pa.string()))

    raw = f"__{out}_raw"
    bracketed = by_brackets(F.when(F.col(raw).rlike(BRACKET_CLASS), F.col(raw)))
    return df.withColumn(raw, c).withColumn(out, F.coalesce(bracketed, pieces(F.col(raw), profile))).drop(raw)


def fitting(parts: Column, limit: int) -> Column:
    """Join leading parts with spaces while they fit; stop at the first that does not."""
    start = F.struct(F.lit("").alias("text"), F.lit(False).alias("full"))

    def step(acc, part):
        longer = F.concat_ws(" ", F.nullif(acc["text"], F.lit("")), part)
        return (
            F.when(acc["full"] | (F.length(longer) > limit), F.struct(acc["text"].alias("text"), F.lit(True).alias("full")))
            .otherwise(F.struct(longer.alias("text"), F.lit(False).alias("full")))
        )

    return F.aggregate(parts, start, step, lambda acc: acc["text"])


def complete_text(
    df: DataFrame, out: str, c: Column, limit: int, profile: Profile = JAPANESE, cleaned: bool = True
) -> DataFrame:
    """The text itself when it fits and is complete, else its leading whole sentences that fit.

    `cleaned` says that the text holds no markup any more.
    """
    text, parts = f"__{out}_text", f"__{out}_parts"
    most = max(1200, limit * 4)
    df = df.withColumn(text, squash(F.coalesce(c, F.lit("")), most)) if cleaned else clean_text(df, text, c, most, nested=True)
    intact = (F.length(text) <= limit) & balanced(F.col(text)) & ~truncated(F.col(text), profile)
    df = df.withColumn(f"__{out}_intact", intact)
    df = segments(df, parts, F.when(~F.col(f"__{out}_intact"), F.col(text)), profile)
    usable = F.filter(F.col(parts), lambda s: ~truncated(s, profile) & (F.length(s) <= limit))
    chosen = F.when(F.col(f"__{out}_intact"), F.col(text)).otherwise(fitting(usable, limit))
    return df.withColumn(out, chosen).drop(text, parts, f"__{out}_intact")


def complete_items(df: DataFrame, out: str, items: Column, limit: int, profile: Profile = JAPANESE) -> DataFrame:
    """`complete_text` on every item of an array of cleaned one-sentence strings; empty results are dropped."""
    stops = profile.terminators

    @arrow(TEXTS)
    def repaired(values: pa.Array) -> pa.Array:
        return each(values, lambda items: [" ".join(bracket_segments(v, stops)) for v in items], pa.list_(pa.string()))

    raw = f"__{out}_raw"
    df = df.withColumn(raw, items)
    bracketed = F.exists(F.col(raw), lambda s: s.rlike(BRACKET_CLASS))
    fixed = F.coalesce(repaired(F.when(bracketed, F.col(raw))), F.col(raw))
    df = df.withColumn(raw, fixed)
    keep = F.filter(F.col(raw), lambda s: (s != "") & (F.length(s) <= limit) & ~truncated(s, profile))
    return df.withColumn(out, keep).drop(raw)


def safe_sentences(c: Column, limit: int | None, profile: Profile = JAPANESE) -> Column:
    """A cleaned text without instruction-like sentences or role tags."""
    parts = F.transform(F.split(c, rf"(?U)(?<={one_of(profile.terminators)})\s*|(?<=[.])\s+(?=[A-Z])"), trimmed)
    kept = F.filter(parts, lambda s: (s != "") & ~s.rlike(any_of(profile.injections)))
    return squash(F.regexp_replace(F.array_join(kept, " "), ROLE_TAGS, " "), limit)


def safe_text(df: DataFrame, out: str, c: Column, limit: int | None, profile: Profile = JAPANESE) -> DataFrame:
    """Clean text without instruction-like sentences or role tags."""
    df = clean_text(df, out, c, max(limit * 3, limit + 240) if limit else None, nested=True)
    return df.withColumn(out, safe_sentences(F.col(out), limit, profile))


def with_keys(df: DataFrame, out: str, items: Column) -> DataFrame:
    """array<string> to array<struct<text, key>> with the comparison key of each item."""
    raw, folded = f"__{out}_items", f"__{out}_folded"
    df = nfkc_fold_items(df.withColumn(raw, items), folded, F.col(raw))
    keyed = F.zip_with(
        F.col(raw),
        F.col(folded),
        lambda text, key: F.struct(
            text.alias("text"), F.regexp_replace(F.substring(key, 1, 500), NON_WORD, "").alias("key")
        ),
    )
    return df.withColumn(out, keyed).drop(raw, folded)


def distinct_by_key(df: DataFrame, out: str, items: Column) -> DataFrame:
    """First item of each non-empty key, in order. Sorts once, so a long array costs n log n."""
    raw, order = f"__{out}_items", f"__{out}_order"
    df = df.withColumn(raw, F.filter(items, lambda x: x["key"] != ""))
    ranked = F.transform(F.col(raw), lambda x, i: F.struct(x["key"].alias("key"), i.alias("at")))
    df = df.withColumn(order, F.array_sort(ranked))
    firsts = F.filter(
        F.col(order), lambda x, i: (i == 0) | (x["key"] != F.get(F.col(order), F.greatest(i - 1, F.lit(0)))["key"])
    )
    df = df.withColumn(order, F.array_sort(F.transform(firsts, lambda x: x["at"])))
    return df.withColumn(out, F.transform(F.col(order), lambda i: F.get(F.col(raw), i))).drop(raw, order)


def description_sentences(
    df: DataFrame, out: str, c: Column, profile: Profile = JAPANESE, limit: int = 240
) -> DataFrame:
    """Distinct complete sentences of a safe description, each with its key: array<struct<text, key>>."""
    whole = f"__{out}_whole"
    body = F.trim(F.regexp_replace(c, r"^【[^】]{1,180}】\s*", ""))
    raw = F.transform(begun_pieces(body, profile), trimmed)
    df = complete_items(df, whole, raw, limit, profile)
    ended = F.transform(
        F.col(whole), lambda s: F.when(ends_in_stop(s, profile), s).otherwise(F.concat(s, F.lit(profile.full_stop)))
    )
    df = with_keys(df, whole, ended)
    return distinct_by_key(df, out, F.col(whole)).drop(whole)


# ---- titles and keys --------------------------------------------------------------------------------

def comparison_text(df: DataFrame, out: str, c: Column) -> DataFrame:
    """Search form: NFKC, lower case, only digits, Latin letters, kana and kanji."""
    return nfkc(df, out, F.coalesce(c, F.lit(""))).withColumn(out, F.regexp_replace(F.lower(out), NON_TITLE, ""))


def paragraph_key(df: DataFrame, out: str, c: Column) -> DataFrame:
    return nfkc(df, out, F.coalesce(c, F.lit(""))).withColumn(out, F.lower(F.regexp_replace(out, SPACE, "")))


def closing_cut(text: str, limit: int) -> str:
    """Longest start of `text` that, with an ellipsis and its missing closers, fits in `limit`."""
    best, open_pairs = "", []
    for at, ch in enumerate(text, start=1):
        if ch in BRACKETS:
            open_pairs.append(BRACKETS[ch])
        elif ch in CLOSER_TO_OPENER:
            if not open_pairs or open_pairs.pop() != ch:
                break
        if not ch.isspace() and at + 1 + len(open_pairs) <= limit:
            best = text[:at].rstrip("、,・/／｜|：:-") + "…" + "".join(reversed(open_pairs))
    return best


def clip_title(df: DataFrame, out: str, c: Column, limit: int = 120, close: bool = True) -> DataFrame:
    """A cleaned title, or its start up to a boundary with an ellipsis and every bracket closed.

    Without `close` brackets are plain characters: a title that fits stays as it is, and a clipped one ends in the ellipsis.
    """

    @arrow(TEXT)
    def cut(values: pa.Array) -> pa.Array:
        return each(values, lambda v: closing_cut(v, limit), pa.string())

    text, start = f"__{out}_text", f"__{out}_start"
    df = df.withColumn(text, squash(F.coalesce(c, F.lit("")), max(300, limit * 3)))
    intact = F.length(text) <= limit
    intact = intact & balanced(F.col(text)) if close else intact
    df = df.withColumn(start, F.when(~intact, F.rtrim(F.substring(text, 1, max(1, limit - 1)))))
    bounded = F.regexp_extract(F.col(start), r"^(.*[。！？!?｜|：:])", 1)
    at_boundary = F.length(bounded) - 1 >= max(12, limit // 2)
    df = df.withColumn(
        start, F.when(at_boundary, F.regexp_replace(bounded, "[｜|：: ]+$", "")).otherwise(F.col(start))
    )
    ended = cut(F.col(start)) if close else F.concat(F.regexp_replace(start, "[、,・/／｜|：:-]+$", ""), F.lit("…"))
    return df.withColumn(out, F.coalesce(ended, F.col(text))).drop(text, start)


def grams(c: Column, width: int = 2) -> Column:
    """Distinct character n-grams; a shorter string is its own gram; '' has none."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(c) - (width - 1), F.lit(1)))
    found = F.array_distinct(F.transform(starts, lambda i: F.substring(c, i, F.lit(width))))
    return F.when(c == "", F.array().cast("array<string>")).otherwise(found)


@arrow(TEXTS)
def pair_sets(values: pa.Array) -> pa.Array:
    """Distinct pairs of neighbouring characters of each text; `grams` is quadratic in the length of a text."""
    return each(values, lambda v: sorted({v[i : i + 2] for i in range(len(v) - 1)}), pa.list_(pa.string()))


def jaccard(a: Column, b: Column) -> Column:
    shared = F.size(F.array_intersect(a, b))
    return shared / F.nullif(F.size(a) + F.size(b) - shared, F.lit(0))


def ratio(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()


def likeness(a: str, b: str) -> float:
    """Best of sequence ratio, bigram Jaccard and containment of two normalised titles."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    return max(ratio(a, b), shared_share(a, b))


def shared_share(a: str, b: str) -> float:
    """The better of bigram Jaccard and containment of two texts."""
    pairs = [{s[i:i + 2] for i in range(max(1, len(s) - 1))} for s in (a, b)]
    overlap = len(pairs[0] & pairs[1]) / len(pairs[0] | pairs[1])
    return max(overlap, min(len(a), len(b)) / max(len(a), len(b)) if a in b or b in a else 0.0)


@arrow(T.ArrayType(T.DoubleType()))
def known_shares(items: pa.Array, references: pa.Array) -> pa.Array:
    """For each item of a list the share of its distinct trigrams that the references have, in time linear in the texts."""

    def trigrams(s: str) -> set[str]:
        return {s[i : i + 3] for i in range(max(1, len(s) - 2))} if s else set()

    def shares(texts: list[str], others: list[str]) -> list[float]:
        known = set().union(*map(trigrams, others))
        own = [trigrams(t) for t in texts]
        return [len(x & known) / len(x) if x else 0.0 for x in own]

    rows = zip(items.to_pylist(), references.to_pylist())
    return pa.array([None if texts is None else shares(texts, others or []) for texts, others in rows], pa.list_(pa.float64()))


def text_overlap(c: Column, references: Column) -> Column:
    """Comparison texts: equal to, short and contained in, or sharing 68% of trigrams with the references."""
    kept = F.filter(references, lambda r: r != "")
    long = F.when(F.length(c) >= 12, c)  # shorter texts need no trigrams
    share = F.get(known_shares(F.when(long.isNotNull(), F.array(long)), kept), F.lit(0))
    contained = F.exists(kept, lambda r: F.contains(r, c))
    return F.coalesce(
        (c != "") & (F.array_contains(kept, c) | F.when(F.length(c) < 12, contained).otherwise(share >= 0.68)),
        F.lit(False),
    )


def excerpt(
    df: DataFrame, out: str, c: Column, limit: int, profile: Profile = JAPANESE, sentences: int = 3
) -> DataFrame:
    """Up to three whole sentences of a cleaned text within the limit, ended by a stop; '' when the first is too long."""
    found = f"__{out}_found"
    df = df.withColumn(found, safe_sentences(squash(F.coalesce(c, F.lit("")), (limit + 160) * 3), limit + 160, profile))
    split = F.transform(begun_pieces(F.col(found), profile), trimmed)
    df = df.withColumn(found, F.filter(split, lambda s: s != ""))
    starts = F.transform(
        F.sequence(F.lit(0), F.least(F.size(found), F.lit(sentences))),
        lambda n: F.array_join(F.slice(F.col(found), F.lit(1), n), ""),
    )
    df = df.withColumn(out, F.try_element_at(F.filter(starts, lambda s: F.length(s) <= limit), F.lit(-1))).drop(found)
    ended = (F.col(out) == "") | ends_in_stop(F.col(out), profile)
    return df.withColumn(out, F.when(ended, F.col(out)).otherwise(F.concat(F.col(out), F.lit(profile.full_stop))))


def stable_hash(c: Column, length: int = 16) -> Column:
    return F.substring(F.sha2(c, 256), 1, length)
